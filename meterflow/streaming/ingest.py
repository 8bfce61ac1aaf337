"""Continuous ingestion and persistence: CSV drops → keyed topics (B1), topics → typed raw
tables, change feeds → keyed tables (J7, J8).

One stream per topic group. Each micro-batch is parsed once, persisted, and
split into typed rows (appended to the raw table) and quarantined rows
(appended to a side table): a bad record never stops the stream (B7). The
CDC stream appends each batch to a keyed table (B4), and the events that cannot
be applied to a side table.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators import quality
from .. import schemas
from ..session import use_rocksdb_state
from ..sinks.keyed import KEYED_BUCKETS, append_changes, compact
from ..sinks.tables import with_audit
from ..sources.cdc import ChangeSplit, split_changes
from ..sinks.topics import publish_batch, to_messages
from ..sources import files, topics
from ..sources.topics import parse_messages

SPLITTERS = {"cdr_data": quality.split_cdr_data, "cdr_voice": quality.split_cdr_voice,
             "ticks": quality.split_ticks}


# The two drops, with their file names, wire schema and topic.
DROPS = {"cdr_data": (files.DATA_GLOB, schemas.CDR_DATA_WIRE, topics.CDR_DATA_TOPIC),
         "cdr_voice": (files.VOICE_GLOB, schemas.CDR_VOICE_WIRE, topics.CDR_VOICE_TOPIC)}


def start_drop_ingest(spark: SparkSession, drop_path: str, kind: str, checkpoint: str, fmt: str = "json",
                      topics_path: str | None = None, bootstrap: str | None = None, available_now: bool = True,
                      processing_time: str = "10 seconds", max_files_per_trigger: int = 1000,
                      glob: str | None = None) -> StreamingQuery:
    """CSV drop → topic of JSON rows keyed by msisdn (A1-A3, B1), columns by each file's header.

    The stream lists new files; each micro-batch, of at most ``max_files_per_trigger`` of them, reads
    their rows and publishes them under ``topics_path/topic`` or to Kafka."""
    names, wire, topic = DROPS[kind]

    def publish(batch: DataFrame, batch_id: int) -> None:
        paths = [r["path"] for r in batch.collect()]
        if paths:
            rows = files.read_files(batch.sparkSession, paths, wire)
            publish_batch(to_messages(rows, topic, "msisdn"), batch_id, fmt, f"{topics_path}/{topic}", bootstrap)

    w = (files.drop_paths(spark, drop_path, glob or names, True, max_files_per_trigger).writeStream
         .option("checkpointLocation", checkpoint).foreachBatch(publish))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


def raw_writer(kind: str, raw_path: str, quarantine_path: str, audit: bool = False):
    split = SPLITTERS[kind]

    def write(batch: DataFrame, batch_id: int) -> None:
        parsed = split(batch)
        p = parsed.parsed.persist()
        try:
            s = quality.Split(p, parsed.columns, parsed.raw_columns)
            good = with_audit(s.good) if audit else s.good
            # Batch-id sub-folders make a replayed batch overwrite itself instead of appending twice.
            good.write.mode("overwrite").parquet(f"{raw_path}/batch={batch_id}")
            s.quarantine.write.mode("overwrite").parquet(f"{quarantine_path}/batch={batch_id}")
        finally:
            p.unpersist()
    return write


def quarantine_writer(path: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    return write


def start_raw_ingest(messages: DataFrame, topic: str, wire_schema: StructType, kind: str, raw_path: str,
                     quarantine_path: str, checkpoint: str, available_now: bool = True,
                     processing_time: str = "10 seconds", audit: bool = False) -> StreamingQuery:
    """Topic → typed raw table + quarantine (J7, B3, B7); ``audit`` adds ``ingested_at`` and ``id``."""
    use_rocksdb_state(messages.sparkSession)
    parsed = parse_messages(messages, wire_schema, topic)
    w = (parsed.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(raw_writer(kind, raw_path, quarantine_path, audit)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


def cdc_writer(table_path: str, quarantine_path: str | None, row: StructType, keys: list[str], columns: tuple[list[str], list[str]],
               buckets: int = KEYED_BUCKETS, compact_every: int = 0, ratio: float = 2.0, purge_after: timedelta | None = None):
    """foreachBatch function over parsed change events: changes → keyed table, dead letters → side table;
    every ``compact_every`` batches (0: never) the table is compacted."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if batch.isEmpty():
                return
            split = ChangeSplit(batch, *columns)
            append_changes(split.good, table_path, keys, row, buckets)
            if quarantine_path and not (dead := split.dead).isEmpty():
                dead.write.mode("overwrite").parquet(f"{quarantine_path}/batch={batch_id}")
        finally:
            batch.unpersist()
        if compact_every and batch_id % compact_every == compact_every - 1:
            before = datetime.now(timezone.utc).replace(tzinfo=None) - purge_after if purge_after else None
            compact(batch.sparkSession, table_path, keys, row, ratio, before)
    return write


def start_cdc_apply(messages: DataFrame, row: StructType, keys: list[str], table_path: str, checkpoint: str,
                    available_now: bool = True, processing_time: str = "10 seconds", buckets: int = KEYED_BUCKETS,
                    quarantine_path: str | None = None, compact_every: int = 0, ratio: float = 2.0,
                    purge_after: timedelta | None = None) -> StreamingQuery:
    """Change feed → keyed table (J8); each micro-batch appends its changes, and the events that cannot
    be applied go to ``quarantine_path`` (B7)."""
    use_rocksdb_state(messages.sparkSession)
    split = split_changes(messages, row, keys)
    w = split.parsed.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        cdc_writer(table_path, quarantine_path, row, keys, (split.columns, split.raw_columns), buckets, compact_every, ratio, purge_after))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()
