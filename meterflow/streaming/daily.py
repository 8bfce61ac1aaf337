"""Running daily usage per subscriber as a stateful stream (J1-J6, H4s, B2, J9).

Both feeds are merged into one usage stream and aggregated per
(msisdn, day, category, usage_type) in the state store. In ``update`` mode
every micro-batch emits the keys it changed with their cumulative totals,
which ``foreachBatch`` upserts into the date-partitioned serving table — so
totals stay cumulative for the whole day (X1/X2 fixed) and a replayed batch
rewrites the same values (checkpointed offsets + state: exactly-once state,
idempotent sink).

No watermark is set unless the caller asks for one. With ``watermark`` set, state for a day is evicted once event time passes
the day plus the delay and later rows for it are dropped and counted
(``stateOperators[].numRowsDroppedByWatermark``). Without it, nothing is
ever late — the source system's behaviour — and state grows with the number of
subscriber-days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.serving import SERVING_COLUMNS, daily_summary, daily_usage_rows, summary_updates, with_bucket
from ..sources.raw import read_serving_table
from ..operators.usage import usage_stream
from ..session import use_rocksdb_state
from ..sinks.tables import partition_filter, write_daily_usage
from ..sinks.topics import publish_batch, to_messages
from ..sources.topics import SUMMARY_TOPIC, parse_messages
from .. import schemas

TYPE_USAGE_COLUMNS = ["msisdn", "date", "category", "usage_type", "up_bytes", "down_bytes",
                      "call_duration_sec", "call_count"]


def daily_usage_state(cdr_data: DataFrame | None, cdr_voice: DataFrame | None,
                      watermark: str | None = None) -> DataFrame:
    """Streaming (or batch) aggregate per (msisdn, day, category, usage_type)."""
    u = usage_stream(cdr_data, cdr_voice)
    # Watermarks need TIMESTAMP (not NTZ) event time; the session is UTC.
    u = u.withColumn("event_ts", F.col("event_time").cast("timestamp"))
    sums = [F.sum("up_bytes").cast("bigint").alias("up_bytes"), F.sum("down_bytes").cast("bigint").alias("down_bytes"),
            F.sum("duration_sec").cast("bigint").alias("call_duration_sec"),
            F.sum("calls").cast("bigint").alias("call_count")]
    if watermark:
        g = (u.withWatermark("event_ts", watermark)
             .groupBy("msisdn", F.window("event_ts", "1 day").alias("day"), "category", "usage_type").agg(*sums))
        return g.select("msisdn", F.date_format(F.col("day.start"), "yyyy-MM-dd").alias("date"),
                        *TYPE_USAGE_COLUMNS[2:])
    g = u.groupBy("msisdn", F.date_format("event_ts", "yyyy-MM-dd").alias("date"), "category", "usage_type").agg(*sums)
    return g.select(*TYPE_USAGE_COLUMNS)


def serving_writer(serving_path: str, summary_path: str | None = None, buckets: int | None = None,
                   fmt: str = "json", bootstrap: str | None = None):
    """foreachBatch function: upsert changed serving rows (J9); optionally publish
    the nested daily summary of every touched subscriber-day (B2, J4) to a folder or Kafka."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if batch.isEmpty():
                return
            write_daily_usage(daily_usage_rows(batch), serving_path, buckets)
            if summary_path or fmt != "json":
                spark = batch.sparkSession
                # Only the touched (date, bucket) partitions are listed and read.
                touched = with_bucket(batch.select("msisdn", "date").distinct(), buckets)
                rows = (read_serving_table(spark, serving_path)
                        .where(partition_filter(touched, ["date", "bucket"]))
                        .join(touched, ["date", "bucket", "msisdn"], "left_semi").select(*SERVING_COLUMNS))
                summ = daily_summary(rows.select(*TYPE_USAGE_COLUMNS))
                publish_batch(to_messages(summ, SUMMARY_TOPIC, "msisdn"), batch_id, fmt, summary_path, bootstrap)
        finally:
            batch.unpersist()
    return write


def start_daily_usage(cdr_data: DataFrame | None, cdr_voice: DataFrame | None, serving_path: str,
                      checkpoint: str, watermark: str | None = None, summary_path: str | None = None,
                      available_now: bool = True, processing_time: str = "10 seconds",
                      buckets: int | None = None, fmt: str = "json", bootstrap: str | None = None) -> StreamingQuery:
    """Start the daily usage stream into the serving table.

    ``buckets`` is the serving table's msisdn bucket count per date (a table
    property: keep it fixed for the life of the table). Size it so one
    (date, bucket) partition is about one file of ~128 MB; the default suits
    tens of millions of subscribers.
    """
    use_rocksdb_state((cdr_data if cdr_data is not None else cdr_voice).sparkSession)
    agg = daily_usage_state(cdr_data, cdr_voice, watermark)
    w = (agg.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
         .foreachBatch(serving_writer(serving_path, summary_path, buckets, fmt, bootstrap)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


def start_summary_to_serving(messages: DataFrame, serving_path: str, checkpoint: str, available_now: bool = True,
                             processing_time: str = "10 seconds", buckets: int | None = None) -> StreamingQuery:
    """Summary topic → serving table (J9): a message's maps become rows, and a row replaces a stored one
    unless that comes from a newer message, in whatever order the messages arrive."""
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = summary_updates(batch).persist()
        try:
            if not rows.isEmpty():
                write_daily_usage(rows, serving_path, buckets)
        finally:
            rows.unpersist()

    w = (parse_messages(messages, schemas.USAGE_SUMMARY, SUMMARY_TOPIC).writeStream
         .option("checkpointLocation", checkpoint).foreachBatch(write))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


def read_serving(spark, serving_path: str) -> DataFrame:
    return read_serving_table(spark, serving_path).select(*SERVING_COLUMNS)
