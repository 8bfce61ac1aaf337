"""Production entry points: sources wired to operators and sinks.

* ``refresh_marts`` — the four marts from the raw tables, materialised in full
  (the scheduled SQL-model run).
* ``start_persistence`` — topics → typed raw tables with quarantine, and the
  three CRM change feeds → keyed tables (the persistence service).
* ``start_ingestion`` — CSV drops, by header name → keyed topics (the ingestion service).
* ``start_usage_service`` — topics, or CSV drops by way of topics → daily usage
  state → serving table and summary topic (stream processor + serving writer).
* ``start_idle_flush`` — topics or CSV drops → nested summaries published per
  subscriber-day after it has been idle (the processor's flush rule).
* ``start_serving_writer`` — summary topic → serving table.

The usage services require of a record only what the sums read and write the others to a quarantine.

Everything here is wiring; the logic lives in ``operators`` and ``sinks``.
"""

from __future__ import annotations

import threading
import uuid
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..operators import crm, forex, quality, sessions, usage
from ..sinks.tables import make_folder, materialize
from ..sources import topics
from ..sources.raw import load_raw
from ..streaming import daily, flush, ingest

MARTS = ("cdr_data_summary", "cdr_usage_rollup", "cdr_tower_sessions", "cdr_tower_session_pairs",
         "crm_flattened", "forex_ohlc_indicators")


def build_marts(spark: SparkSession, raw_root: str) -> dict:
    """Mart builders over the typed raw tables under ``raw_root``; a mart is planned when its builder is called."""
    d, v = load_raw(spark, raw_root, "cdr_data"), load_raw(spark, raw_root, "cdr_voice")
    info = crm.account_info(load_raw(spark, raw_root, "accounts"), load_raw(spark, raw_root, "addresses"),
                            load_raw(spark, raw_root, "devices"))
    return {
        "cdr_data_summary": lambda: usage.usage_summary(d, v),
        "cdr_usage_rollup": lambda: usage.usage_rollup(d, v),
        "cdr_tower_sessions": lambda: sessions.tower_sessions(d, v),
        "cdr_tower_session_pairs": lambda: sessions.session_pair_summary(d, v),
        "crm_flattened": lambda: crm.crm_mart(d, v, info, ordered=False),
        "forex_ohlc_indicators": lambda: forex.ohlc_indicators(load_raw(spark, raw_root, "forex_ticks"), ordered=False),
    }


def refresh_marts(spark: SparkSession, raw_root: str, out_root: str | None = None,
                  database: str = "prepared_layers", only: tuple[str, ...] = MARTS) -> None:
    """Full refresh of every mart (B6): parquet under ``out_root`` or catalog tables in ``database``.

    Materialised tables keep their rows clustered by key within files rather
    than paying for a global sort of the fanned-out CRM rows.
    """
    marts = build_marts(spark, raw_root)
    if out_root is None:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in only:
        df = marts[name]()
        if name == "crm_flattened":
            df = df.sortWithinPartitions("msisdn", "datetime")
        materialize(df, f"{database}.{name}", f"{out_root.rstrip('/')}/{name}" if out_root else None)


def start_persistence(spark: SparkSession, raw_root: str, work_root: str, fmt: str = "json",
                      topics_path: str | None = None, bootstrap: str | None = None,
                      available_now: bool = False, compact_every: int = 360,
                      purge_after: timedelta | None = timedelta(days=30)) -> list[StreamingQuery]:
    """One stream per topic: CDR data, CDR voice, ticks → raw + quarantine (J7);
    accounts, addresses, devices change feeds → keyed tables + quarantine (J8), compacted every
    ``compact_every`` micro-batches, when tombstones older than ``purge_after`` go."""
    def src(names):
        return topics.read_topics(spark, names, fmt, topics_path, bootstrap, streaming=True)

    qs = []
    for topic, wire, kind, table in ((topics.CDR_DATA_TOPIC, schemas.CDR_DATA_WIRE, "cdr_data", "cdr_data"),
                                     (topics.CDR_VOICE_TOPIC, schemas.CDR_VOICE_WIRE, "cdr_voice", "cdr_voice"),
                                     (topics.TICK_TOPIC, schemas.TICK_WIRE, "ticks", "forex_ticks")):
        qs.append(ingest.start_raw_ingest(src([topic]), topic, wire, kind, f"{raw_root}/{table}",
                                          f"{raw_root}/_quarantine/{table}", f"{work_root}/ckpt/{table}",
                                          available_now=available_now, audit=True))
    for table, row in schemas.CDC_ROWS.items():
        qs.append(ingest.start_cdc_apply(src([topics.CDC_TOPIC_PREFIX + table]), row, schemas.CDC_KEYS[table],
                                         f"{raw_root}/{table}", f"{work_root}/ckpt/{table}", available_now=available_now,
                                         quarantine_path=f"{raw_root}/_quarantine/{table}", compact_every=compact_every,
                                         purge_after=purge_after))
    return qs


def start_ingestion(spark: SparkSession, drop_path: str, work_root: str, fmt: str = "json", topics_path: str | None = None,
                    bootstrap: str | None = None, available_now: bool = False,
                    processing_time: str = "10 seconds") -> list[StreamingQuery]:
    """CSV drops of both feeds → their topics, a folder each under ``topics_path`` or Kafka (the ingestion service)."""
    return [ingest.start_drop_ingest(spark, drop_path, kind, f"{work_root}/ckpt/ingest_{kind}", fmt, topics_path, bootstrap,
                                     available_now, processing_time) for kind in ingest.DROPS]


@dataclass(frozen=True)
class Feeds:
    """Where the usage services read both feeds: topics, a folder each under ``path`` or Kafka, and the
    CSV drops that are ingested into them first, if any."""
    work_root: str
    drop_path: str | None = None
    fmt: str = "json"
    topics_path: str | None = None
    bootstrap: str | None = None

    @property
    def path(self) -> str:
        return self.topics_path or f"{self.work_root}/topics"

    def ingestion(self, spark: SparkSession, available_now: bool, processing_time: str) -> list[StreamingQuery]:
        if self.drop_path is None:
            return []
        return start_ingestion(spark, self.drop_path, self.work_root, self.fmt, self.path, self.bootstrap, available_now, processing_time)

    def read(self, spark: SparkSession) -> tuple[quality.Split, quality.Split]:
        out = []
        for (_, wire, topic), split in zip(ingest.DROPS.values(), (quality.split_usage_data, quality.split_usage_voice)):
            folder = f"{self.path}/{topic}"
            if self.fmt == "json":
                make_folder(spark, folder)       # a topic without messages yet
            msgs = topics.read_topics(spark, [topic], self.fmt, folder, self.bootstrap, streaming=True)
            out.append(split(topics.parse_messages(msgs, wire, topic)))
        return out[0], out[1]


def start_usage_quarantine(spark: SparkSession, feeds: Feeds, service: str,
                           available_now: bool = False, processing_time: str = "10 seconds") -> list[StreamingQuery]:
    """One stream per feed: the records ``service`` cannot sum → ``work_root/quarantine/service/feed``."""
    qs, work_root = [], feeds.work_root
    for feed, split in zip(ingest.DROPS, feeds.read(spark)):
        w = (split.quarantine.writeStream.queryName(f"{service}_quarantine_{feed}_{uuid.uuid4().hex[:8]}")
             .option("checkpointLocation", f"{work_root}/ckpt/{service}_quarantine_{feed}")
             .foreachBatch(ingest.quarantine_writer(f"{work_root}/quarantine/{service}/{feed}")))
        qs.append((w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)).start())
    return qs


def _stop_with(query: StreamingQuery, aside: list[StreamingQuery]) -> StreamingQuery:
    """``query``; once it ends, for whatever reason, the streams ``aside`` are stopped."""
    def wait():
        try:
            query.awaitTermination()
        finally:
            for q in aside:
                q.stop()
    threading.Thread(target=wait, daemon=True).start()
    return query


def _beside(spark: SparkSession, feeds: Feeds, service: str, available_now: bool, processing_time: str) -> list[StreamingQuery]:
    """The streams that a usage service runs beside its own: ingestion of drops, and the quarantine."""
    started: list[StreamingQuery] = []
    for start in (lambda: feeds.ingestion(spark, available_now, processing_time),
                  lambda: start_usage_quarantine(spark, feeds, service, available_now, processing_time)):
        started += start()
        if available_now:
            for q in started:
                q.awaitTermination()
    return started


def start_usage_service(spark: SparkSession, drop_path: str | None, serving_path: str, work_root: str,
                        watermark: str | None = None, summary_path: str | None = None,
                        available_now: bool = False, buckets: int | None = None, fmt: str = "json",
                        topics_path: str | None = None, bootstrap: str | None = None,
                        processing_time: str = "10 seconds") -> StreamingQuery:
    """Topics of both feeds → typed rows → daily usage per subscriber → serving table (+ summary topic, in the
    feeds' format), and the records that cannot be summed → quarantine. With ``drop_path`` CSV drops are ingested into the
    topics first, a folder under ``work_root`` unless ``topics_path`` or Kafka is given. Ingestion and quarantine are
    streams of their own: with ``available_now`` they have ended when this returns, otherwise they run
    beside the returned one and stop with it.

    No usage is late unless a ``watermark`` is given, which drops what comes after it."""
    feeds = Feeds(work_root, drop_path, fmt, topics_path, bootstrap)
    aside = _beside(spark, feeds, "daily_usage", available_now, processing_time)
    d, v = feeds.read(spark)
    q = daily.start_daily_usage(d.good, v.good, serving_path, f"{work_root}/ckpt/daily_usage", watermark=watermark,
                                summary_path=summary_path, available_now=available_now, buckets=buckets,
                                processing_time=processing_time, fmt=fmt, bootstrap=bootstrap)
    return q if available_now else _stop_with(q, aside)


def start_idle_flush(spark: SparkSession, drop_path: str | None, summary_path: str, work_root: str,
                     idle_ms: int = 60_000, watermark: str | None = None, processing_time: str = "10 seconds",
                     fmt: str = "json", topics_path: str | None = None, bootstrap: str | None = None,
                     keep_closed_ms: int = 30 * flush.DAY_MS) -> StreamingQuery:
    """Topics of both feeds (with ``drop_path``, ingested from CSV drops) → nested daily summary per subscriber-day,
    published when the key has been idle for ``idle_ms`` (J2), and the records that cannot be summed → quarantine;
    streams of their own that stop with the returned one. With a ``watermark`` a past day's state becomes a
    closed-day record (J3) kept for ``keep_closed_ms``: usage that comes later still adds to the day's total, and
    what comes later than that is written to ``work_root/late_usage``."""
    feeds = Feeds(work_root, drop_path, fmt, topics_path, bootstrap)
    aside = _beside(spark, feeds, "idle_flush", False, processing_time)
    d, v = feeds.read(spark)
    q = flush.start_flush(d.good, v.good, summary_path, f"{work_root}/late_usage", f"{work_root}/ckpt/idle_flush", idle_ms=idle_ms,
                          watermark=watermark, keep_closed_ms=keep_closed_ms, processing_time=processing_time, fmt=fmt, bootstrap=bootstrap)
    return _stop_with(q, aside)


def start_serving_writer(spark: SparkSession, serving_path: str, work_root: str, fmt: str = "json", summary_path: str | None = None,
                         bootstrap: str | None = None, available_now: bool = False, buckets: int | None = None,
                         processing_time: str = "10 seconds") -> StreamingQuery:
    """Summary topic → serving table."""
    if fmt == "json":
        make_folder(spark, summary_path)
    msgs = topics.read_topics(spark, [topics.SUMMARY_TOPIC], fmt, summary_path, bootstrap, streaming=True)
    return daily.start_summary_to_serving(msgs, serving_path, f"{work_root}/ckpt/serving", available_now, processing_time, buckets)
