"""Named jobs over a folder of test tables: ``(spark, sf_dir) -> DataFrame``.

Each job adapts the shared tables to the domain tables (``sources.fixtures``)
and runs one operator or mart over the whole input.
"""

from __future__ import annotations

import time
from datetime import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas
from ..functions.parsing import parse_event_time
from ..functions.timebuckets import bucket_start, day_string
from ..operators import cdc as cdc_ops
from ..operators import crm, forex, quality, serving, sessions, usage
from ..session import work_dir
from ..sinks import keyed, tables as table_sink
from ..sinks import topics as topic_sink
from ..sources import cdc as cdc_src
from ..sources import files, topics
from ..session import prepare
from ..sources.fixtures import load, load_stream
from ..sources.raw import read_serving_for
from ..streaming import daily, flush, ingest

#: Buckets of the serving table that the lookups read: the test tables hold a few MB a day.
LOOKUP_BUCKETS = 2

Job = Callable[[SparkSession, str], DataFrame]
JOBS: dict[str, Job] = {}


def job(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)
        run.__name__ = name
        run.__doc__ = fn.__doc__
        JOBS[name] = run
        return run
    return deco


# -- time functions ------------------------------------------------------------------

@job("time_buckets")
def _time_buckets(spark, sf):
    """Minute, 15-min, 30-min, hour buckets and day key of every data event."""
    d = load(spark, sf, "cdr_data")
    t = F.col("event_datetime")
    return d.select("msisdn", "event_datetime",
                    bucket_start(t, 1).alias("time_1min"), bucket_start(t, 15).alias("time_15min"),
                    bucket_start(t, 30).alias("time_30min"), bucket_start(t, 60).alias("time_1hr"),
                    day_string(t).alias("day"))


# -- mart 1 ------------------------------------------------------------------------------

@job("cdr_data_15min")
def _data_15(spark, sf):
    return usage.data_15min(load(spark, sf, "cdr_data"))


@job("cdr_voice_15min")
def _voice_15(spark, sf):
    return usage.voice_15min(load(spark, sf, "cdr_voice"))


@job("cdr_usage_summary")
def _summary(spark, sf):
    return usage.usage_summary(load(spark, sf, "cdr_data"), load(spark, sf, "cdr_voice"))


@job("cdr_usage_rollup")
def _rollup(spark, sf):
    return usage.usage_rollup(load(spark, sf, "cdr_data"), load(spark, sf, "cdr_voice"))


# -- daily usage and cost ------------------------------------------------------------------

@job("daily_data_usage")
def _daily_data(spark, sf):
    return usage.daily_data_usage(load(spark, sf, "cdr_data"))


@job("daily_voice_usage")
def _daily_voice(spark, sf):
    return usage.daily_voice_usage(load(spark, sf, "cdr_voice"))


@job("cdr_daily_costs")
def _daily_costs(spark, sf):
    return usage.daily_costs_from_feeds(load(spark, sf, "cdr_data"), load(spark, sf, "cdr_voice"))


# -- mart 4: forex -----------------------------------------------------------------------

@job("tick_mid_price")
def _mid(spark, sf):
    return forex.with_mid(load(spark, sf, "forex_ticks")).select(
        "tick_time", "pair_name", "bid_price", "ask_price", "mid_units", "mid_price")


@job("ohlc_m1")
def _m1(spark, sf):
    return forex.candles(load(spark, sf, "forex_ticks"), 1)


@job("ohlc_m30")
def _m30(spark, sf):
    return forex.candles(load(spark, sf, "forex_ticks"), 30)


@job("ohlc_h1")
def _h1(spark, sf):
    return forex.candles(load(spark, sf, "forex_ticks"), 60)


@job("ohlc_m1_windowed")
def _m1w(spark, sf):
    return forex.m1_candles_windowed(load(spark, sf, "forex_ticks"))


@job("forex_ohlc_indicators")
def _ind(spark, sf):
    return forex.ohlc_indicators(load(spark, sf, "forex_ticks"))


@job("tick_partition_key")
def _tick_key(spark, sf):
    return forex.tick_key(load(spark, sf, "forex_ticks")).select("tick_time", "pair_name", "message_key")


# -- mart 2: tower sessions --------------------------------------------------------------

@job("tower_interactions")
def _inter(spark, sf):
    return sessions.tower_interactions(load(spark, sf, "cdr_data"), load(spark, sf, "cdr_voice"))


@job("tower_sessions")
def _sessions(spark, sf):
    return sessions.tower_sessions(load(spark, sf, "cdr_data"), load(spark, sf, "cdr_voice"))


# -- mart 3: CRM -------------------------------------------------------------------------

def _info(spark, sf):
    return crm.account_info(load(spark, sf, "accounts"), load(spark, sf, "addresses"), load(spark, sf, "devices"))


@job("crm_account_info")
def _crm_info(spark, sf):
    return _info(spark, sf)


@job("hourly_data_cost")
def _hdc(spark, sf):
    return crm.hourly_data_cost(load(spark, sf, "cdr_data"))


@job("hourly_voice_cost")
def _hvc(spark, sf):
    return crm.hourly_voice_cost(load(spark, sf, "cdr_voice"))


@job("hourly_costs")
def _hc(spark, sf):
    return crm.join_hourly_costs(crm.hourly_data_cost(load(spark, sf, "cdr_data")),
                                 crm.hourly_voice_cost(load(spark, sf, "cdr_voice")))


@job("hourly_costs_union")
def _hcu(spark, sf):
    return crm.hourly_costs(load(spark, sf, "cdr_data"), load(spark, sf, "cdr_voice"))


@job("running_balance")
def _rb(spark, sf):
    return crm.running_balance(crm.hourly_costs(load(spark, sf, "cdr_data"), load(spark, sf, "cdr_voice")))


@job("crm_flattened")
def _crm(spark, sf):
    return crm.crm_mart(load(spark, sf, "cdr_data"), load(spark, sf, "cdr_voice"), _info(spark, sf))


# -- raw layer: typed parse, quarantine, topics, change feeds -------------------------------

def _wire_data(spark, sf):
    return quality.split_cdr_data(load(spark, sf, "cdr_data_wire"))


@job("cdr_data_typed")
def _data_typed(spark, sf):
    return _wire_data(spark, sf).good


@job("cdr_quarantine")
def _data_quarantine(spark, sf):
    return _wire_data(spark, sf).quarantine


@job("cdr_voice_typed")
def _voice_typed(spark, sf):
    return quality.split_cdr_voice(load(spark, sf, "cdr_voice_wire")).good


@job("cdr_voice_quarantine")
def _voice_quarantine(spark, sf):
    return quality.split_cdr_voice(load(spark, sf, "cdr_voice_wire")).quarantine


@job("timestamp_parse")
def _ts_parse(spark, sf):
    w = load(spark, sf, "cdr_data_wire")
    return w.select(F.col("event_datetime").alias("event_text"), parse_event_time("event_datetime").alias("event_time"))


def _write_drops(spark, sf):
    """The data feed as CSV drops with three headers: the usual one, one turned round with a column
    that nothing reads, and one in another order without the address."""
    rows = load(spark, sf, "cdr_data_drop")
    names = schemas.CDR_DATA_FIELDS
    path = work_dir(spark, "drops", "cdr_data")
    shapes = [names, [*reversed(names), "note"], [c for c in (names[3:] + names[:3]) if c != "ip_address"]]
    for layout, columns in enumerate(shapes):
        part = rows.where(F.col("layout") == layout).withColumn("note", F.concat(F.lit('a "note", of '), "msisdn"))
        part.select(*columns).write.mode("append").option("header", True).option("escape", '"').csv(path)
    return path


@job("cdr_csv_typed")
def _csv_typed(spark, sf):
    """A1: CSV drops whose files differ in their headers, read by column name and typed."""
    return quality.split_cdr_data(files.read_cdr_data(spark, _write_drops(spark, sf), glob="part-*")).good


@job("stream_csv_ingest")
def _stream_csv(spark, sf):
    """The same drops as a stream, a few files at a time, published to the topic by msisdn and
    persisted from there as typed rows."""
    base = work_dir(spark, "streams", "csv")
    _await(ingest.start_drop_ingest(spark, _write_drops(spark, sf), "cdr_data", f"{base}/ckpt/drops", topics_path=f"{base}/topics",
                                    max_files_per_trigger=4, glob="part-*"))
    msgs = topics.read_topics(spark, [topics.CDR_DATA_TOPIC], "json", f"{base}/topics", streaming=True, max_per_trigger=4)
    _await(ingest.start_raw_ingest(msgs, topics.CDR_DATA_TOPIC, schemas.CDR_DATA_WIRE, "cdr_data",
                                   f"{base}/raw", f"{base}/quarantine", f"{base}/ckpt/raw"))
    return spark.read.schema(schemas.CDR_DATA).parquet(f"{base}/raw").select(*schemas.CDR_DATA.fieldNames())


def _all_messages(spark, sf):
    return (topic_sink.to_messages(load(spark, sf, "cdr_data_wire"), topics.CDR_DATA_TOPIC, "msisdn")
            .unionByName(topic_sink.to_messages(load(spark, sf, "cdr_voice_wire"), topics.CDR_VOICE_TOPIC, "msisdn"))
            .unionByName(topic_sink.to_messages(load(spark, sf, "tick_wire"), topics.TICK_TOPIC, None)))


@job("cdr_to_topic_json")
def _to_topic(spark, sf):
    return topic_sink.to_messages(load(spark, sf, "cdr_data_wire"), topics.CDR_DATA_TOPIC, "msisdn")


@job("topic_json_parse")
def _topic_parse(spark, sf):
    m = topics.parse_messages(_all_messages(spark, sf), schemas.CDR_DATA_WIRE, topics.CDR_DATA_TOPIC)
    return quality.split_cdr_data(m).good


@job("ticks_typed")
def _ticks_typed(spark, sf):
    m = topics.parse_messages(_all_messages(spark, sf), schemas.TICK_WIRE, topics.TICK_TOPIC)
    return quality.split_ticks(m).good


def _changes(spark, sf, table):
    name = {"accounts": "account_changes", "addresses": "address_changes", "devices": "device_changes"}[table]
    ev = cdc_src.to_change_events(load(spark, sf, name), schemas.CDC_ROWS[table], schemas.CDC_KEYS[table], table)
    return cdc_src.parse_changes(ev, schemas.CDC_ROWS[table], schemas.CDC_KEYS[table])


@job("cdc_parse_changes")
def _cdc_parse(spark, sf):
    return _changes(spark, sf, "accounts")


@job("cdc_latest_accounts")
def _cdc_acc(spark, sf):
    return cdc_ops.latest_by_key(_changes(spark, sf, "accounts"), ["account_id"]).drop("op", "lsn")


@job("cdc_latest_addresses")
def _cdc_addr(spark, sf):
    return cdc_ops.latest_by_key(_changes(spark, sf, "addresses"), ["account_id"]).drop("op", "lsn")


@job("cdc_latest_devices")
def _cdc_dev(spark, sf):
    return cdc_ops.latest_by_key(_changes(spark, sf, "devices"), ["device_id"]).drop("op", "lsn")


# -- daily serving table and lookups --------------------------------------------------------

def _type_usage(spark, sf):
    return usage.daily_type_usage(load(spark, sf, "cdr_data"), load(spark, sf, "cdr_voice"))


@job("daily_usage_rows")
def _rows(spark, sf):
    return serving.daily_usage_rows(_type_usage(spark, sf))


@job("daily_summary_rows")
def _summary_rows(spark, sf):
    return serving.summary_to_rows(serving.daily_summary(_type_usage(spark, sf)))


@job("daily_summary_nested")
def _nested(spark, sf):
    """The nested summary message per subscriber-day, as its JSON body
    (without the emission timestamp, which is wall-clock time)."""
    s = serving.daily_summary(_type_usage(spark, sf))
    body = F.struct("msisdn", "date", "data_usage", "voice_usage", "costs")
    return s.select("msisdn", "date", F.to_json(body).alias("summary"))


@job("classify_usage")
def _classify(spark, sf):
    return serving.classify_usage(serving.daily_usage_rows(_type_usage(spark, sf)))


@job("lookup_request_errors")
def _req_errors(spark, sf):
    v = quality.validate_requests(load(spark, sf, "lookup_requests"))
    return v.where(F.col("error").isNotNull()).select("request_id", "msisdn", "start_time", "end_time", "error")


def _stored_rows(spark, sf, requests):
    """The serving table, written, and read for the requests."""
    path = work_dir(spark, "serving")
    table_sink.write_daily_usage(serving.daily_usage_rows(_type_usage(spark, sf)), path, LOOKUP_BUCKETS)
    return read_serving_for(spark, path, requests, LOOKUP_BUCKETS)


@job("usage_lookup_response")
def _lookup_response(spark, sf):
    """The JSON answer to every valid request, from the stored serving table."""
    v = quality.validate_requests(load(spark, sf, "lookup_requests"))
    return serving.lookup_responses(v, _stored_rows(spark, sf, v))


@job("usage_lookup")
def _lookup(spark, sf):
    """The rows of every valid request, from the stored serving table."""
    v = quality.validate_requests(load(spark, sf, "lookup_requests"))
    return serving.usage_lookup(v, _stored_rows(spark, sf, v))


# -- streams -----------------------------------------------------------------------------

STREAM_TIMEOUT_S = 900
# The test tables hold a few MB of serving rows per day: one bucket per date
# keeps each partition one file. (Cluster tables use SERVING_BUCKETS.)
FIXTURE_SERVING_BUCKETS = 1
FIXTURE_KEYED_BUCKETS = 4


def _await(q) -> None:
    """Bounded wait for an availableNow query (H5)."""
    try:
        done = q.awaitTermination(STREAM_TIMEOUT_S)
        if not done:
            raise TimeoutError(f"stream {q.name or q.id} did not finish in {STREAM_TIMEOUT_S}s")
        if q.exception():
            raise RuntimeError(str(q.exception()))
    finally:
        if q.isActive:
            q.stop()


def _daily_stream(spark, sf, watermark, summary=False):
    base = work_dir(spark, "streams", "daily")
    q = daily.start_daily_usage(load_stream(spark, sf, "cdr_data"), load_stream(spark, sf, "cdr_voice"),
                                f"{base}/serving", f"{base}/checkpoint", watermark=watermark,
                                summary_path=f"{base}/summary" if summary else None,
                                buckets=FIXTURE_SERVING_BUCKETS)
    _await(q)
    return base


@job("stream_daily_usage")
def _stream_daily(spark, sf):
    """Daily usage state in update mode, upserted into the serving table."""
    base = _daily_stream(spark, sf, None)
    return daily.read_serving(spark, f"{base}/serving").select(*daily.TYPE_USAGE_COLUMNS)


def daily_late(spark, sf, watermark=None):
    """The newest day in a first run of the daily stream, all earlier usage in a second one on the
    same checkpoint; the folder and the second run's query."""
    base = work_dir(spark, "streams", "daily-late")
    feeds = {"cdr_data": "event_datetime", "cdr_voice": "start_time"}
    whole = {name: load(spark, sf, name) for name in feeds}
    newest = max((t for t in (whole[n].agg(F.max(F.to_date(c))).first()[0] for n, c in feeds.items()) if t), default=None)
    for late in (False, True):
        for name, c in feeds.items():
            part = F.to_date(c).eqNullSafe(F.lit(newest).cast("date"))
            whole[name].where(~part if late else part).write.mode("append").parquet(f"{base}/{name}")
        d, v = (spark.readStream.schema(whole[n].schema).parquet(f"{base}/{n}") for n in feeds)
        q = daily.start_daily_usage(d, v, f"{base}/serving", f"{base}/checkpoint", watermark=watermark,
                                    buckets=FIXTURE_SERVING_BUCKETS)
        _await(q)
    return base, q


@job("stream_daily_usage_late")
def _stream_daily_late(spark, sf):
    """The newest day first, then all earlier usage, days late: nothing is dropped."""
    base, _ = daily_late(spark, sf)
    return daily.read_serving(spark, f"{base}/serving").select(*daily.TYPE_USAGE_COLUMNS)


@job("stream_daily_summary")
def _stream_summary(spark, sf):
    """Nested summaries published per touched subscriber-day, read back and flattened."""
    base = _daily_stream(spark, sf, None, summary=True)
    m = spark.read.schema(schemas.TOPIC_MESSAGE).json(f"{base}/summary")
    s = topics.parse_messages(m, schemas.USAGE_SUMMARY)
    return s.select("msisdn", "date", F.size("data_usage").alias("data_types"),
                    F.size("voice_usage").alias("voice_types"), "costs.*")


def _write_topic(spark, sf, name, topic, key):
    path = work_dir(spark, "topics", topic)
    topic_sink.write_messages(topic_sink.to_messages(load(spark, sf, name), topic, key).repartition(6), "json", path)
    return path


@job("stream_raw_ingest")
def _stream_raw(spark, sf):
    """A JSON topic of data-usage records streamed, a few files a micro-batch, into the typed raw table + quarantine."""
    tpath = _write_topic(spark, sf, "cdr_data_wire", topics.CDR_DATA_TOPIC, "msisdn")
    base = work_dir(spark, "streams", "raw")
    msgs = topics.read_topics(spark, [topics.CDR_DATA_TOPIC], "json", tpath, streaming=True, max_per_trigger=2)
    q = ingest.start_raw_ingest(msgs, topics.CDR_DATA_TOPIC, schemas.CDR_DATA_WIRE, "cdr_data",
                                f"{base}/raw", f"{base}/quarantine", f"{base}/checkpoint")
    _await(q)
    return spark.read.schema(schemas.CDR_DATA).parquet(f"{base}/raw").select(*schemas.CDR_DATA.fieldNames())


def _stream_changes(spark, sf, table):
    """A change feed applied continuously to its keyed table, in four parts out of order: older changes
    and updates of deleted keys come late; the table is compacted on the way."""
    name = {"accounts": "account_changes", "addresses": "address_changes", "devices": "device_changes"}[table]
    row, keys = schemas.CDC_ROWS[table], schemas.CDC_KEYS[table]
    path = work_dir(spark, "topics", f"cdc-{table}")
    base = work_dir(spark, "streams", "cdc")
    changes = load(spark, sf, name)
    for part in range(4):
        ev = cdc_src.to_change_events(changes.where(F.pmod(F.xxhash64("lsn"), F.lit(4)) == part), row, keys, table)
        topic_sink.write_messages(ev, "json", path)
        msgs = topics.read_topics(spark, [topics.CDC_TOPIC_PREFIX + table], "json", path, streaming=True)
        q = ingest.start_cdc_apply(msgs, row, keys, f"{base}/table", f"{base}/checkpoint", buckets=FIXTURE_KEYED_BUCKETS,
                                   compact_every=2, ratio=1.2)
        _await(q)
    return keyed.read_keyed(spark, f"{base}/table", keys, row)


@job("stream_cdc_accounts")
def _stream_cdc(spark, sf):
    """The account change feed."""
    return _stream_changes(spark, sf, "accounts")


@job("stream_cdc_addresses")
def _stream_cdc_addresses(spark, sf):
    """The address change feed."""
    return _stream_changes(spark, sf, "addresses")


@job("stream_cdc_devices")
def _stream_cdc_devices(spark, sf):
    """The device change feed."""
    return _stream_changes(spark, sf, "devices")


@job("stream_cdc_dead_letters")
def _stream_dead(spark, sf):
    """The account change feed with events cut short, without a row image and without a key; what
    cannot be applied is in the side table with its reason."""
    keys, row = schemas.CDC_KEYS["accounts"], schemas.ACCOUNTS
    base = work_dir(spark, "streams", "cdc-dead")
    changes = load(spark, sf, "account_changes")
    ev = cdc_src.to_change_events(changes, row, keys, "accounts").withColumn("lsn", F.regexp_extract("value", r'"lsn":(\d+)', 1).cast("long"))
    value = (F.when(F.col("lsn") % 53 == 0, F.substring("value", 1, 40))
             .when(F.col("lsn") % 59 == 0, F.regexp_replace("value", '"after":\\{[^}]*\\},?', ""))
             .when(F.col("lsn") % 61 == 0, F.regexp_replace("value", '"account_id":\\d+,?', "")).otherwise(F.col("value")))
    topic_sink.write_messages(ev.select("topic", F.col("lsn").cast("string").alias("key"), value.alias("value")), "json", f"{base}/topic")
    msgs = topics.read_topics(spark, [topics.CDC_TOPIC_PREFIX + "accounts"], "json", f"{base}/topic", streaming=True)
    _await(ingest.start_cdc_apply(msgs, row, keys, f"{base}/table", f"{base}/checkpoint", buckets=FIXTURE_KEYED_BUCKETS,
                                  quarantine_path=f"{base}/quarantine"))
    dead = spark.read.schema("topic string, key string, value string, error string").option("recursiveFileLookup", True).parquet(f"{base}/quarantine")
    return dead.select(F.col("key").cast("long").alias("lsn"), "error")


@job("stream_summary_to_serving")
def _stream_serving(spark, sf):
    """Nested summaries of every subscriber-day from the topic into the serving table; the newest version
    of each comes first and an older one, of half the usage, after it."""
    base = work_dir(spark, "streams", "serving")
    usage_rows = _type_usage(spark, sf)
    half = usage_rows.select(*usage_rows.columns[:4], *[F.floor(F.col(c) / 2).cast("bigint").alias(c) for c in usage_rows.columns[4:]])
    for rows, sent in ((usage_rows, "2024-06-01T00:00:02.000000"), (half, "2024-06-01T00:00:01.000000")):
        msgs = topic_sink.to_messages(serving.daily_summary(rows, now=F.lit(sent)), topics.SUMMARY_TOPIC, "msisdn")
        topic_sink.write_messages(msgs, "json", f"{base}/topic")
        src = topics.read_topics(spark, [topics.SUMMARY_TOPIC], "json", f"{base}/topic", streaming=True)
        _await(daily.start_summary_to_serving(src, f"{base}/serving", f"{base}/checkpoint", buckets=FIXTURE_SERVING_BUCKETS))
    return daily.read_serving(spark, f"{base}/serving")


FLUSH_TIMEOUT_S, IDLE_MS, RECHECK_MS = 300, 1000, 3000


def _in_parts(spark, sf, base, start, idle_ms=None):
    """Both feeds in three parts while a stream runs: most of all days but the newest, then the newest day, which
    closes the others, then the rest of the closed days. The next part follows once the stream has ended a micro-batch
    with all rows so far and, if it publishes days that have been idle for ``idle_ms``, one that had all of them due."""
    feeds = {"cdr_data": "event_datetime", "cdr_voice": "start_time"}
    whole = {name: load(spark, sf, name) for name in feeds}
    newest = max((t for t in (whole[n].agg(F.max(F.to_date(c))).first()[0] for n, c in feeds.items()) if t), default=None)
    streams = []
    for name, c in feeds.items():
        part = F.when(F.to_date(c) == F.lit(newest).cast("date"), 1).when(F.pmod(F.xxhash64("msisdn", c), F.lit(5)) == 0, 2).otherwise(0)
        whole[name] = whole[name].withColumn("part", part)
        table_sink.make_folder(spark, f"{base}/{name}")
        streams.append(spark.readStream.schema(whole[name].drop("part").schema).option("recursiveFileLookup", True).parquet(f"{base}/{name}"))

    q, before = start(*streams), {}
    try:
        for part in range(3):
            for name in feeds:
                whole[name].where(F.col("part") == part).drop("part").write.parquet(f"{base}/staged-{name}-{part}")
            kept = [whole[n].where(F.col("part") <= part).drop("part") for n in feeds]
            rows = sum(k.count() for k in kept)
            # Side by side, so that one micro-batch takes both: each looks at every subscriber's state.
            for name in feeds:
                table_sink.publish_folder(spark, f"{base}/staged-{name}-{part}", f"{base}/{name}/{part}")
            _until(q, lambda: _rows_in(q, before), lambda got: got >= rows)
            if idle_ms is not None:
                _until(q, lambda: _published_since(q.recentProgress, idle_ms), bool)
            if part == 1:
                # The watermark has moved with the next micro-batch; after that the keys are looked at again.
                last, since = _last_batch(q), time.time()
                _until(q, lambda: _last_batch(q), lambda got: got >= last + 3 and time.time() > since + 2 * RECHECK_MS / 1000)
    finally:
        q.stop()


def _last_batch(q) -> int:
    return q.lastProgress["batchId"] if q.lastProgress else -1


def _published_since(progress, idle_ms: int) -> bool:
    """Whether a micro-batch has ended that began ``idle_ms`` or more after the last one with rows had ended: all that
    these changed was due by then."""
    spans = [(began := datetime.fromisoformat(p["timestamp"]).timestamp() * 1000, began + p["durationMs"].get("triggerExecution", 0), p["numInputRows"])
             for p in progress]
    taken = max((ended for _, ended, rows in spans if rows), default=0)
    return any(began >= taken + idle_ms for began, _, _ in spans)


def _rows_in(q, batches: dict) -> int:
    """Rows of all micro-batches that have ended; ``batches`` keeps those seen so far."""
    batches.update({p["batchId"]: p["numInputRows"] for p in q.recentProgress})
    return sum(batches.values())


def _until(q, far, enough) -> None:
    """Wait until ``far()``, how far the running stream has come, is ``enough``. A micro-batch under way is waited
    for, however long it takes; it is an error if ``far()`` has stayed the same for the bounded time while the
    stream was idle, or ended a micro-batch begun since. A look shows what was there when it began, and may itself
    wait for the stream's tasks: only what came before the look counts against it. Looks take half of the time at most."""
    at, since, batch = None, time.time(), _last_batch(q)
    while True:
        began, idle = time.time(), not q.status["isTriggerActive"]
        last = _last_batch(q)
        if enough(got := far()):
            return
        if q.exception():
            raise RuntimeError(str(q.exception()))
        if got != at:
            at, since, batch = got, time.time(), _last_batch(q)
        elif began > since + FLUSH_TIMEOUT_S and (last > batch + 1 or last == batch and idle):
            raise TimeoutError(f"stream {q.id} came no further than {got} in {FLUSH_TIMEOUT_S}s")
        time.sleep(max(1, time.time() - began))


@job("stream_idle_flush")
def _stream_flush(spark, sf):
    """The feeds in three parts; the last summary published of each subscriber-day holds all of its usage,
    together with what came after its record had expired and was written aside."""
    base = work_dir(spark, "streams", "flush")
    table_sink.make_folder(spark, f"{base}/summary")

    def published():
        m = spark.read.schema(schemas.TOPIC_MESSAGE).option("recursiveFileLookup", True).json(f"{base}/summary")
        s = topics.parse_messages(m, schemas.USAGE_SUMMARY)
        return s.groupBy("msisdn", "date").agg(F.max_by(F.struct(*s.columns), "timestamp").alias("s")).select("s.*")

    def aside():
        return flush.late_usage(spark, f"{base}/late")

    _in_parts(spark, sf, base, lambda d, v: flush.start_flush(
        d, v, f"{base}/summary", f"{base}/late", f"{base}/checkpoint", idle_ms=IDLE_MS, recheck_ms=RECHECK_MS, watermark="1 hour",
        processing_time="1 second"), IDLE_MS)
    return flush.repaired(published(), aside()).select(
        "msisdn", "date", F.size("data_usage").alias("data_types"), F.size("voice_usage").alias("voice_types"), "costs.*")


@job("stream_daily_usage_bounded")
def _stream_bounded(spark, sf):
    """The feeds in three parts into the serving table with a watermark per feed and state that goes when its day
    is closed; the usage that then comes late is written aside, and added to the stored totals."""
    base = work_dir(spark, "streams", "bounded")

    def stored():
        return flush.with_late(daily.read_serving(spark, f"{base}/serving"), flush.late_usage(spark, f"{base}/late"))

    _in_parts(spark, sf, base, lambda d, v: flush.start_bounded_usage(
        d, v, f"{base}/serving", f"{base}/late", f"{base}/checkpoint", "1 hour", keep_closed_ms=1, recheck_ms=RECHECK_MS,
        processing_time="1 second", buckets=FIXTURE_SERVING_BUCKETS))
    return stored().select(*daily.TYPE_USAGE_COLUMNS)


@job("tower_session_pair_summary")
def _pair_summary(spark, sf):
    return sessions.session_pair_summary(load(spark, sf, "cdr_data"), load(spark, sf, "cdr_voice"))
