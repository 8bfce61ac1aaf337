import os

from meterflow import schemas
from meterflow.operators import cdc, quality
from meterflow.sinks import keyed, tables, topics as topic_sink
from pyspark.sql import functions as F

from meterflow.operators.serving import bucket_of
from meterflow.sources import cdc as cdc_src, files, raw, topics


def _write(path, name, text):
    with open(os.path.join(path, name), "w") as f:
        f.write(text)


HEADER = "msisdn,tower_id,up_bytes,down_bytes,data_type,ip_address,website_url,event_datetime\n"


def test_csv_drop_counts(spark, tmp_dir):
    _write(tmp_dir, "cdr_data_20240101_000000.csv", HEADER + "271,5,100,200,video,1.1.1.1,http://x,2024-01-01 00:00:01\n")
    _write(tmp_dir, "cdr_voice_20240101_000000.csv", "msisdn,tower_id\n271,1\n272,2\n")
    _write(tmp_dir, "other.csv", HEADER + "x,1,1,1,a,b,c,d\n")
    assert files.read_cdr_data(spark, tmp_dir).count() == 1
    assert files.read_cdr_voice(spark, tmp_dir).count() == 2


def test_bad_measure_is_quarantined_and_times_with_or_without_fraction(spark):
    w = spark.createDataFrame([("271", "5", "invalid", "200", "video", "ip", "u", "2024-01-01 00:00:01"),
                               ("271", "5", "100", "200", "video", "ip", "u", "2024-01-01 00:00:01.5"),
                               ("271", "5", "100", "200", "video", "ip", "u", "2024-01-01 00:00:02"),
                               ("271", "5", "100", "12.5", "video", "ip", "u", "yesterday")], schemas.CDR_DATA_WIRE)
    s = quality.split_cdr_data(w)
    good = s.good.orderBy("event_datetime").collect()
    assert [str(g.event_datetime) for g in good] == ["2024-01-01 00:00:01.500000", "2024-01-01 00:00:02"]
    q = {r.up_bytes: r.errors for r in s.quarantine.collect()}
    assert q == {"invalid": "up_bytes", "100": "down_bytes,event_datetime"}


def test_request_validation(spark):
    r = spark.createDataFrame([(1, None, None, None), (2, "271", "invalid", "invalid"),
                               (3, "271", "20240101000000", "20240101235959")], schemas.LOOKUP_REQUEST)
    v = {x.request_id: x.error for x in quality.validate_requests(r).collect()}
    assert v == {1: quality.MISSING_PARAMS, 2: quality.BAD_TIME, 3: None}


def test_topic_roundtrip_and_null_key(spark, tmp_dir):
    w = spark.createDataFrame([("", "1", "1", "1", "t", "i", "u", "2024-01-01 00:00:00")], schemas.CDR_DATA_WIRE)
    m = topic_sink.to_messages(w, topics.CDR_DATA_TOPIC, "msisdn")
    assert m.first().key is None
    topic_sink.write_messages(m, "json", tmp_dir + "/t")
    back = topics.parse_messages(topics.read_topics(spark, [topics.CDR_DATA_TOPIC], "json", tmp_dir + "/t"),
                                 schemas.CDR_DATA_WIRE)
    assert back.collect() == w.collect()


def _changes(spark, rows):
    """rows: (account_id, owner, modified 'YYYY-MM-DD', lsn, op)"""
    from datetime import datetime
    return spark.createDataFrame(
        [(a, o, f"{o}@x", "271", datetime.strptime(t, "%Y-%m-%d"), l, op) for a, o, t, l, op in rows],
        "account_id long, owner_name string, email string, phone_number string, modified_ts timestamp_ntz, lsn long, op string")


def test_cdc_both_envelopes_delete_and_recreate(spark):
    ch = _changes(spark, [(1, "a1", "2024-01-01", 1, "c"), (1, "a2", "2024-01-02", 2, "u"), (1, "x", "2024-01-03", 3, "d"),
                          (2, "b1", "2024-01-01", 4, "c"), (2, "b2", "2024-01-02", 5, "d"), (2, "b3", "2024-01-03", 6, "c")])
    ev = cdc_src.to_change_events(ch, schemas.ACCOUNTS, ["account_id"], "accounts")
    vals = [r.value for r in ev.collect()]
    assert any('"payload"' in v for v in vals) and any('"payload"' not in v for v in vals)
    parsed = cdc_src.parse_changes(ev, schemas.ACCOUNTS, ["account_id"])
    d = parsed.where("op = 'd'").orderBy("lsn").collect()
    assert [(x.account_id, x.owner_name) for x in d] == [(1, None), (2, None)]
    latest = cdc.latest_by_key(parsed, ["account_id"]).collect()
    assert [(x.account_id, x.owner_name) for x in latest] == [(2, "b3")]


def test_keyed_upsert_is_idempotent_and_deletes(spark, tmp_dir):
    path = tmp_dir + "/accounts"
    ch1 = _changes(spark, [(1, "a1", "2024-01-01", 1, "c"), (2, "b1", "2024-01-01", 2, "c"),
                           (3, "c1", "2024-01-01", 3, "c")])
    ch2 = _changes(spark, [(1, "a2", "2024-01-02", 4, "u"), (2, "b1", "2024-01-02", 5, "d")])
    for ch in (ch1, ch2, ch2):  # the second batch replayed
        keyed.append_changes(ch, path, ["account_id"], schemas.ACCOUNTS, buckets=2)
    cur = sorted((r.account_id, r.owner_name) for r in keyed.read_keyed(spark, path, ["account_id"], schemas.ACCOUNTS).collect())
    assert cur == [(1, "a2"), (3, "c1")]
    # Deleting every key of a bucket empties that bucket.
    keyed.append_changes(_changes(spark, [(1, "x", "2024-01-03", 6, "d"), (3, "x", "2024-01-03", 7, "d")]),
                          path, ["account_id"], schemas.ACCOUNTS, buckets=2)
    assert keyed.read_keyed(spark, path, ["account_id"], schemas.ACCOUNTS).count() == 0


def test_late_changes_neither_revive_nor_replace(spark, tmp_dir):
    path = tmp_dir + "/raw/accounts"
    whole = [(1, "a1", "2024-01-01", 1, "c"), (1, "x", "2024-01-03", 3, "d"), (1, "a2", "2024-01-02", 2, "u"),   # update after its delete
             (2, "b2", "2024-01-01", 5, "u"), (2, "b1", "2024-01-01", 4, "c"),        # same time, smaller lsn, later
             (3, "x", "2024-01-02", 7, "d"), (3, "c1", "2024-01-01", 6, "c"),         # delete before its create
             (4, "x", "2024-01-02", 8, "d"), (4, "d1", "2024-01-03", 9, "c")]         # created again
    for ch in whole:
        keyed.append_changes(_changes(spark, [ch]), path, ["account_id"], schemas.ACCOUNTS, buckets=2)
    want = sorted((r.account_id, r.owner_name) for r in cdc.latest_by_key(_changes(spark, whole), ["account_id"]).collect())
    for t in (keyed.read_keyed(spark, path, ["account_id"], schemas.ACCOUNTS), raw.load_raw(spark, tmp_dir + "/raw", "accounts")):
        assert t.columns == schemas.ACCOUNTS.fieldNames()
        assert sorted((r.account_id, r.owner_name) for r in t.collect()) == want == [(2, "b2"), (4, "d1")]


def test_serving_upsert_last_write_wins(spark, tmp_dir):
    from meterflow.operators.serving import daily_usage_rows
    tu = "msisdn string, date string, category string, usage_type string, up_bytes long, down_bytes long, call_duration_sec long, call_count long"
    a = spark.createDataFrame([("271", "2024-01-01", "data", "video", 1, 2, 0, 0),
                               ("271", "2024-01-01", "voice", "video", 0, 0, 60, 1),
                               ("271", "2024-01-02", "data", "text", 5, 5, 0, 0)], tu)
    b = spark.createDataFrame([("271", "2024-01-01", "data", "video", 10, 20, 0, 0)], tu)
    p = tmp_dir + "/serving"
    tables.write_daily_usage(daily_usage_rows(a), p)
    tables.write_daily_usage(daily_usage_rows(b), p)
    tables.write_daily_usage(daily_usage_rows(b), p)
    got = sorted((r.date, r.category, r.usage_type, r.up_bytes, r.call_duration_sec)
                 for r in spark.read.schema(schemas.DAILY_USAGE).parquet(p).collect())
    assert {r.bucket for r in raw.read_serving_table(spark, p).collect()} == {
        spark.range(1).select(bucket_of(F.lit("271"))).first()[0]}
    # Data video and voice video are separate rows; the second write replaced only its key.
    assert got == [("2024-01-01", "data", "video", 10, 0), ("2024-01-01", "voice", "video", 0, 60),
                   ("2024-01-02", "data", "text", 5, 0)]


def test_raw_writer_replay_overwrites_its_batch(spark, tmp_dir):
    from meterflow.streaming.ingest import raw_writer
    w = spark.createDataFrame([("271", "5", "1", "2", "video", "ip", "u", "2024-01-01 00:00:01"),
                               ("271", "5", "x", "2", "video", "ip", "u", "2024-01-01 00:00:01")], schemas.CDR_DATA_WIRE)
    write = raw_writer("cdr_data", f"{tmp_dir}/raw", f"{tmp_dir}/q", audit=True)
    for batch_id in (0, 0, 1):          # batch 0 replayed after a failure
        write(w, batch_id)
    raw_rows = spark.read.parquet(f"{tmp_dir}/raw")
    assert raw_rows.count() == 2 and {"ingested_at", "id"} <= set(raw_rows.columns)
    assert spark.read.parquet(f"{tmp_dir}/q").count() == 2


def test_over_length_text_is_quarantined(spark):
    w = spark.createDataFrame([("2" * 21, "5", "1", "2", "video", "ip", "u", "2024-01-01 00:00:01"),
                               ("271", "5", "1", "2", "v" * 51, "ip", "u" * 501, "2024-01-01 00:00:01"),
                               ("271", "5", "1", "2", "video", "ip", "u", "2024-01-01 00:00:01")], schemas.CDR_DATA_WIRE)
    s = quality.split_cdr_data(w)
    assert s.good.count() == 1
    assert sorted(r.errors for r in s.quarantine.collect()) == ["data_type,website_url", "msisdn"]


def test_change_without_key_is_skipped(spark):
    import json
    msgs = spark.createDataFrame([("t", "k", json.dumps({"op": "c", "after": {"owner_name": "x"}, "source": {"lsn": 1}})),
                                  ("t", "k", json.dumps({"op": "c", "after": {"account_id": 7, "owner_name": "y"},
                                                         "source": {"lsn": 2}}))], schemas.TOPIC_MESSAGE)
    got = [(r.account_id, r.owner_name) for r in cdc_src.parse_changes(msgs, schemas.ACCOUNTS, ["account_id"]).collect()]
    assert got == [(7, "y")]
