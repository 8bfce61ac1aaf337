"""CSV drops by header, topics, change logs, dead letters, stored lookups, refreshes."""

import os

import pytest
from pyspark.sql import functions as F

from meterflow import schemas
from meterflow.operators import cdc, quality, serving, usage
from meterflow.sinks import keyed, tables, topics as topic_sink
from meterflow.sources import cdc as cdc_src, files, raw, topics
from meterflow.sources.fixtures import load
from meterflow.streaming import daily, ingest

SF = "/root/testdata/sf0.001"
HEADER = ",".join(schemas.CDR_DATA_FIELDS)


def _put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/.{name}", "w", newline="", encoding="utf-8") as f:
        f.write(text)
    os.replace(f"{folder}/.{name}", f"{folder}/{name}")


def _rows(df):
    return sorted((r.msisdn or "", r.up_bytes, r.down_bytes, r.website_url) for r in df.collect())


DROPS = {"cdr_data_1.csv": 'msisdn,down_bytes,up_bytes,extra,website_url\n271,222,111,x,"http://a/?q=""x"",y"\n272,2,1,"a\nb",\n\n273\n',
         "cdr_data_2.csv": "﻿up_bytes,msisdn,down_bytes\r\n5,274,6,too,many\r\n",
         "cdr_data_3.csv": "up_bytes,msisdn\n",
         "cdr_data_4.csv": "msisdn,up_bytes,up_bytes\n275,1,2\n",
         "cdr_voice_1.csv": "msisdn\n999\n"}
WANT = [("271", "111", "222", 'http://a/?q="x",y'), ("272", "1", "2", None), ("273", None, None, None), ("274", "5", "6", None), ("275", "2", None, None)]


def test_csv_is_read_by_header_name(spark, tmp_dir):
    for name, text in DROPS.items():
        _put(tmp_dir, name, text)
    assert _rows(files.read_cdr_data(spark, tmp_dir)) == WANT
    assert files.read_cdr_data(spark, tmp_dir).columns == schemas.CDR_DATA_FIELDS


def test_csv_without_a_known_column_or_line_is_an_error(spark, tmp_dir):
    _put(f"{tmp_dir}/a", "cdr_data_1.csv", "some,thing\n1,2\n")
    with pytest.raises(ValueError, match="no column"):
        files.read_cdr_data(spark, f"{tmp_dir}/a")
    _put(f"{tmp_dir}/b", "cdr_data_1.csv", "x" * (files.HEADER_BYTES + 1))
    with pytest.raises(ValueError, match="no header"):
        files.read_cdr_data(spark, f"{tmp_dir}/b")


def test_direct_stream_refuses_another_header(spark, tmp_dir):
    names = list(reversed(schemas.CDR_DATA_FIELDS))
    _put(f"{tmp_dir}/in", "cdr_data_1.csv", ",".join(names) + "\n" + ",".join(names) + "\n")
    q = (files.read_cdr_data(spark, f"{tmp_dir}/in", streaming=True).writeStream.format("parquet")
         .option("checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start(f"{tmp_dir}/out"))
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        q.awaitTermination(120)


def test_drop_ingest_publishes_each_file_once(spark, tmp_dir):
    src, out = f"{tmp_dir}/in", f"{tmp_dir}/topics"

    def run():
        q = ingest.start_drop_ingest(spark, src, "cdr_data", f"{tmp_dir}/ck", topics_path=out, max_files_per_trigger=2)
        assert q.awaitTermination(200) and q.exception() is None
        m = topics.read_topics(spark, [topics.CDR_DATA_TOPIC], "json", out)
        return m, _rows(topics.parse_messages(m, schemas.CDR_DATA_WIRE))

    for name in ("cdr_data_1.csv", "cdr_data_2.csv", "cdr_data_3.csv"):
        _put(src, name, DROPS[name])
    assert run()[1] == WANT[:4]
    _put(src, "cdr_data_4.csv", DROPS["cdr_data_4.csv"])
    messages, rows = run()
    assert rows == WANT == run()[1]
    assert {r.key for r in messages.collect()} == {w[0] for w in WANT}


def test_replayed_batch_is_published_once(spark, tmp_dir):
    m = spark.createDataFrame([("t", "k", "v")], schemas.TOPIC_MESSAGE)
    for _ in range(2):
        topic_sink.publish_batch(m, 3, "json", f"{tmp_dir}/t")
    assert topics.read_topics(spark, ["t"], "json", f"{tmp_dir}/t").count() == 1
    assert sorted(os.listdir(f"{tmp_dir}/t")) == ["batch=3"]


def _changes(spark, rows):
    """rows: (account_id, owner, day of 2024-01, lsn, op)"""
    return spark.createDataFrame([(k, o, "e", "p", lsn, op, d) for k, o, d, lsn, op in rows],
                                 "account_id long, owner_name string, email string, phone_number string, lsn long, op string, d int").select(
        "account_id", "owner_name", "email", "phone_number", F.expr("make_timestamp_ntz(2024, 1, d, 0, 0, 0)").alias("modified_ts"), "lsn", "op")


KEYS = ["account_id"]


def _size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def _files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_bytes_written_follow_the_batch(spark, tmp_dir):
    path = f"{tmp_dir}/accounts"
    keyed.append_changes(_changes(spark, [(i, f"owner {i}", 1, i, "c") for i in range(20000)]), path, KEYS, schemas.ACCOUNTS, buckets=4)
    table, before = _size(path), _files(path)
    keyed.append_changes(_changes(spark, [(i, "new", 2, 30000 + i, "u") for i in range(8)]), path, KEYS, schemas.ACCOUNTS, buckets=4)
    assert before <= _files(path) and _size(path) - table < table / 20
    now = {r.account_id: r.owner_name for r in keyed.read_keyed(spark, path, KEYS, schemas.ACCOUNTS).collect()}
    assert len(now) == 20000 and now[3] == "new" and now[9] == "owner 9"


def test_change_log_folds_like_one_pass_and_compaction_changes_nothing(spark, tmp_dir):
    from datetime import datetime
    path = f"{tmp_dir}/accounts"
    rows = [(i % 13, f"o{i}", 1 + i * 7 % 28, i, "d" if i % 5 == 0 else None if i % 7 == 0 else "u") for i in range(120)]
    parts = [rows[k::4] for k in (2, 0, 3, 1)]
    want = sorted(map(tuple, cdc.latest_by_key(_changes(spark, rows), KEYS).select(*schemas.ACCOUNTS.fieldNames()).collect()))

    def now():
        return sorted(map(tuple, keyed.read_keyed(spark, path, KEYS, schemas.ACCOUNTS).collect()))

    for p in parts[:3]:
        keyed.append_changes(_changes(spark, p), path, KEYS, schemas.ACCOUNTS, buckets=2)
    three = now()
    assert keyed.compact(spark, path, KEYS, schemas.ACCOUNTS, ratio=1.0) and now() == three
    assert keyed.compact(spark, path, KEYS, schemas.ACCOUNTS, ratio=1.0) == []
    for _ in range(2):                                          # a replayed batch
        keyed.append_changes(_changes(spark, parts[3]), path, KEYS, schemas.ACCOUNTS, buckets=2)
    assert now() == want == sorted(map(tuple, raw.load_raw(spark, tmp_dir, "accounts").collect()))
    stored = keyed.read_log(spark, path, schemas.ACCOUNTS)
    horizon = datetime(2030, 1, 1)
    keyed.compact(spark, path, KEYS, schemas.ACCOUNTS, ratio=1.0, purge_before=horizon)
    dead = keyed.read_log(spark, path, schemas.ACCOUNTS).where("op = 'd'").count()
    assert dead > 0 and now() == want                            # tombstones with older rows stay for one more round
    keyed.compact(spark, path, KEYS, schemas.ACCOUNTS, ratio=1.0, purge_before=horizon)
    assert keyed.read_log(spark, path, schemas.ACCOUNTS).where("op = 'd'").count() == 0 and now() == want
    assert stored.schema == keyed.read_log(spark, f"{tmp_dir}/none", schemas.ACCOUNTS).schema
    assert keyed.compact(spark, f"{tmp_dir}/none", KEYS, schemas.ACCOUNTS) == []


def test_compaction_that_dies_before_deleting_leaves_right_rows(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/accounts"
    for day in (1, 2, 3):
        keyed.append_changes(_changes(spark, [(1, f"o{day}", day, day, "u"), (2, "x", day, day, "d" if day == 3 else "u")]), path, KEYS, schemas.ACCOUNTS, buckets=1)
    want = [tuple(r) for r in keyed.read_keyed(spark, path, KEYS, schemas.ACCOUNTS).collect()]

    monkeypatch.setattr(keyed, "_delete", lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost")))
    with pytest.raises(RuntimeError, match="driver lost"):
        keyed.compact(spark, path, KEYS, schemas.ACCOUNTS, ratio=1.0)
    assert [tuple(r) for r in keyed.read_keyed(spark, path, KEYS, schemas.ACCOUNTS).collect()] == want and len(want) == 1


def test_every_change_event_is_applied_or_a_dead_letter(spark, tmp_dir):
    events = ['{"op":"c","after":{"account_id":1,"owner_name":"a","modified_ts":1700000000000000},"ts_ms":1,"source":{"lsn":1}}',
              '{"payload":{"op":"u","after":{"account_id":2},"ts_ms":1,"source":{"lsn":2}}}', '{"op":"d","before":{"account_id":3},"ts_ms":5,"source":{"lsn":3}}',
              '{"after":{"account_id":4}}', "not json", "", "[]", "{}", '{"op":"u","ts_ms":1}', '{"op":"u","after":{"owner_name":"x"}}',
              '{"op":"d","before":{"owner_name":"x"}}', '{"op":"d"}', None]
    m = spark.createDataFrame([("crm.crm_system.accounts", str(i), e) for i, e in enumerate(events)], schemas.TOPIC_MESSAGE)
    s = cdc_src.split_changes(m, schemas.ACCOUNTS, KEYS)
    assert sorted(r.account_id for r in s.good.collect()) == [1, 2, 3, 4]
    dead = {int(r.key): (r.error, r.value) for r in s.dead.collect()}
    assert {k: v[0] for k, v in dead.items()} == {4: "unreadable", 5: "unreadable", 6: "unreadable", 7: "unreadable", 8: "no row image",
                                                  9: "no key", 10: "no key", 11: "no key"}
    assert all(v[1] == events[k] for k, v in dead.items())
    topic_sink.write_messages(m, "json", f"{tmp_dir}/t")
    src = topics.read_topics(spark, ["crm.crm_system.accounts"], "json", f"{tmp_dir}/t", streaming=True)
    q = ingest.start_cdc_apply(src, schemas.ACCOUNTS, KEYS, f"{tmp_dir}/table", f"{tmp_dir}/ck", buckets=1, quarantine_path=f"{tmp_dir}/dead")
    assert q.awaitTermination(200) and q.exception() is None
    assert spark.read.parquet(f"{tmp_dir}/dead").count() == len(dead)
    assert sorted(r.account_id for r in keyed.read_keyed(spark, f"{tmp_dir}/table", KEYS, schemas.ACCOUNTS).collect()) == [1, 2, 4]


def _summary(spark, msisdn, up, sent):
    u = spark.createDataFrame([(msisdn, "2024-01-15", "data", "video", up, up, 0, 0)],
                              "msisdn string, date string, category string, usage_type string, up_bytes long, down_bytes long, call_duration_sec long, call_count long")
    return topic_sink.to_messages(serving.daily_summary(u, now=F.lit(sent)), topics.SUMMARY_TOPIC, "msisdn")


def test_serving_takes_the_newest_summary_in_any_order(spark, tmp_dir):
    def send(*messages):
        for m in messages:
            topic_sink.write_messages(m, "json", f"{tmp_dir}/t")
        src = topics.read_topics(spark, [topics.SUMMARY_TOPIC], "json", f"{tmp_dir}/t", streaming=True)
        q = daily.start_summary_to_serving(src, f"{tmp_dir}/serving", f"{tmp_dir}/ck", buckets=1)
        assert q.awaitTermination(200) and q.exception() is None
        t = raw.read_serving_table(spark, f"{tmp_dir}/serving").collect()
        return {r.msisdn: (r.up_bytes, str(r.updated_at)) for r in t}

    second, first, third = (_summary(spark, "271", up, f"2024-01-16T00:00:0{k}.500000") for k, up in ((2, 20), (1, 10), (3, 30)))
    assert send(second) == {"271": (20, "2024-01-16 00:00:02.500000")}
    assert send(first) == {"271": (20, "2024-01-16 00:00:02.500000")}
    assert send(third, _summary(spark, "272", 5, "no time")) == {"271": (30, "2024-01-16 00:00:03.500000"), "272": (5, "1970-01-01 00:00:00")}


def test_lookup_reads_only_the_partitions_that_requests_name(spark, tmp_dir):
    path = f"{tmp_dir}/serving"
    rows = serving.daily_usage_rows(usage.daily_type_usage(load(spark, SF, "cdr_data"), load(spark, SF, "cdr_voice")))
    tables.write_daily_usage(rows, path, 8)
    r = spark.createDataFrame([(1, "2700000001", "20240103000000", "20240105120000"), (2, "2700000002", "20240109000000", "20240101000000"),
                               (3, None, "20240101000000", "20240131000000"), (4, "2700000003", "99990101000000", "99991231000000")], schemas.LOOKUP_REQUEST)
    v = quality.validate_requests(r)
    stored = raw.read_serving_for(spark, path, v, 8)
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "date#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    got = serving.usage_lookup(v, stored)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, serving.usage_lookup(v, rows).collect()))
    bucket = spark.range(1).select(serving.bucket_of(F.lit("2700000001"), 8)).first()[0]
    read = [r.file for r in raw.read_serving_for(spark, path, v, 8).select(F.input_file_name().alias("file")).distinct().collect()]
    assert read and {f.split("date=")[1][:10] for f in read} <= {"2024-01-03", "2024-01-04", "2024-01-05"}
    assert {f.split("/bucket=")[1].split("/")[0] for f in read} == {str(bucket)}


def test_failed_refresh_leaves_the_old_mart(spark, tmp_dir):
    def broken(n):
        return spark.range(n, numPartitions=4).select(F.when(F.col("id") == n - 1, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")).alias("id"))

    for name, path, read in (("mart", f"{tmp_dir}/marts/mart", lambda: spark.read.parquet(f"{tmp_dir}/marts/mart")),
                             ("refresh_test.mart", None, lambda: spark.table("refresh_test.mart"))):
        spark.sql("CREATE DATABASE IF NOT EXISTS refresh_test")
        tables.materialize(spark.range(5), name, path)
        with pytest.raises(Exception, match="lost"):
            tables.materialize(broken(100), name, path)
        assert read().count() == 5
        for n in (7, 8, 9):
            tables.materialize(spark.range(n), name, path)
            assert read().count() == n
        tables.materialize(spark.range(3).withColumn("more", F.lit("x")), name, path)
        assert read().columns == ["id", "more"] and read().count() == 3
    assert [x for x in os.listdir(f"{tmp_dir}/marts") if x.startswith("_old")] == []
    spark.sql("DROP DATABASE refresh_test CASCADE")
