import datetime

from meterflow import schemas
from meterflow.operators.serving import daily_usage_rows, usage_lookup
from meterflow.operators.quality import validate_requests
from meterflow.sinks import tables
from meterflow.sources import raw

TU = ("msisdn string, date string, category string, usage_type string, up_bytes long, down_bytes long, "
      "call_duration_sec long, call_count long")


def test_append_raw_and_load_raw(spark, tmp_dir):
    rows = [("271", 5, 1, 2, "video", "ip", "u", datetime.datetime(2024, 1, 1, 0, 0, 1))]
    df = spark.createDataFrame(rows, schemas.CDR_DATA)
    tables.append_raw(df, f"{tmp_dir}/raw/cdr_data")
    tables.append_raw(df, f"{tmp_dir}/raw/cdr_data")
    back = raw.load_raw(spark, f"{tmp_dir}/raw", "cdr_data")
    assert back.count() == 2 and back.schema == schemas.CDR_DATA


def test_audit_columns(spark):
    df = spark.createDataFrame([("a",), ("b",)], "x string")
    out = tables.with_audit(df).collect()
    assert len({r.id for r in out}) == 2 and all(r.ingested_at is not None for r in out)


def test_materialize_overwrites(spark, tmp_dir):
    p = f"{tmp_dir}/mart"
    tables.materialize(spark.range(5), "m", p)
    tables.materialize(spark.range(3), "m", p)
    assert spark.read.parquet(p).count() == 3


def test_serving_scan_and_lookup_literal_case(spark, tmp_dir):
    tu = spark.createDataFrame([("2712345678", "2024-01-01", "data", "video", 1000000, 2000000, 0, 0),
                                ("2712345678", "2024-01-02", "data", "video", 7, 7, 0, 0)], TU)
    p = f"{tmp_dir}/serving"
    tables.write_daily_usage(daily_usage_rows(tu), p)
    assert raw.scan_serving(spark, p, "2712345678", "2024-01-01", "2024-01-01").count() == 1
    s = raw.scan_serving(spark, p, "2712345678", "2024-01-01", "2024-01-01", buckets=64)
    plan = s._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters")[1][:300]
    assert s.count() == 1
    req = spark.createDataFrame([(1, "2712345678", "20240101000000", "20240101235959")], schemas.LOOKUP_REQUEST)
    r = usage_lookup(validate_requests(req), spark.read.schema(schemas.DAILY_USAGE).parquet(p)).collect()
    assert [(x.category, x.usage_type, x.total, x.measure, x.start_time) for x in r] == [
        ("data", "video", 3000000, "bytes", "2024-01-01 00:00:00")]
    assert (r[0].request_start, r[0].request_end) == ("2024-01-01 00:00:00", "2024-01-01 23:59:59")


def test_zero_byte_data_row_classified_as_call_by_rule(spark):
    from meterflow.operators.serving import classify_usage
    tu = spark.createDataFrame([("271", "2024-01-01", "data", "text", 0, 0, 0, 0),
                                ("271", "2024-01-01", "voice", "voice", 0, 0, 30, 1)], TU)
    got = {(r.usage_type, r.category, r.total, r.measure) for r in classify_usage(daily_usage_rows(tu)).collect()}
    # The bytes rule cannot tell an empty data session from a call (X14); the stored category can.
    assert got == {("text", "call", 0, "seconds"), ("voice", "call", 30, "seconds")}


def test_lookup_response_body_shape(spark):
    import json
    from meterflow.operators.serving import lookup_responses
    tu = spark.createDataFrame([("2712345678", "2024-01-01", "data", "video", 1000000, 2000000, 0, 0)], TU)
    req = spark.createDataFrame([(1, "2712345678", "20240101000000", "20240101235959"),
                                 (2, "2799999999", "20240101000000", "20240101235959"),
                                 (3, None, None, None)], schemas.LOOKUP_REQUEST)
    got = {r.request_id: json.loads(r.response) for r in
           lookup_responses(validate_requests(req), daily_usage_rows(tu)).collect()}
    assert got == {
        1: {"msisdn": "2712345678", "start_time": "2024-01-01 00:00:00", "end_time": "2024-01-01 23:59:59",
            "usage": [{"category": "data", "usage_type": "video", "total": 3000000, "measure": "bytes",
                       "start_time": "2024-01-01 00:00:00"}]},
        2: {"msisdn": "2799999999", "start_time": "2024-01-01 00:00:00", "end_time": "2024-01-01 23:59:59",
            "usage": []}}


def test_upsert_reads_only_touched_partitions(spark, tmp_dir):
    from meterflow.operators.serving import with_bucket
    rows = [(f"27{i:08d}", f"2024-01-{1 + i % 20:02d}", "data", "video", i, i, 0, 0) for i in range(400)]
    p = f"{tmp_dir}/serving"
    tables.write_daily_usage(daily_usage_rows(spark.createDataFrame(rows, TU)), p, buckets=8)
    batch = with_bucket(daily_usage_rows(spark.createDataFrame(rows[:2], TU)), 8)
    read = raw.read_serving_table(spark, p).where(tables.partition_filter(batch, ["date", "bucket"]))
    plan = read._jdf.queryExecution().executedPlan().toString()
    pf = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "date" in pf and "bucket" in pf
    # Two touched (date, bucket) pairs: at most 2 dates x 2 buckets are listed, not 20 x 8.
    assert read.select("date", "bucket").distinct().count() <= 4
    tables.write_daily_usage(daily_usage_rows(spark.createDataFrame([("2700000000", "2024-01-01", "data", "video",
                                                                      99, 99, 0, 0)], TU)), p, buckets=8)
    after = raw.read_serving_table(spark, p)
    assert after.count() == 400
    assert after.where("msisdn = '2700000000'").first().up_bytes == 99


def test_serving_files_are_clustered_by_key(spark, tmp_dir):
    import glob
    import random
    import pyarrow.parquet as pq
    rnd = random.Random(2)
    rows = [(f"27{rnd.randint(0, 50):08d}", "2024-01-01", rnd.choice(["data", "voice"]), rnd.choice(["video", "text", "voice"]),
             rnd.randint(0, 9), 1, 1, 1) for _ in range(300)]
    tu = spark.createDataFrame(rows, TU).dropDuplicates(["msisdn", "date", "category", "usage_type"])
    p = f"{tmp_dir}/serving"
    tables.write_daily_usage(daily_usage_rows(tu), p, buckets=2)
    files = glob.glob(f"{p}/date=*/bucket=*/*.parquet")
    assert files
    for f in files:
        t = pq.read_table(f).to_pydict()
        keys = list(zip(t["msisdn"], t["hour"], t["category"], t["usage_type"]))
        assert keys == sorted(keys)
