import os

from meterflow import schemas
from meterflow.operators import quality
from meterflow.sources import files
from meterflow.streaming import daily

DATA_HDR = "msisdn,tower_id,up_bytes,down_bytes,data_type,ip_address,website_url,event_datetime\n"
VOICE_HDR = "msisdn,tower_id,call_type,dest_nr,call_duration_sec,start_time\n"
M = "27123456789"


def _drop(path, name, header, lines):
    tmp = os.path.join(path, "." + name + ".tmp")
    with open(tmp, "w") as f:
        f.write(header + "".join(l + "\n" for l in lines))
    os.replace(tmp, os.path.join(path, name))  # files appear whole, as on an upload


def _run(spark, src, base, watermark=None):
    d = quality.split_cdr_data(files.read_cdr_data(spark, src, streaming=True)).good
    v = quality.split_cdr_voice(files.read_cdr_voice(spark, src, streaming=True)).good
    q = daily.start_daily_usage(d, v, f"{base}/serving", f"{base}/ckpt", watermark=watermark)
    assert q.awaitTermination(300)
    progress = q.recentProgress
    q.stop()
    rows = {(r.date, r.category, r.usage_type): r for r in daily.read_serving(spark, f"{base}/serving").collect()}
    return rows, progress


def _dropped(progress):
    return sum(op["numRowsDroppedByWatermark"] for p in progress for op in p.get("stateOperators", []))


def test_two_drop_restart_keeps_totals_cumulative(spark, tmp_dir):
    src, base = f"{tmp_dir}/in", f"{tmp_dir}/out"
    os.makedirs(src)
    _drop(src, "cdr_data_1.csv", DATA_HDR, [f"{M},1,1000000,2000000,video,ip,u,2024-01-15 14:30:45.123456"])
    _drop(src, "cdr_voice_1.csv", VOICE_HDR, [f"{M},1,video,2700,70,2024-01-15 10:00:00",
                                               f"{M},1,video,2700,50,2024-01-15 11:00:00"])
    rows, _ = _run(spark, src, base)
    assert rows[("2024-01-15", "data", "video")].up_bytes == 1000000
    _drop(src, "cdr_data_2.csv", DATA_HDR, [f"{M},1,500000,1000000,video,ip,u,2024-01-15 20:00:00",
                                             f"{M},1,bad,1,video,ip,u,2024-01-15 20:00:00"])
    rows, _ = _run(spark, src, base)
    data, voice = rows[("2024-01-15", "data", "video")], rows[("2024-01-15", "voice", "video")]
    assert (data.up_bytes, data.down_bytes) == (1500000, 3000000)            # X2: cumulative after restart
    assert (voice.call_duration_sec, voice.call_count) == (120, 2)           # X3: both video rows kept
    assert data.data_cost_wak == round(4500000 * 49 / 2 ** 30, 2) and voice.voice_cost_wak == 2.0
    # Restart without new files: nothing reprocessed, nothing doubled.
    rows, _ = _run(spark, src, base)
    assert rows[("2024-01-15", "data", "video")].up_bytes == 1500000


def _late_case(spark, tmp_dir, watermark):
    src, base = f"{tmp_dir}/in", f"{tmp_dir}/out"
    os.makedirs(src)
    _drop(src, "cdr_data_1.csv", DATA_HDR, [f"{M},1,100,100,text,ip,u,2024-01-01 10:00:00"])
    _run(spark, src, base, watermark)
    _drop(src, "cdr_data_3.csv", DATA_HDR, [f"{M},1,100,100,text,ip,u,2024-01-05 10:00:00"])
    _run(spark, src, base, watermark)
    _drop(src, "cdr_data_5.csv", DATA_HDR, [f"{M},1,7,7,text,ip,u,2024-01-01 11:00:00"])
    return _run(spark, src, base, watermark)


def test_late_row_kept_without_watermark(spark, tmp_dir):
    rows, progress = _late_case(spark, tmp_dir, None)
    assert rows[("2024-01-01", "data", "text")].up_bytes == 107


def test_late_row_dropped_with_one_day_watermark(spark, tmp_dir):
    rows, progress = _late_case(spark, tmp_dir, "1 day")
    assert rows[("2024-01-01", "data", "text")].up_bytes == 100
    assert _dropped(progress) == 1


def test_stream_equals_batch(spark, tmp_dir):
    from meterflow.operators import usage
    src, base = f"{tmp_dir}/in", f"{tmp_dir}/out"
    os.makedirs(src)
    lines = [f"27{i % 7:09d},{i % 3},{100 + i},{200 + i},{['video', 'text'][i % 2]},ip,u,2024-01-0{1 + i % 4} 1{i % 10}:00:00"
             for i in range(200)]
    _drop(src, "cdr_data_a.csv", DATA_HDR, lines[:100])
    _drop(src, "cdr_data_b.csv", DATA_HDR, lines[100:])
    rows, _ = _run(spark, src, base)
    batch = usage.daily_type_usage(quality.split_cdr_data(files.read_cdr_data(spark, src)).good, None).collect()
    got = {(r.msisdn, r.date, r.usage_type, r.up_bytes, r.down_bytes)
           for r in daily.read_serving(spark, f"{base}/serving").collect()}
    assert got == {(r.msisdn, r.date, r.usage_type, r.up_bytes, r.down_bytes) for r in batch}
    assert schemas.DAILY_USAGE.fieldNames() == daily.read_serving(spark, f"{base}/serving").columns


def test_replayed_batch_after_failure_is_idempotent(spark, tmp_dir):
    """The sink writes, then the batch dies before its commit; on restart the
    same batch is replayed and must leave the same totals (exactly-once)."""
    src, base = f"{tmp_dir}/in", f"{tmp_dir}/out"
    os.makedirs(src)
    _drop(src, "cdr_data_1.csv", DATA_HDR, [f"{M},1,100,200,video,ip,u,2024-01-15 10:00:00",
                                             f"{M},1,1,2,video,ip,u,2024-01-15 11:00:00"])
    _drop(src, "cdr_voice_1.csv", VOICE_HDR, [f"{M},1,voice,2700,60,2024-01-15 10:00:00"])
    d = quality.split_cdr_data(files.read_cdr_data(spark, src, streaming=True)).good
    v = quality.split_cdr_voice(files.read_cdr_voice(spark, src, streaming=True)).good
    agg = daily.daily_usage_state(d, v)
    write = daily.serving_writer(f"{base}/serving")

    def write_then_die(batch, batch_id):
        write(batch, batch_id)
        raise RuntimeError("lost before commit")

    q = (agg.writeStream.outputMode("update").option("checkpointLocation", f"{base}/ckpt")
         .foreachBatch(write_then_die).trigger(availableNow=True).start())
    try:
        q.awaitTermination(300)
    except Exception:  # noqa: BLE001 - the injected failure
        pass
    assert q.exception() is not None
    first = {(r.category, r.usage_type): (r.up_bytes, r.call_duration_sec) for r in
             daily.read_serving(spark, f"{base}/serving").collect()}
    rows, _ = _run(spark, src, base)          # restart on the same checkpoint: batch replayed
    got = {(k[1], k[2]): (r.up_bytes, r.call_duration_sec) for k, r in rows.items()}
    assert got == first == {("data", "video"): (101, 0), ("voice", "voice"): (0, 60)}


def test_usage_service_wiring(spark, tmp_dir):
    from meterflow.plans.jobs import start_usage_service
    src = f"{tmp_dir}/in"
    os.makedirs(src)
    _drop(src, "cdr_data_1.csv", DATA_HDR, [f"{M},1,10,20,text,ip,u,2024-01-15 10:00:00"])
    _drop(src, "cdr_voice_1.csv", VOICE_HDR, [f"{M},1,voice,2700,30,2024-01-15 10:00:00"])
    q = start_usage_service(spark, src, f"{tmp_dir}/serving", f"{tmp_dir}/work", summary_path=f"{tmp_dir}/summary",
                            available_now=True, buckets=4)
    assert q.awaitTermination(300) and q.exception() is None
    rows = {(r.category, r.usage_type): (r.up_bytes, r.call_duration_sec, r.total_cost_wak)
            for r in daily.read_serving(spark, f"{tmp_dir}/serving").collect()}
    assert rows == {("data", "text"): (10, 0, 0.0), ("voice", "voice"): (0, 30, 0.5)}
    assert spark.read.schema("topic string, key string, value string").json(f"{tmp_dir}/summary").count() == 1


def test_state_lives_in_rocksdb(spark, tmp_dir):
    src, base = f"{tmp_dir}/in", f"{tmp_dir}/out"
    os.makedirs(src)
    _drop(src, "cdr_data_1.csv", DATA_HDR, [f"{M},1,10,20,text,ip,u,2024-01-15 10:00:00"])
    _, progress = _run(spark, src, base)
    metrics = progress[-1]["stateOperators"][0]["customMetrics"]
    assert any(k.startswith("rocksdb") for k in metrics), sorted(metrics)


def test_usage_keeps_records_whose_other_fields_are_bad(spark, tmp_dir):
    """A long URL or a bad tower costs no usage; what cannot be summed is in the quarantine; late usage stays."""
    from meterflow.plans.jobs import start_usage_service
    src = f"{tmp_dir}/in"
    os.makedirs(src)

    def run():
        q = start_usage_service(spark, src, f"{tmp_dir}/serving", f"{tmp_dir}/work", summary_path=f"{tmp_dir}/summary",
                                available_now=True, buckets=2)
        assert q.awaitTermination(300) and q.exception() is None
        return {(r.date, r.category, r.usage_type): (r.up_bytes, r.call_duration_sec)
                for r in daily.read_serving(spark, f"{tmp_dir}/serving").collect()}

    _drop(src, "cdr_data_1.csv", DATA_HDR, [f"{M},1,10,0,text,ip,{'u' * 501},2024-01-15 10:00:00", f"{M},bad,5,0,text,ip,u,2024-01-15 10:00:00",
                                            f"{M},1,2,0,,ip,u,2024-01-15 10:00:00", f"{M},1,none,0,text,ip,u,2024-01-15 10:00:00",
                                            ",1,1,0,text,ip,u,2024-01-15 10:00:00"])
    _drop(src, "cdr_voice_1.csv", VOICE_HDR, [f"{M},bad,voice,{'2' * 30},30,2024-01-15 10:00:00", f"{M},1,voice,27,30,never"])
    want = {("2024-01-15", "data", "text"): (15, 0), ("2024-01-15", "data", ""): (2, 0), ("2024-01-15", "voice", "voice"): (0, 30)}
    assert run() == want
    bad = {feed: sorted(r.errors for r in spark.read.parquet(f"{tmp_dir}/work/quarantine/daily_usage/{feed}").collect())
           for feed in ("cdr_data", "cdr_voice")}
    assert bad == {"cdr_data": ["msisdn", "up_bytes"], "cdr_voice": ["start_time"]}
    _drop(src, "cdr_data_2.csv", DATA_HDR, [f"{M},1,1,0,text,ip,u,2024-02-15 10:00:00"])
    run()
    _drop(src, "cdr_data_3.csv", DATA_HDR, [f"{M},1,100,0,text,ip,u,2024-01-15 10:00:00", f"{M},1,7,0,text,ip,u,2024-01-02 10:00:00"])
    got = run()
    assert got[("2024-01-15", "data", "text")] == (115, 0) and got[("2024-01-02", "data", "text")] == (7, 0)


def test_late_query_holds_late_rows(spark):
    from meterflow.plans.catalog import daily_late
    from meterflow.session import prepare
    prepare(spark)
    _, q = daily_late(spark, "/root/testdata/sf0.001", watermark="1 day")
    assert _dropped(q.recentProgress) > 0       # with a watermark these would be lost; the query sets none
