import json
import os
import time

from meterflow.operators import quality
from meterflow.sources import files
from meterflow.streaming.flush import idle_flush_summaries

HDR = "msisdn,tower_id,up_bytes,down_bytes,data_type,ip_address,website_url,event_datetime\n"
VHDR = "msisdn,tower_id,call_type,dest_nr,call_duration_sec,start_time\n"


def test_idle_flush_emits_cumulative_summary(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    os.makedirs(src)
    with open(f"{src}/cdr_data_1.csv", "w") as f:
        f.write(HDR + "271,1,1000000,2000000,video,ip,u,2024-01-15 10:00:00\n271,1,500000,1000000,video,ip,u,2024-01-15 11:00:00\n")
    with open(f"{src}/cdr_voice_1.csv", "w") as f:
        f.write(VHDR + "271,1,voice,2700,60,2024-01-15 10:00:00\n271,1,voice,2700,60,2024-01-15 12:00:00\n")
    d = quality.split_cdr_data(files.read_cdr_data(spark, src, streaming=True)).good
    v = quality.split_cdr_voice(files.read_cdr_voice(spark, src, streaming=True)).good
    out = f"{tmp_dir}/summary"
    s = idle_flush_summaries(d, v, idle_ms=1500)
    q = (s.writeStream.outputMode("append").option("checkpointLocation", f"{tmp_dir}/ckpt")
         .foreachBatch(lambda b, i: None if b.isEmpty() else b.write.mode("overwrite").json(f"{out}/batch={i}"))
         .trigger(processingTime="500 milliseconds").start())
    try:
        deadline = time.time() + 120
        got = []
        while time.time() < deadline and not got:
            time.sleep(1)
            assert q.exception() is None, q.exception()
            if os.path.isdir(out):
                got = spark.read.schema("msisdn string, date string, value string").json(out).collect()
    finally:
        q.stop()
    assert len(got) == 1
    m = json.loads(got[0].value)
    assert m["data_usage"] == {"video": {"up": 1500000, "down": 3000000}}
    assert m["voice_usage"] == {"voice": {"duration": 120, "count": 2}}
    assert m["costs"]["voice_cost_wak"] == 2.0


def test_idle_flush_job_publishes_to_summary_topic(spark, tmp_dir):
    from meterflow.plans.jobs import start_idle_flush
    src = f"{tmp_dir}/in"
    os.makedirs(src)
    with open(f"{src}/cdr_data_1.csv", "w") as f:
        f.write(HDR + "271,1,100,200,text,ip,u,2024-01-15 10:00:00\n")
    with open(f"{src}/cdr_voice_1.csv", "w") as f:
        f.write(VHDR)
    out = f"{tmp_dir}/summary"
    q = start_idle_flush(spark, src, out, f"{tmp_dir}/work", idle_ms=1000, processing_time="500 milliseconds")
    try:
        got, deadline = [], time.time() + 120
        while time.time() < deadline and not got:
            time.sleep(1)
            assert q.exception() is None, q.exception()
            if os.path.isdir(out):
                got = spark.read.schema("topic string, key string, value string").json(out).collect()
    finally:
        q.stop()
    assert [(r.topic, r.key) for r in got] == [("cdr-usage-summary", "271")]
    assert json.loads(got[0].value)["data_usage"] == {"text": {"up": 100, "down": 200}}


def _wait(q, done, seconds=120):
    until = time.time() + seconds
    while time.time() < until:
        assert q.exception() is None, q.exception()
        if done():
            return
        time.sleep(0.5)
    raise AssertionError("not reached in time")


def _put(src, name, lines):
    with open(f"{src}/.{name}", "w") as f:
        f.write(HDR + "".join(x + "\n" for x in lines))
    os.replace(f"{src}/.{name}", f"{src}/{name}")


def test_closed_day_keeps_its_total_and_expired_day_sends_usage_aside(spark, tmp_dir):
    """The watermark passes day 1: its state becomes a closed-day record, and late usage adds to the published
    total. Once the record has expired, late usage goes to the side folder; the day isn't started anew."""
    from meterflow.sources import topics
    from meterflow.streaming.flush import DAY_MS, late_usage, start_flush
    src, out, late = f"{tmp_dir}/in", f"{tmp_dir}/summary", f"{tmp_dir}/late"
    os.makedirs(src)
    os.makedirs(out)
    _put(src, "cdr_data_1.csv", ["271,1,100,200,text,ip,u,2024-01-15 10:00:00"])
    d = quality.split_cdr_data(files.read_cdr_data(spark, src, streaming=True)).good
    q = start_flush(d, None, out, late, f"{tmp_dir}/ckpt", idle_ms=500, recheck_ms=500, watermark="1 hour",
                    keep_closed_ms=25_000, processing_time="300 milliseconds")

    def totals(date):
        m = topics.read_topics(spark, [topics.SUMMARY_TOPIC], "json", out)
        return sorted(v["data_usage"]["text"]["up"] for v in (json.loads(r.value) for r in m.collect()) if v["date"] == date)

    def state():
        p = q.lastProgress
        return p["stateOperators"][0]["numRowsTotal"] if p and p.get("stateOperators") else None

    try:
        _wait(q, lambda: totals("2024-01-15") == [100])
        open_rows = state()
        _put(src, "cdr_data_2.csv", ["271,1,1,1,text,ip,u,2024-03-17 10:00:00"])     # the watermark passes day 1 by far
        _wait(q, lambda: totals("2024-03-17") == [1])
        time.sleep(5)                                                                 # day 1 is looked at again and closed
        _put(src, "cdr_data_3.csv", ["271,1,7,0,text,ip,u,2024-01-15 11:00:00"])
        _wait(q, lambda: totals("2024-01-15") == [100, 107])
        time.sleep(40)                                                                # the record expires
        _put(src, "cdr_data_4.csv", ["271,1,5,2,text,ip,u,2024-01-15 12:00:00", "272,1,3,0,video,ip,u,2024-01-15 12:00:00"])
        _wait(q, lambda: len(late_usage(spark, late).collect()) == 2)
        time.sleep(3)
    finally:
        q.stop()
    assert totals("2024-01-15") == [100, 107]
    assert {tuple(r) for r in late_usage(spark, late).collect()} == {
        ("271", "2024-01-15", "data", "text", 5, 2, 0, 0), ("272", "2024-01-15", "data", "video", 3, 0, 0, 0)}
    assert open_rows and DAY_MS == 86_400_000


def test_bounded_usage_is_whole_with_the_late_part(spark, tmp_dir):
    """A watermark per feed: the fast feed closes no day of the slow one; what comes after a closed day's record
    has gone is aside and, added, gives the totals that an unbounded stream has."""
    from meterflow.streaming import daily, flush
    src, vsrc, out = f"{tmp_dir}/in", f"{tmp_dir}/voice", f"{tmp_dir}/serving"
    os.makedirs(src)
    os.makedirs(vsrc)
    d = quality.split_cdr_data(files.read_cdr_data(spark, src, streaming=True)).good
    v = quality.split_cdr_voice(files.read_cdr_voice(spark, vsrc, streaming=True)).good
    q = flush.start_bounded_usage(d, v, out, f"{tmp_dir}/late", f"{tmp_dir}/ckpt", "1 hour", keep_closed_ms=1, recheck_ms=500,
                                  processing_time="300 milliseconds", buckets=1)

    def voice(name, lines):
        with open(f"{vsrc}/.{name}", "w") as f:
            f.write(VHDR + "".join(x + "\n" for x in lines))
        os.replace(f"{vsrc}/.{name}", f"{vsrc}/{name}")

    def stored(late=True):
        try:
            rows = daily.read_serving(spark, out)
            rows = flush.with_late(rows, flush.late_usage(spark, f"{tmp_dir}/late")) if late else rows
            return {(r.date[-5:], r.category): (r.up_bytes, r.call_duration_sec, r.call_count) for r in rows.collect()}
        except Exception:  # noqa: BLE001 - not there yet, or a partition is being replaced
            return {}

    try:
        _put(src, "cdr_data_1.csv", ["271,1,100,0,text,ip,u,2024-01-15 10:00:00", "271,1,1,0,text,ip,u,2024-03-01 10:00:00"])
        voice("cdr_voice_1.csv", ["271,1,voice,2700,60,2024-01-15 10:00:00"])
        _wait(q, lambda: len(stored()) == 3)
        time.sleep(5)
        _put(src, "cdr_data_2.csv", ["271,1,7,0,text,ip,u,2024-01-15 11:00:00"])      # the voice feed is still on that day
        _wait(q, lambda: stored(late=False).get(("01-15", "data")) == (107, 0, 0))
        voice("cdr_voice_2.csv", ["271,1,voice,2700,5,2024-03-01 10:00:00"])          # now both are past it
        _wait(q, lambda: ("03-01", "voice") in stored())
        time.sleep(8)
        _put(src, "cdr_data_3.csv", ["271,1,20,0,text,ip,u,2024-01-15 12:00:00"])
        voice("cdr_voice_3.csv", ["271,1,voice,2700,30,2024-01-15 12:00:00"])
        _wait(q, lambda: stored().get(("01-15", "data")) == (127, 0, 0) and stored().get(("01-15", "voice")) == (0, 90, 2))
    finally:
        q.stop()
    kept = stored(late=False)
    assert kept[("01-15", "data")] == (107, 0, 0) and kept[("01-15", "voice")] == (0, 60, 1)
