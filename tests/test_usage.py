from pyspark.sql import functions as F

from meterflow.functions.timebuckets import bucket_start, day_string
from meterflow.operators import usage
from helpers import cdr_data, cdr_voice, empty_data, empty_voice

M = "27123456789"


def test_day_key(spark):
    df = spark.createDataFrame([("2023-11-05 23:59:59.999999",)], ["s"]).select(F.col("s").cast("timestamp_ntz").alias("t"))
    assert df.select(day_string("t")).first()[0] == "2023-11-05"


def test_per_type_sums_same_day(spark):
    d = cdr_data(spark, [(M, 3, 71, 8001, "audio", "2023-11-05 00:00:00"), (M, 4, 6, 13, "audio", "2023-11-05 23:59:59.999999"),
                         (M, 4, 900, 1, "audio", "2023-11-06 00:00:00")])
    r = usage.daily_data_usage(d).orderBy("date").collect()
    assert [(x.date, x.up_bytes, x.down_bytes) for x in r] == [("2023-11-05", 77, 8014), ("2023-11-06", 900, 1)]


def test_voice_sum_and_count(spark):
    v = cdr_voice(spark, [(M, 1, "video", 41, "2023-11-05 07:00:00"), (M, 2, "video", 2, "2023-11-05 09:30:00")])
    r = usage.daily_voice_usage(v).first()
    assert (r.call_duration_sec, r.call_count) == (43, 2)


def test_rates_one_gib_and_one_minute(spark):
    d = cdr_data(spark, [(M, 1, 1 << 29, 1 << 29, "video", "2024-01-15 10:00:00")])
    v = cdr_voice(spark, [(M, 1, "voice", 60, "2024-01-15 11:00:00")])
    r = usage.daily_costs(usage.daily_type_usage(d, v)).first()
    assert (r.data_cost_wak, r.voice_cost_wak, r.total_cost_wak) == (49.0, 1.0, 50.0)


def test_cost_rounds_half_up_on_exact_value(spark):
    # 90 s = 1.5 ZAR exactly; 1 s = 0.016666.. -> 0.02; 30 s = 0.50
    v = cdr_voice(spark, [(M, 1, "voice", 90, "2024-01-15 10:00:00"), ("b", 1, "voice", 1, "2024-01-15 10:00:00"),
                          ("c", 1, "voice", 30, "2024-01-15 10:00:00")])
    r = {x.msisdn: x.voice_cost_wak for x in usage.daily_costs(usage.daily_type_usage(None, v)).collect()}
    assert r == {M: 1.5, "b": 0.02, "c": 0.5}


def test_five_data_types_five_groups(spark):
    types = ["video", "audio", "image", "text", "application"]
    d = cdr_data(spark, [(M, 1, 10, 10, t, "2024-01-15 10:00:00") for t in types])
    assert usage.daily_data_usage(d).count() == 5


def test_buckets(spark):
    df = spark.createDataFrame([("2024-01-01 10:44:59.999999",)], ["s"]).select(F.col("s").cast("timestamp_ntz").alias("t"))
    r = df.select(*[bucket_start("t", m).cast("string") for m in (1, 15, 30, 60)]).first()
    assert tuple(r) == ("2024-01-01 10:44:00", "2024-01-01 10:30:00", "2024-01-01 10:30:00", "2024-01-01 10:00:00")


def test_faithful_summary_vs_rollup_three_buckets_in_one_hour(spark):
    # Three 15-min groups in one hour -> the faithful mart has three 1hr rows, the rollup one.
    d = cdr_data(spark, [(M, 1, 1, 2, "video", "2024-01-01 10:01:00"), (M, 1, 1, 2, "video", "2024-01-01 10:20:00"),
                         (M, 1, 1, 2, "video", "2024-01-01 10:50:00")])
    s = usage.usage_summary(d, empty_voice(spark))
    r = usage.usage_rollup(d, empty_voice(spark))
    assert s.where("interval_type = '1hr'").count() == 3
    assert s.where("interval_type = '30min'").count() == 3
    one = r.where("interval_type = '1hr'").collect()
    assert len(one) == 1 and one[0].total_bytes == 9 and one[0].session_count == 3
    assert r.where("interval_type = '30min'").count() == 2


def test_rollup_sums_equal_at_every_grain(spark):
    d = cdr_data(spark, [(M, i % 3, 100 + i, 200 + i, "text", f"2024-01-01 {10 + i // 7:02d}:{(i * 7) % 60:02d}:00")
                         for i in range(40)])
    v = cdr_voice(spark, [(M, 1, "voice", 10 + i, f"2024-01-01 1{i % 5}:{(i * 11) % 60:02d}:00") for i in range(20)])
    r = usage.usage_rollup(d, v).groupBy("interval_type").agg(F.sum("total_bytes").alias("b"),
                                                               F.sum("call_duration_sec").alias("s"),
                                                               F.sum("session_count").alias("n"))
    vals = {x.interval_type: (x.b, x.s, x.n) for x in r.collect()}
    assert vals["15min"] == vals["30min"] == vals["1hr"]
    assert vals["1hr"][2] == 60


def test_empty_inputs(spark):
    assert usage.usage_summary(empty_data(spark), empty_voice(spark)).count() == 0


def _half_up_cents(x):
    from fractions import Fraction
    c = Fraction(x) * 100
    return int(c + Fraction(1, 2)) if c >= 0 else -int(-c + Fraction(1, 2))


def test_cents_equal_exact_rational_half_up(spark):
    import random
    from fractions import Fraction
    rnd = random.Random(11)
    vals = [(rnd.randint(0, 1 << 40), rnd.randint(0, 10 ** 7)) for _ in range(400)]
    # Multiples of 2^23 bytes land on and next to half-cent boundaries.
    vals += [(k << 23, s) for k in range(0, 40) for s in (0, 3, 30)]
    df = spark.createDataFrame(vals, "b long, s long")
    got = df.select("b", "s", usage.data_cents("b").alias("d"), usage.voice_cents("s").alias("v"),
                    usage.total_cents("b", "s").alias("t")).collect()
    for r in got:
        d, v = Fraction(r.b * 49, 1 << 30), Fraction(r.s, 60)
        assert (r.d, r.v, r.t) == (_half_up_cents(d), _half_up_cents(v), _half_up_cents(d + v)), r


def test_python_cents_match_spark_cents(spark):
    vals = [(b, s) for b in (0, 1, 1 << 23, 16 << 23, 123456789, 1 << 40) for s in (0, 1, 30, 90, 3599)]
    df = spark.createDataFrame(vals, "b long, s long")
    got = df.select("b", "s", usage.data_cents("b"), usage.voice_cents("s"), usage.total_cents("b", "s")).collect()
    for r in got:
        assert tuple(r)[2:] == usage.cents_of(r.b, r.s)


def test_rollup_equals_brute_force(spark):
    import random
    from collections import defaultdict
    from datetime import datetime, timedelta
    rnd = random.Random(3)
    base = datetime(2024, 1, 1)
    data = [(f"27{rnd.randint(0, 3):08d}", 1, rnd.randint(1, 9), rnd.randint(1, 9), rnd.choice(["video", "text"]),
             (base + timedelta(seconds=rnd.randint(0, 6 * 3600))).strftime("%Y-%m-%d %H:%M:%S")) for _ in range(300)]
    voice = [(f"27{rnd.randint(0, 3):08d}", 1, rnd.choice(["voice", "video"]), rnd.randint(1, 99),
              (base + timedelta(seconds=rnd.randint(0, 6 * 3600))).strftime("%Y-%m-%d %H:%M:%S")) for _ in range(200)]
    want = defaultdict(lambda: [0, 0, 0, 0])
    for tag, n in usage.INTERVALS:
        for m, _, up, down, typ, t in data:
            ts = datetime.strptime(t, "%Y-%m-%d %H:%M:%S")
            b = ts.replace(minute=(ts.minute // n) * n if n < 60 else 0, second=0)
            w = want[(tag, m, b, typ, "data")]
            w[0] += up; w[1] += down; w[3] += 1
        for m, _, typ, sec, t in voice:
            ts = datetime.strptime(t, "%Y-%m-%d %H:%M:%S")
            b = ts.replace(minute=(ts.minute // n) * n if n < 60 else 0, second=0)
            w = want[(tag, m, b, typ, "voice")]
            w[2] += sec; w[3] += 1
    got = {(r.interval_type, r.msisdn, r.datetime, r.usage_type, r.category):
           [r.total_up_bytes, r.total_down_bytes, r.call_duration_sec, r.session_count]
           for r in usage.usage_rollup(cdr_data(spark, data), cdr_voice(spark, voice)).collect()}
    assert got == dict(want)
