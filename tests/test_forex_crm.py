from datetime import datetime, timedelta

from pyspark.sql import functions as F

from meterflow import schemas
from meterflow.operators import crm, forex
from helpers import cdr_data, cdr_voice, ts


def _ticks(spark, rows):
    """rows: (time, pair, bid_units, spread_units)"""
    return spark.createDataFrame([(ts(t), p, b / 10000, (b + s) / 10000, s / 10000) for t, p, b, s in rows],
                                 schemas.FOREX_TICKS)


def test_m1_candle_open_high_low_close(spark):
    t = _ticks(spark, [("2024-01-01 10:00:01", "MRVZAR", 15000, 100), ("2024-01-01 10:00:20", "MRVZAR", 16000, 100),
                       ("2024-01-01 10:00:40", "MRVZAR", 14000, 100), ("2024-01-01 10:00:59.9", "MRVZAR", 15500, 200)])
    c = forex.candles(t, 1).first()
    assert (c.open_price, c.high_price, c.low_price, c.close_price, c.tick_count) == (1.505, 1.605, 1.405, 1.56, 4)


def test_rolled_candles_equal_window_form(spark):
    base = datetime(2024, 1, 1)
    rows = [((base + timedelta(seconds=37 * i)).strftime("%Y-%m-%d %H:%M:%S"), "WAKMRV" if i % 2 else "MRVZAR",
             10000 + (i * 7919) % 10001, 100 + (i * 13) % 401) for i in range(600)]
    t = _ticks(spark, rows)
    for m in (1, 30, 60):
        got = forex.candles(t, m).select(*forex.CANDLE_COLUMNS)
        x = forex.with_mid(t).withColumn("b", F.date_trunc("hour", "tick_time") if m == 60 else (
            F.date_trunc("minute", "tick_time") if m == 1 else F.col("tick_time")))
        if m == 30:
            x = x.withColumn("b", F.expr("date_trunc('hour', tick_time) + make_dt_interval(0, 0, cast(minute(tick_time) / 30 as int) * 30, 0)"))
        ref = (x.groupBy("pair_name", F.col("b").cast("timestamp_ntz").alias("candle_time"))
               .agg(F.min_by("mid_price", "tick_time").alias("open_price"), F.max("mid_price").alias("high_price"),
                    F.min("mid_price").alias("low_price"), F.max_by("mid_price", "tick_time").alias("close_price")))
        assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0
    ind = forex.ohlc_indicators(t)
    bad = ind.where("low_price > least(open_price, close_price) OR high_price < greatest(open_price, close_price)")
    assert bad.count() == 0
    assert ind.where("atr_8 < 0 OR ema_8 <= 0").count() == 0


def test_indicators_simple_average_of_open(spark):
    rows = [(f"2024-01-01 10:{i:02d}:00", "MRVZAR", 10000 + 1000 * i, 0) for i in range(10)]
    ind = forex.ohlc_indicators(_ticks(spark, rows)).where("timeframe = 'M1'").orderBy("candle_time").collect()
    # open of minute i = (2 * (10000 + 1000 i)) / 20000 = 1 + 0.1 i; avg of the last 8 at i = 9: 1 + 0.1 * 5.5
    assert abs(ind[9].ema_8 - 1.55) < 1e-12 and abs(ind[9].ema_21 - 1.45) < 1e-12 and ind[9].atr_8 == 0.0


def test_tick_key(spark):
    t = _ticks(spark, [("2024-01-01 10:05:59.123456", "MRVZAR", 10000, 100)])
    assert forex.tick_key(t).first().message_key == "MRVZAR-2024-01-01 10:05"


def _crm_tables(spark):
    acc = spark.createDataFrame([(1, "A", "a@x", "271", None), (2, "B", "b@x", "271", None), (3, "C", "c@x", "273", None)],
                                schemas.ACCOUNTS)
    addr = spark.createDataFrame([(1, "s", "c", "GP", "0001", "ZAR", None)], schemas.ADDRESSES)
    dev = spark.createDataFrame([(10, 1, "phone", "Mobile", "iOS", None), (11, 1, "tab", "Tablet", "Android", None)],
                                schemas.DEVICES)
    return acc, addr, dev


def test_crm_fan_out_and_running_balance(spark):
    acc, addr, dev = _crm_tables(spark)
    info = crm.account_info(acc, addr, dev)
    assert info.count() == 4  # account 1 has two devices (X8), 2 and 3 none
    d = cdr_data(spark, [("271", 1, 1 << 29, 1 << 29, "video", "2024-01-01 10:10:00"),
                         ("271", 1, 1 << 29, 1 << 29, "video", "2024-01-01 12:10:00")])
    v = cdr_voice(spark, [("271", 1, "voice", 60, "2024-01-01 11:00:00"), ("271", 1, "voice", 120, "2024-01-01 12:59:59")])
    bal = crm.running_balance(crm.hourly_costs(d, v)).orderBy("hour").collect()
    assert [b.total_cost_zar for b in bal] == [49.0, 1.0, 51.0]
    assert [b.cumulative_cost_zar for b in bal] == [49.0, 50.0, 101.0]
    assert bal[-1].cumulative_cost_wak == sum(b.total_cost_wak for b in bal)
    flat = crm.crm_flattened(crm.running_balance(crm.hourly_costs(d, v)), info)
    # every hourly row x (account 1 with 2 devices + account 2): 3 hours x 3 = 9 rows
    assert flat.count() == 9
    joined = crm.join_hourly_costs(crm.hourly_data_cost(d), crm.hourly_voice_cost(v))
    assert joined.exceptAll(crm.hourly_costs(d, v)).count() == 0


def test_blocked_indicators_equal_per_pair_window(spark):
    import random
    rnd = random.Random(5)
    base = datetime(2024, 1, 1)
    rows = []
    for pair in ("MRVZAR", "WAKMRV"):
        t = base
        for _ in range(300):
            t += timedelta(minutes=rnd.choice([1, 1, 2, 7, 60, 600, 3000]))   # sparse days, gaps
            rows.append((t.strftime("%Y-%m-%d %H:%M:%S"), pair, rnd.randint(10000, 20000), rnd.randint(100, 500)))
    m1 = forex.m1_candles(_ticks(spark, rows))
    want = forex.with_indicators_per_pair(m1, "M1")
    for block in (21, 25, 64, 4096):
        got = forex.with_indicators(m1, "M1", block_rows=block)
        assert got.count() == want.count() == 600
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0, block


def test_quotes_of_any_size_are_exact_or_set_aside(spark):
    import pytest

    from meterflow.operators import quality
    wire = [("2024-01-01 00:00:00.000001", "A", 0.0000010, 0.000002, 0.0), ("2024-01-01 00:00:01", "A", 1e-8, 3e-8, 2e-8),
            ("2024-01-01 00:00:02", "A", 123456789.123456, 123456789.123457, 0.0), ("2024-01-01 00:00:03", "A", -1.5, -1.25, 0.25),
            ("2024-01-01 00:00:04", "A", 1e300, 1.0, 0.0), ("2024-01-01 00:00:05", "A", 1.1234567, 1.2, 0.0)]
    split = quality.split_ticks(spark.createDataFrame(wire, "timestamp string, pair_name string, bid_price double, ask_price double, spread double"))
    assert sorted(r["errors"] for r in split.quarantine.collect()) == ["bid_price", "bid_price", "bid_price,ask_price"]
    out = forex.candles(split.good, 1).first()
    assert (out.open_price, out.high_price, out.low_price, out.close_price, out.tick_count) == (1.5e-6, 123456789.1234565, -1.375, -1.375, 3)
    bad = spark.createDataFrame([(ts("2024-01-01 00:00:00"), "A", 1e-8, 3e-8, 0.0)], split.good.schema)
    with pytest.raises(Exception, match="finer than six decimals"):
        forex.candles(bad, 1).collect()


def test_candle_ties_on_time_go_by_price(spark):
    rows = [(ts("2024-01-01 00:00:00.5"), "A", p, p, 0.0) for p in (2.0, -3.0, 1.0)]
    out = forex.candles(spark.createDataFrame(rows, "tick_time timestamp_ntz, pair_name string, bid_price double, ask_price double, spread double"), 30).first()
    assert (out.open_price, out.close_price) == (-3.0, 2.0)
