"""Prices of more decimals or digits than the test tables hold; changes without op."""

from datetime import datetime

from meterflow.operators import cdc, forex


def test_five_decimals_and_large_prices(spark):
    t = [datetime(2024, 1, 1, 0, 0, s) for s in (1, 2, 3)]
    ticks = spark.createDataFrame([(t[0], "A", 1.23456, 1.23458), (t[0], "B", 250000.0, 250000.0), (t[1], "B", 3e6, 3e6), (t[2], "B", 1.0, 1.0)],
                                  "tick_time timestamp_ntz, pair_name string, bid_price double, ask_price double")
    out = {r["pair_name"]: r for r in forex.ohlc_indicators(ticks).filter("timeframe = 'M1'").collect()}
    assert out["A"]["open_price"] == 1.23457
    assert [out["B"][c] for c in ("open_price", "high_price", "low_price", "close_price")] == [250000.0, 3e6, 1.0, 1.0]


def test_change_without_op_is_an_upsert(spark):
    rows = spark.createDataFrame([(1, None, 1, 1, "x"), (2, "c", 1, 1, "y"), (2, "d", 2, 2, "y")], "id int, op string, lsn long, modified_ts long, v string")
    assert [r["id"] for r in cdc.latest_by_key(rows, ["id"]).collect()] == [1]
