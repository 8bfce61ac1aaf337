"""Price ticks → OHLC candles and indicators (mart 4: C2, E7, F2-F4, B9).

Quotes carry up to six decimals (``quality.split_ticks`` sets finer ones aside),
so the mid price ``(bid + ask) / 2`` is exact in units of 1/2000000. Candles and
moving averages work on those integer units and convert to a price once at the
end; sums then do not depend on the order in which a distributed aggregate adds
them. A finer quote that reaches an operator ends the job: it is never rounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.timebuckets import bucket_start
from ..session import reliable_checkpoint

MID_SCALE = 2_000_000         # mid price units per 1.0: exact for quotes of up to six decimals
# Timeframe tags and their widths in minutes; indicator lengths.
TIMEFRAMES = (("M1", 1), ("M30", 30), ("H1", 60))
SHORT, LONG = 8, 21

CANDLE_COLUMNS = ["pair_name", "candle_time", "open_price", "high_price", "low_price", "close_price"]
INDICATOR_COLUMNS = CANDLE_COLUMNS + ["timeframe", "ema_8", "ema_21", "atr_8", "atr_21"]


def _price(units: Column) -> Column:
    return units.cast("double") / MID_SCALE


QUOTE_DECIMALS = 6
#: Units of a candle's order key per microsecond: beyond twice any mid price that is accepted.
KEY_STEP = "10000000000000000000"


def quote_is_exact(quote: Column) -> Column:
    """Whether a quote has at most six decimals and a size whose units fit the order key; a NULL quote is neither."""
    return (F.round(quote, QUOTE_DECIMALS) == quote) & (F.abs(quote) < 1e12)


def with_mid(ticks: DataFrame) -> DataFrame:
    """Adds ``mid_units`` (exact, 1/2000000) and ``mid_price``."""
    bid, ask = F.col("bid_price"), F.col("ask_price")
    whole = [F.round(q * 10 ** QUOTE_DECIMALS).cast("bigint") for q in (bid, ask)]
    units = (F.when(bid.isNull() | ask.isNull(), F.lit(None))
             .when(quote_is_exact(bid) & quote_is_exact(ask), whole[0] + whole[1])
             .otherwise(F.raise_error(F.concat(F.lit("quote finer than six decimals or out of range: "), bid, F.lit(", "), ask)).cast("bigint")))
    return ticks.withColumn("mid_units", units).withColumn("mid_price", _price(F.col("mid_units")))


def _order_key(ts: str, units: str) -> Column:
    """Time order inside the candle; ties on the timestamp are broken by the price. One number
    rather than a struct: of that, ``min_by`` and ``max_by`` run as a hash aggregate."""
    micros = F.unix_micros(F.col(ts).cast("timestamp")).cast("decimal(19,0)")
    return (micros * F.lit(KEY_STEP).cast("decimal(20,0)") + F.col(units).cast("decimal(19,0)")).cast("decimal(38,0)")


def _direct_candles(ticks: DataFrame, minutes: int) -> DataFrame:
    """Candles of one width straight from ticks: one hash aggregate, one shuffle."""
    t = with_mid(ticks)
    k = _order_key("tick_time", "mid_units")
    return (t.groupBy("pair_name", bucket_start("tick_time", minutes).alias("candle_time"))
            .agg(F.min_by("mid_units", k).alias("open_u"), F.max("mid_units").alias("high_u"),
                 F.min("mid_units").alias("low_u"), F.max_by("mid_units", k).alias("close_u"),
                 F.count(F.lit(1)).alias("tick_count")))


def m1_candles(ticks: DataFrame) -> DataFrame:
    """One-minute candles in integer units, with the tick count.

    A single hash aggregate: ``min_by``/``max_by`` pick open and close, so the
    partial aggregate runs map-side and only one row per pair-minute and task
    crosses the shuffle.
    """
    return _direct_candles(ticks, 1)


def roll_candles(m1: DataFrame, minutes: int) -> DataFrame:
    """Coarser candles from one-minute candles: open of the first minute, close of the last."""
    return (m1.groupBy("pair_name", bucket_start("candle_time", minutes).alias("bucket"))
            .agg(F.min_by("open_u", "candle_time").alias("open_u"), F.max("high_u").alias("high_u"),
                 F.min("low_u").alias("low_u"), F.max_by("close_u", "candle_time").alias("close_u"),
                 F.sum("tick_count").alias("tick_count"))
            .withColumnRenamed("bucket", "candle_time"))


def candles(ticks: DataFrame, minutes: int) -> DataFrame:
    """Priced OHLC candles for one timeframe, aggregated directly from the ticks.
    (The indicator mart instead rolls M30/H1 up from M1 to scan ticks once.)"""
    return _priced(_direct_candles(ticks, minutes), with_count=minutes == 1)


def _priced(c: DataFrame, with_count: bool = False) -> DataFrame:
    cols = ["pair_name", "candle_time"] + [_price(F.col(f"{p}_u")).alias(f"{n}_price") for p, n in
                                            (("open", "open"), ("high", "high"), ("low", "low"), ("close", "close"))]
    if with_count:
        cols.append("tick_count")
    return c.select(*cols)


def m1_candles_windowed(ticks: DataFrame) -> DataFrame:
    """The window form of the one-minute candle (F2 + E13): first/last/max/min/count over
    the whole pair-minute, then one row per pair-minute. Same values as ``candles(.., 1)``."""
    t = with_mid(ticks).withColumn("candle_time", bucket_start("tick_time", 1))
    w = (Window.partitionBy("pair_name", "candle_time").orderBy("tick_time", "mid_units")
         .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    x = t.select("pair_name", "candle_time",
                 F.first("mid_units").over(w).alias("open_u"), F.max("mid_units").over(w).alias("high_u"),
                 F.min("mid_units").over(w).alias("low_u"), F.last("mid_units").over(w).alias("close_u"),
                 F.count(F.lit(1)).over(w).alias("tick_count"))
    return _priced(x.dropDuplicates(["pair_name", "candle_time"]), with_count=True)


def with_indicators_per_pair(c: DataFrame, timeframe: str) -> DataFrame:
    """Moving averages with one window per pair (the plain form; see ``with_indicators``)."""
    base = Window.partitionBy("pair_name").orderBy(F.col("candle_time").asc_nulls_last())
    rng = F.col("high_u") - F.col("low_u")

    def avg(x: Column, n: int) -> Column:
        w = base.rowsBetween(-(n - 1), Window.currentRow)
        return F.sum(x).over(w).cast("double") / F.count(F.lit(1)).over(w) / MID_SCALE

    return _indicator_select(c, timeframe, avg(F.col("open_u"), SHORT), avg(F.col("open_u"), LONG),
                             avg(rng, SHORT), avg(rng, LONG))


def _indicator_select(c: DataFrame, timeframe: str, e8: Column, e21: Column, a8: Column, a21: Column) -> DataFrame:
    return c.select(
        "pair_name", "candle_time",
        *[_price(F.col(f"{p}_u")).alias(f"{p}_price") for p in ("open", "high", "low", "close")],
        F.lit(timeframe).alias("timeframe"),
        e8.alias("ema_8"), e21.alias("ema_21"), a8.alias("atr_8"), a21.alias("atr_21"))


BLOCK_ROWS = 4096   # candles per window partition (plus a halo of LONG - 1 rows)


def with_indicators(c: DataFrame, timeframe: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Moving averages over the last 8 / 21 candles of a pair.

    The source names them ``ema`` but they are simple averages of the open,
    and ``atr`` is the simple average of high - low; values and names are kept.
    See ``_blocked_averages`` for how the windows stay bounded.
    """
    return _blocked_averages(c.withColumn("timeframe", F.lit(timeframe)), ["pair_name", "timeframe"], block_rows)


def _blocked_averages(c: DataFrame, key: list[str], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Indicator columns per ``key`` (a pair, or a pair and timeframe) without a
    window over a whole key.

    Each candle gets its position in its key's sequence (row numbers per
    (key, day) plus the running count of earlier days — a window over one row
    per day), positions are cut into blocks of ``block_rows``, and the last
    ``LONG - 1`` candles of each block are copied into the next one so the
    21-row frames are complete there. Every window partition then holds at
    most ``block_rows + 20`` rows, however long the history and however few
    the keys.
    """
    halo = LONG - 1
    if block_rows < halo:
        raise ValueError("block_rows must be at least the longest frame")
    # The day counts and the candles themselves are two branches over the same
    # candles; materialise them once (they are small next to the ticks) so the
    # ticks are aggregated once, not once per branch.
    c = reliable_checkpoint(c)
    x = c.withColumn("_day", F.date_trunc("day", F.col("candle_time")))
    x = x.withColumn("_rn", F.row_number().over(
        Window.partitionBy(*key, "_day").orderBy(F.col("candle_time").asc_nulls_last())))
    days = x.groupBy(*key, "_day").agg(F.count(F.lit(1)).alias("_n"))
    before = (Window.partitionBy(*key).orderBy(F.col("_day").asc_nulls_last())
              .rowsBetween(Window.unboundedPreceding, -1))
    days = days.select(*key, "_day", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    x = x.join(days, [*key, "_day"]).withColumn("_idx", F.col("_off") + F.col("_rn") - 1)
    blk = F.floor(F.col("_idx") / block_rows).cast("bigint")
    own = x.withColumn("_blk", blk).withColumn("_own", F.lit(True))
    copies = (x.where(F.pmod(F.col("_idx"), F.lit(block_rows)) >= block_rows - halo)
              .withColumn("_blk", blk + 1).withColumn("_own", F.lit(False)))
    u = own.unionByName(copies)
    base = Window.partitionBy(*key, "_blk").orderBy("_idx")
    rng = F.col("high_u") - F.col("low_u")

    def avg(v: Column, n: int) -> Column:
        w = base.rowsBetween(-(n - 1), Window.currentRow)
        return F.sum(v).over(w).cast("double") / F.count(F.lit(1)).over(w) / MID_SCALE

    y = u.select("*", avg(F.col("open_u"), SHORT).alias("_e8"), avg(F.col("open_u"), LONG).alias("_e21"),
                 avg(rng, SHORT).alias("_a8"), avg(rng, LONG).alias("_a21")).where("_own")
    return y.select(
        "pair_name", "candle_time",
        *[_price(F.col(f"{p}_u")).alias(f"{p}_price") for p in ("open", "high", "low", "close")],
        "timeframe", F.col("_e8").alias("ema_8"), F.col("_e21").alias("ema_21"),
        F.col("_a8").alias("atr_8"), F.col("_a21").alias("atr_21"))


def ohlc_indicators(ticks: DataFrame, ordered: bool = True) -> DataFrame:
    """Mart 4: M1, M30 and H1 candles with indicators, one scan of the ticks (H3s, G2).

    M30 and H1 are rolled up from the M1 aggregate, whose shuffle output is
    reused by all three branches; the three timeframes then share one
    bounded moving-average pass.
    """
    m1 = m1_candles(ticks)
    tagged = None
    for tag, minutes in TIMEFRAMES:
        c = (m1 if minutes == 1 else roll_candles(m1, minutes)).select(
            "pair_name", "candle_time", "open_u", "high_u", "low_u", "close_u", F.lit(tag).alias("timeframe"))
        tagged = c if tagged is None else tagged.unionByName(c)
    # One bounded indicator pass for all three timeframes, keyed by (pair, timeframe).
    out = _blocked_averages(tagged, ["pair_name", "timeframe"])
    order = [F.col(c).asc_nulls_last() for c in ("pair_name", "timeframe", "candle_time")]
    return out.orderBy(*order) if ordered else out


def tick_key(ticks: DataFrame, ts: str = "tick_time") -> DataFrame:
    """Message key ``PAIR-yyyy-MM-dd HH:mm`` that keeps one pair-minute together."""
    return ticks.withColumn("message_key",
                            F.concat_ws("-", F.col("pair_name"), F.date_format(F.col(ts), "yyyy-MM-dd HH:mm")))
