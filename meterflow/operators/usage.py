"""Usage summaries (mart 1: E1-E4) and daily usage and cost.

Both CDR feeds are first narrowed to one usage stream
``(msisdn, event_time, category, usage_type, up, down, duration, calls)`` so
each summary is a single scan of each source, one union and one aggregate
with map-side partial aggregation — no per-branch rescans, no self-joins.
"""

from __future__ import annotations

from fractions import Fraction
from functools import lru_cache
from math import gcd

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.rates import RATES, Rates
from ..functions.timebuckets import bucket_start, day_string

# Interval tags and their bucket widths in minutes, category tags.
INTERVALS = (("15min", 15), ("30min", 30), ("1hr", 60))
DATA, VOICE = "data", "voice"


def _zero() -> Column:
    return F.lit(0).cast("bigint")


def usage_stream(cdr_data: DataFrame | None, cdr_voice: DataFrame | None) -> DataFrame:
    """Narrow union of the data and voice feeds (H4s)."""
    parts = []
    if cdr_data is not None:
        parts.append(cdr_data.select(
            "msisdn", F.col("event_datetime").alias("event_time"), F.lit(DATA).alias("category"),
            F.col("data_type").alias("usage_type"), F.col("up_bytes").cast("bigint").alias("up_bytes"),
            F.col("down_bytes").cast("bigint").alias("down_bytes"), _zero().alias("duration_sec"),
            _zero().alias("calls")))
    if cdr_voice is not None:
        parts.append(cdr_voice.select(
            "msisdn", F.col("start_time").alias("event_time"), F.lit(VOICE).alias("category"),
            F.col("call_type").alias("usage_type"), _zero().alias("up_bytes"), _zero().alias("down_bytes"),
            F.col("call_duration_sec").cast("bigint").alias("duration_sec"), F.lit(1).cast("bigint").alias("calls")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# -- E1 / E2: the 15-minute grain ------------------------------------------------

def data_15min(cdr_data: DataFrame) -> DataFrame:
    """Data usage per (msisdn, data_type, 15-min bucket), with its 30-min and hour buckets."""
    t15 = bucket_start("event_datetime", 15)
    g = (cdr_data.groupBy("msisdn", "data_type", t15.alias("time_15min"))
         .agg(F.sum("up_bytes").cast("bigint").alias("total_up_bytes"),
              F.sum("down_bytes").cast("bigint").alias("total_down_bytes"),
              F.count(F.lit(1)).alias("session_count")))
    return g.select("msisdn", "data_type", "time_15min",
                    bucket_start("time_15min", 30).alias("time_30min"),
                    bucket_start("time_15min", 60).alias("time_1hr"),
                    "total_up_bytes", "total_down_bytes", "session_count")


def voice_15min(cdr_voice: DataFrame) -> DataFrame:
    """Voice usage per (msisdn, call_type, 15-min bucket)."""
    t15 = bucket_start("start_time", 15)
    g = (cdr_voice.groupBy("msisdn", "call_type", t15.alias("time_15min"))
         .agg(F.sum("call_duration_sec").cast("bigint").alias("total_duration_sec"),
              F.count(F.lit(1)).alias("call_count")))
    return g.select("msisdn", "call_type", "time_15min",
                    bucket_start("time_15min", 30).alias("time_30min"),
                    bucket_start("time_15min", 60).alias("time_1hr"),
                    "total_duration_sec", "call_count")


# -- E3 / E4: mart 1 -----------------------------------------------------------------

SUMMARY_COLUMNS = ["interval_type", "msisdn", "datetime", "usage_type", "category", "total_up_bytes",
                   "total_down_bytes", "total_bytes", "call_duration_sec", "session_count"]


def _tagged_buckets(ts: Column) -> Column:
    """array<struct<interval_type, datetime>> of the three buckets of ``ts``."""
    return F.array(*[F.struct(F.lit(tag).alias("interval_type"), bucket_start(ts, m).alias("datetime"))
                     for tag, m in INTERVALS])


def _summary_select(df: DataFrame) -> DataFrame:
    return df.select(
        "interval_type", "msisdn", "datetime", "usage_type", "category",
        F.col("up").alias("total_up_bytes"), F.col("down").alias("total_down_bytes"),
        (F.col("up") + F.col("down")).alias("total_bytes"),
        F.col("dur").alias("call_duration_sec"), F.col("n").alias("session_count"))


def _sums(df: DataFrame, keys: list) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.sum("up_bytes").cast("bigint").alias("up"), F.sum("down_bytes").cast("bigint").alias("down"),
        F.sum("duration_sec").cast("bigint").alias("dur"), F.count(F.lit(1)).alias("n"))


def usage_summary(cdr_data: DataFrame, cdr_voice: DataFrame) -> DataFrame:
    """Mart 1 as the source defines it (X5): 15-min groups tagged 15min/30min/1hr.

    The 30min and 1hr rows are *not* re-aggregated: a bucket has one row per
    15-minute group inside it. One aggregate at the 15-min grain, then a
    shuffle-free explode into the three tags.
    """
    u = usage_stream(cdr_data, cdr_voice)
    g = _sums(u, ["category", "msisdn", "usage_type", bucket_start("event_time", 15).alias("t15")])
    x = g.select("*", F.inline(_tagged_buckets(F.col("t15"))))
    return _summary_select(x)


def usage_rollup(cdr_data: DataFrame, cdr_voice: DataFrame) -> DataFrame:
    """Mart 1 as intended: exactly one row per (interval, bucket, msisdn, type, category).

    Each event is tagged with its three buckets and aggregated once; partial
    aggregation folds the tags map-side before the single shuffle.
    """
    u = usage_stream(cdr_data, cdr_voice)
    x = u.select("*", F.inline(_tagged_buckets(F.col("event_time"))))
    g = _sums(x, ["interval_type", "datetime", "category", "msisdn", "usage_type"])
    return _summary_select(g)


# -- E9 / E10 / E11: daily usage and cost ------------------------------------------------

def daily_data_usage(cdr_data: DataFrame) -> DataFrame:
    """Up/down bytes per (msisdn, day, data_type)."""
    return (cdr_data.groupBy("msisdn", day_string("event_datetime").alias("date"), "data_type")
            .agg(F.sum("up_bytes").cast("bigint").alias("up_bytes"),
                 F.sum("down_bytes").cast("bigint").alias("down_bytes")))


def daily_voice_usage(cdr_voice: DataFrame) -> DataFrame:
    """Call seconds and call count per (msisdn, day, call_type)."""
    return (cdr_voice.groupBy("msisdn", day_string("start_time").alias("date"), "call_type")
            .agg(F.sum("call_duration_sec").cast("bigint").alias("call_duration_sec"),
                 F.count(F.lit(1)).alias("call_count")))


def daily_type_usage(cdr_data: DataFrame | None, cdr_voice: DataFrame | None) -> DataFrame:
    """Both daily aggregates in one pass: per (msisdn, date, category, usage_type)."""
    u = usage_stream(cdr_data, cdr_voice)
    return (u.groupBy("msisdn", day_string("event_time").alias("date"), "category", "usage_type")
            .agg(F.sum("up_bytes").cast("bigint").alias("up_bytes"),
                 F.sum("down_bytes").cast("bigint").alias("down_bytes"),
                 F.sum("duration_sec").cast("bigint").alias("call_duration_sec"),
                 F.sum("calls").cast("bigint").alias("call_count")))


# Exact money rounding. A cost is bytes x (data rate) or seconds x (voice
# rate); each rate is an exact fraction (49 / 2^30 and 1 / 60 ZAR). Cents are
# rounded half-up on the exact rational value in integer arithmetic, so the
# result does not depend on floating-point order or on the engine:
# cents = floor((2 * num + den) / (2 * den)) for a cost of num / den cents.

@lru_cache
def _rate(x: float) -> Fraction:
    """The exact fraction a configured double rate stands for (49/2^30 is exact
    in binary; 1/60 is recovered from its nearest double)."""
    f = Fraction(x)
    return f if f.denominator <= 1 << 40 else f.limit_denominator(10 ** 6)


def cents_of(total_bytes: int, seconds: int, rates: Rates = RATES) -> tuple[int, int, int]:
    """The same three roundings in plain Python (for per-key state code)."""
    d = _rate(rates.data_per_byte) * 100 * total_bytes
    v = _rate(rates.voice_per_second) * 100 * seconds

    def half_up(x: Fraction) -> int:
        return (2 * x.numerator + x.denominator) // (2 * x.denominator)
    return half_up(d), half_up(v), half_up(d + v)


def _half_up_sql(num_sql: str, den: int) -> str:
    return f"(({num_sql}) * 2 + {den}) div {2 * den}"


def data_cents(total_bytes: str, rates: Rates = RATES) -> Column:
    """Cents for ``total_bytes`` of data."""
    r = _rate(rates.data_per_byte) * 100
    return F.expr(_half_up_sql(f"`{total_bytes}` * {r.numerator}", r.denominator))


def voice_cents(seconds: str, rates: Rates = RATES) -> Column:
    """Cents for ``seconds`` of calls."""
    r = _rate(rates.voice_per_second) * 100
    return F.expr(_half_up_sql(f"`{seconds}` * {r.numerator}", r.denominator))


def total_cents(total_bytes: str, seconds: str, rates: Rates = RATES) -> Column:
    """Cents of data + voice, rounded once on the exact sum."""
    d, v = _rate(rates.data_per_byte) * 100, _rate(rates.voice_per_second) * 100
    den = d.denominator * v.denominator // gcd(d.denominator, v.denominator)
    num = f"`{total_bytes}` * {d.numerator * (den // d.denominator)} + `{seconds}` * {v.numerator * (den // v.denominator)}"
    return F.expr(_half_up_sql(num, den))


def cents_to_amount(c: Column) -> Column:
    return c.cast("double") / 100.0


def daily_costs(type_usage: DataFrame) -> DataFrame:
    """Cost per (msisdn, day): data, voice and total, each rounded to 2 decimals (E11),
    from per-type daily rows (as the stream keeps them)."""
    g = (type_usage.groupBy("msisdn", "date")
         .agg(F.sum(F.col("up_bytes") + F.col("down_bytes")).cast("bigint").alias("data_bytes"),
              F.sum("call_duration_sec").cast("bigint").alias("voice_seconds")))
    return _priced_days(g)


def daily_costs_from_feeds(cdr_data: DataFrame | None, cdr_voice: DataFrame | None) -> DataFrame:
    """The same costs straight from the feeds: one aggregate, one shuffle."""
    u = usage_stream(cdr_data, cdr_voice)
    g = (u.groupBy("msisdn", day_string("event_time").alias("date"))
         .agg((F.sum("up_bytes") + F.sum("down_bytes")).cast("bigint").alias("data_bytes"),
              F.sum("duration_sec").cast("bigint").alias("voice_seconds")))
    return _priced_days(g)


def _priced_days(g: DataFrame) -> DataFrame:
    return g.select("msisdn", "date", "data_bytes", "voice_seconds",
                    cents_to_amount(data_cents("data_bytes")).alias("data_cost_wak"),
                    cents_to_amount(voice_cents("voice_seconds")).alias("voice_cost_wak"),
                    cents_to_amount(total_cents("data_bytes", "voice_seconds")).alias("total_cost_wak"))
