"""CRM flattened view with hourly cost and running balance (mart 3: D1-D4, E5, E6, F5, G1).

Costs are computed from exact integer sums (bytes, seconds) and converted
to money once, so totals and running balances do not depend on the order in
which partial sums meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.rates import RATES, Rates
from ..functions.timebuckets import hour_start
from ..session import reliable_checkpoint
from .joins import left_join
from .usage import usage_stream

ACCOUNT_INFO_COLUMNS = ["account_id", "owner_name", "email", "phone_number", "street_address", "city", "state",
                        "postal_code", "country", "device_id", "device_name", "device_type", "device_os"]
COST_COLUMNS = ["data_cost_zar", "voice_cost_zar", "total_cost_zar", "cumulative_cost_zar",
                "data_cost_wak", "voice_cost_wak", "total_cost_wak", "cumulative_cost_wak"]


def account_info(accounts: DataFrame, addresses: DataFrame, devices: DataFrame) -> DataFrame:
    """accounts ⟕ addresses ⟕ devices on account_id (D1 1:1, D2 1:N)."""
    a = accounts.select("account_id", "owner_name", "email", "phone_number")
    ad = addresses.select("account_id", "street_address", "city", "state", "postal_code", "country")
    d = devices.select("account_id", "device_id", "device_name", "device_type", "device_os")
    # Addresses are 1:1 and devices 1:N: both joins emit at most the rows of
    # their inputs, so a hot account costs one task linear work; AQE's skew
    # join splits the (left) accounts side if needed.
    return a.join(ad, "account_id", "left").join(d, "account_id", "left").select(*ACCOUNT_INFO_COLUMNS)


def data_cost(bytes_col: Column, rates: Rates = RATES) -> Column:
    return bytes_col.cast("double") * rates.data_per_byte


def voice_cost(sec_col: Column, rates: Rates = RATES) -> Column:
    # Divide instead of multiplying by an inexact 1/60: one rounding.
    if rates.voice_per_second == 1.0 / 60.0:
        return sec_col.cast("double") / 60.0
    return sec_col.cast("double") * rates.voice_per_second


def hourly_data_cost(cdr_data: DataFrame, rates: Rates = RATES) -> DataFrame:
    """Data bytes and cost per (msisdn, hour) (E5)."""
    g = (cdr_data.groupBy("msisdn", hour_start("event_datetime").alias("hour"))
         .agg(F.sum(F.col("up_bytes") + F.col("down_bytes")).cast("bigint").alias("data_bytes")))
    return g.withColumn("data_cost_zar", data_cost(F.col("data_bytes"), rates))


def hourly_voice_cost(cdr_voice: DataFrame, rates: Rates = RATES) -> DataFrame:
    """Call seconds and cost per (msisdn, hour)."""
    g = (cdr_voice.groupBy("msisdn", hour_start("start_time").alias("hour"))
         .agg(F.sum("call_duration_sec").cast("bigint").alias("voice_seconds")))
    return g.withColumn("voice_cost_zar", voice_cost(F.col("voice_seconds"), rates))


def _cost_columns(rates: Rates) -> list[Column]:
    dc = data_cost(F.col("data_bytes"), rates)
    vc = voice_cost(F.col("voice_seconds"), rates)
    return [dc.alias("data_cost_zar"), vc.alias("voice_cost_zar"), (dc + vc).alias("total_cost_zar")]


def join_hourly_costs(hourly_data: DataFrame, hourly_voice: DataFrame, rates: Rates = RATES) -> DataFrame:
    """Full outer join of the two hourly tables on (msisdn, hour), keys coalesced (D3, I4).

    Use when both hourly tables already exist; both are hash-partitioned on
    the join keys by their aggregates, so the join adds no shuffle.
    """
    j = hourly_data.select("msisdn", "hour", "data_bytes").join(
        hourly_voice.select("msisdn", "hour", "voice_seconds"), ["msisdn", "hour"], "full")
    j = j.select("msisdn", "hour", F.coalesce("data_bytes", F.lit(0)).cast("bigint").alias("data_bytes"),
                 F.coalesce("voice_seconds", F.lit(0)).cast("bigint").alias("voice_seconds"))
    return j.select("msisdn", "hour", "data_bytes", "voice_seconds", *_cost_columns(rates))


def hourly_costs(cdr_data: DataFrame, cdr_voice: DataFrame, rates: Rates = RATES) -> DataFrame:
    """The same rows as ``join_hourly_costs`` over raw feeds, as one aggregate over their
    union: every (msisdn, hour) that has data, voice or both, with zero for the
    missing side. One scan per feed, one shuffle, no join."""
    u = usage_stream(cdr_data, cdr_voice)
    g = (u.groupBy("msisdn", hour_start("event_time").alias("hour"))
         .agg((F.sum("up_bytes") + F.sum("down_bytes")).cast("bigint").alias("data_bytes"),
              F.sum("duration_sec").cast("bigint").alias("voice_seconds")))
    return g.select("msisdn", "hour", "data_bytes", "voice_seconds", *_cost_columns(rates))


def running_balance(costs: DataFrame, rates: Rates = RATES) -> DataFrame:
    """Cumulative cost per msisdn by hour (F5); WAK = ZAR x rate.

    The window is per subscriber over hourly rows, so a subscriber holds at
    most one row per hour of the time range however much traffic it has.
    """
    w = (Window.partitionBy("msisdn").orderBy(F.col("hour").asc_nulls_last())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cum = (data_cost(F.sum("data_bytes").over(w), rates) + voice_cost(F.sum("voice_seconds").over(w), rates))
    x = costs.withColumn("cumulative_cost_zar", cum)
    k = rates.wak_per_zar

    def wak(c: str) -> Column:
        return F.col(c) if k == 1.0 else F.col(c) * k

    return x.select("*", wak("data_cost_zar").alias("data_cost_wak"), wak("voice_cost_zar").alias("voice_cost_wak"),
                    wak("total_cost_zar").alias("total_cost_wak"), wak("cumulative_cost_zar").alias("cumulative_cost_wak"))


def crm_mart(cdr_data: DataFrame, cdr_voice: DataFrame, info: DataFrame, ordered: bool = True,
             rates: Rates = RATES) -> DataFrame:
    """Mart 3 end to end: hourly costs → running balance → flattened view.

    The final ORDER BY sorts the fanned-out rows (range shuffle). Pre-sorting
    the much smaller hourly rows cannot replace it: the account info is
    joined with a sort-merge join at scale, which re-partitions by hash.
    """
    # ``left_join`` reads its left side twice: the hourly rows are written once, so the feeds are scanned once.
    balance = reliable_checkpoint(running_balance(hourly_costs(cdr_data, cdr_voice, rates), rates))
    return crm_flattened(balance, info, ordered)


def crm_flattened(balance: DataFrame, info: DataFrame, ordered: bool = True) -> DataFrame:
    """Balance rows ⟕ account info on msisdn = phone_number (D4, N:M: one row per
    matching account and device, X8), ordered by msisdn, hour (G1)."""
    b = balance.select("msisdn", "hour", *COST_COLUMNS)
    # N:M on the phone number: a number shared by very many accounts multiplies
    # its hourly rows by all of them. A plain LEFT JOIN cannot split that hot
    # right-side key; ``left_join`` (an inner join over a padded right side) can.
    j = left_join(b, info, ["msisdn"], ["phone_number"])
    out = j.select("msisdn", F.col("hour").alias("datetime"), *ACCOUNT_INFO_COLUMNS, *COST_COLUMNS)
    # SQL's ascending order puts NULLs last.
    return out.orderBy(F.col("msisdn").asc_nulls_last(), F.col("datetime").asc_nulls_last()) if ordered else out
