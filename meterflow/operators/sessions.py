"""Tower interaction sessions (mart 2: E12, H2s, F1, C6, C7, F6, F7).

A session is a maximal run of consecutive interactions of one subscriber on
one tower (gaps and islands). Runs are found from each row's neighbours
(``sequence.neighbours``), so no window ever spans a whole subscriber.

The source's form of this mart pairs every run-start candidate with every
later end candidate on the same tower — all pairs within a
(subscriber, tower) group, quadratic in its size. That form is not built;
see README.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import reliable_checkpoint
from .sequence import neighbours, time_chunk

KEY, TS, TOWER = "msisdn", "event_datetime", "tower_id"
# Equal timestamps on two towers are ordered by tower id.
ORDER = [TS, TOWER]


def interactions(cdr_data: DataFrame, cdr_voice: DataFrame) -> DataFrame:
    """DISTINCT (msisdn, tower_id, time) over both feeds (E12, H2s).

    The dedupe is a plain aggregate, so copies collapse map-side before any
    shuffle: a flood of identical rows never reaches one task. (Clustering by
    (msisdn, hour) first would save a shuffle but lose that map-side step.)
    """
    u = (cdr_data.select(KEY, TOWER, TS)
         .unionByName(cdr_voice.select(KEY, TOWER, F.col("start_time").alias(TS))))
    return u.distinct().withColumn("_chunk", time_chunk(TS, KEY))


def tower_interactions(cdr_data: DataFrame, cdr_voice: DataFrame) -> DataFrame:
    """Every interaction with the previous and next tower and time of its subscriber (F1)."""
    n = neighbours(interactions(cdr_data, cdr_voice), [KEY], ORDER, [TOWER, TS], "_chunk")
    return n.select(KEY, TOWER, TS, F.col("prev_tower_id").alias("prev_tower"),
                    F.col("prev_event_datetime").alias("prev_time"),
                    F.col("next_tower_id").alias("next_tower"), F.col("next_event_datetime").alias("next_time"))


def hours_between(start: Column, end: Column) -> Column:
    """EXTRACT(EPOCH FROM end - start) / 3600, from exact microseconds."""
    us = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return us.cast("double") / 3600000000


def tower_sessions(cdr_data: DataFrame, cdr_voice: DataFrame) -> DataFrame:
    """One row per maximal run on a tower with positive length.

    A run starts where the previous tower differs (or none), and ends where
    the next one differs (or none). Only those boundary rows are kept; each
    start takes the time of the next boundary row, which is its own end.
    """
    n = neighbours(interactions(cdr_data, cdr_voice), [KEY], ORDER, [TOWER], "_chunk")
    is_start = F.col("prev_tower_id").isNull() | (F.col("prev_tower_id") != F.col(TOWER))
    is_end = F.col("next_tower_id").isNull() | (F.col("next_tower_id") != F.col(TOWER))
    b = n.select(KEY, TOWER, TS, "_chunk", is_start.alias("is_start"), is_end.alias("is_end")) \
         .where(F.col("is_start") | F.col("is_end"))
    b = neighbours(b, [KEY], ORDER, [TS], "_chunk")
    end = F.when(F.col("is_end"), F.col(TS)).otherwise(F.col("next_event_datetime"))
    s = b.where("is_start").select(KEY, TOWER, F.col(TS).alias("session_start"), end.alias("session_end"))
    return (s.where(F.col("session_start") < F.col("session_end"))
            .withColumn("duration_hours", hours_between(F.col("session_start"), F.col("session_end"))))


def session_pair_summary(cdr_data: DataFrame, cdr_voice: DataFrame) -> DataFrame:
    """The source's start/end pairing (C6, D5, C7, F7), summarised per start without
    materialising a single pair.

    Start candidates are rows whose next tower is the same or that have no
    previous row; end candidates are rows whose previous tower is the same or
    that have no next row. The source joins every start with every later end
    on the same (msisdn, tower) — quadratic per group. Per start this returns
    how many such ends exist, the first and last of them, and the summed
    duration in hours: the pair relation's content at linear cost.

    Counts and sums of later ends come from running totals per
    (msisdn, tower, hour chunk) plus per-group offsets computed over the
    chunk summaries, so no window spans a whole group.
    """
    n = neighbours(interactions(cdr_data, cdr_voice), [KEY], ORDER, [TOWER], "_chunk")
    same_next = F.coalesce(F.col("next_tower_id") == F.col(TOWER), F.lit(False))
    same_prev = F.coalesce(F.col("prev_tower_id") == F.col(TOWER), F.lit(False))
    is_s = same_next | F.col("prev_tower_id").isNull()
    is_e = same_prev | F.col("next_tower_id").isNull()
    us = F.unix_micros(F.col(TS).cast("timestamp"))
    r = (n.select(KEY, TOWER, TS, "_chunk", is_s.alias("is_s"), is_e.alias("is_e"), us.alias("us"))
         .where(F.col("is_s") | F.col("is_e")))
    # Written once: the running totals and the chunk summaries both read it, and the feeds are scanned once.
    r = reliable_checkpoint(r)
    g = [KEY, TOWER]
    e_cnt = F.when(F.col("is_e"), F.lit(1)).otherwise(F.lit(0)).cast("bigint")
    # Micro sums can exceed 64 bits for a hot group: keep them exact as decimal(38,0).
    e_us = F.when(F.col("is_e"), F.col("us")).otherwise(F.lit(0)).cast("decimal(38,0)")
    e_ts = F.when(F.col("is_e"), F.col(TS))
    w = Window.partitionBy(*g, "_chunk").orderBy(F.col(TS).asc_nulls_last())
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = r.select("*", F.sum(e_cnt).over(upto).alias("c_cnt"), F.sum(e_us).over(upto).alias("c_sum"),
                 F.min(e_ts).over(w.rowsBetween(1, Window.unboundedFollowing)).alias("c_next"))
    k = r.groupBy(*g, "_chunk").agg(F.sum(e_cnt).alias("k_cnt"), F.sum(e_us).alias("k_sum"),
                                    F.min(e_ts).alias("k_first"), F.max(e_ts).alias("k_last"))
    wc = Window.partitionBy(*g).orderBy(F.col("_chunk").asc_nulls_last())
    before = wc.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*g)
    k = k.select(*g, "_chunk",
                 F.coalesce(F.sum("k_cnt").over(before), F.lit(0)).alias("off_cnt"),
                 F.coalesce(F.sum("k_sum").over(before), F.lit(0)).alias("off_sum"),
                 F.sum("k_cnt").over(whole).alias("g_cnt"), F.sum("k_sum").over(whole).alias("g_sum"),
                 F.max("k_last").over(whole).alias("g_last"),
                 F.min("k_first").over(wc.rowsBetween(1, Window.unboundedFollowing)).alias("next_first"))
    s = x.where("is_s").join(k, [*g, "_chunk"])
    n_after = (F.col("g_cnt") - F.col("off_cnt") - F.col("c_cnt")).cast("bigint")
    sum_after = F.col("g_sum") - F.col("off_sum") - F.col("c_sum")
    hours = (sum_after - n_after * F.col("us")).cast("double") / 3600000000
    out = s.select(KEY, TOWER, F.col(TS).alias("session_start"), n_after.alias("end_count"),
                   F.coalesce("c_next", "next_first").alias("first_end"), F.col("g_last").alias("last_end"),
                   hours.alias("total_duration_hours"))
    return out.where(F.col("end_count") > 0)
