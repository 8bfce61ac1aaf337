"""Neighbour rows in a per-key sequence without a per-key window (F1 building block).

``lag``/``lead`` over ``partitionBy(key)`` puts every row of a key in one
task; one subscriber with a third of the traffic would then sort a third of
the data alone. Here the window runs per (key, chunk) — the chunk is a coarse
time bucket that is monotone in the order — and only the first and last row
of each chunk go through a second, per-key window that stitches chunks
together. That second window sees at most two rows per chunk, so its size is
bounded by the time range, not by the traffic of the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def neighbours(df: DataFrame, key: list[str], order: list, values: list[str], chunk: str,
               prev: str = "prev_", nxt: str = "next_") -> DataFrame:
    """Add ``prev_<v>``/``next_<v>`` for each ``v`` in ``values``: the value on the
    previous/next row of the same ``key`` in ``order`` (NULL at the ends).

    ``chunk`` names a column that is non-decreasing along ``order`` within a
    key (e.g. the hour of the timestamp that leads ``order``). ``order``
    items are column names (ascending, NULLs last — SQL's default) or
    Column sort expressions.
    """
    order = [F.col(o).asc_nulls_last() if isinstance(o, str) else o for o in order]
    w = Window.partitionBy(*key, chunk).orderBy(*order)
    marks = [F.lag(F.lit(1)).over(w).isNull().alias("_first"), F.lead(F.lit(1)).over(w).isNull().alias("_last")]
    x = df.select("*", *[F.lag(v).over(w).alias(prev + v) for v in values],
                  *[F.lead(v).over(w).alias(nxt + v) for v in values], *marks)
    edge_flag = F.col("_first") | F.col("_last")
    inner = x.where(~edge_flag)
    we = Window.partitionBy(*key).orderBy(F.col(chunk).asc_nulls_last(), *order)
    fixed = [F.when(F.col("_first"), F.lag(v).over(we)).otherwise(F.col(prev + v)).alias(prev + v) for v in values]
    fixed += [F.when(F.col("_last"), F.lead(v).over(we)).otherwise(F.col(nxt + v)).alias(nxt + v) for v in values]
    keep = [c for c in x.columns if c not in {prev + v for v in values} | {nxt + v for v in values}]
    edge = x.where(edge_flag).select(*keep, *fixed)
    return inner.unionByName(edge).drop("_first", "_last")


def hour_chunk(ts: str) -> Column:
    """The hour of the leading timestamp."""
    return F.date_trunc("hour", F.col(ts))


def time_chunk(ts: str, key: str) -> Column:
    """Default chunk: the hour. Rows without a subscriber (NULL or empty) are those of everyone who
    isn't known, so their chunk is the minute: an hour of them is sixty tasks' work."""
    nobody = F.col(key).isNull() | (F.col(key) == "")
    return F.when(nobody, F.date_trunc("minute", F.col(ts))).otherwise(hour_chunk(ts))
