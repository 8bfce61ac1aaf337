"""Keyed upsert semantics of a change feed.

The table a stream of upserts converges to is, per key, the latest change
by (modified_ts, lsn), dropped when that change is a delete. It is one
aggregate — ``max_by`` with partial aggregation — so a hot key is folded
map-side instead of being sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

ORDER = ("modified_ts", "lsn")


def latest_by_key(changes: DataFrame, keys: list[str], order: tuple[str, ...] = ORDER,
                  keep_deletes: bool = False) -> DataFrame:
    """Latest change per key; deletes removed unless ``keep_deletes``."""
    cols = [c for c in changes.columns if c not in keys]
    g = changes.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("_l"))
    out = g.select(*keys, *[F.col(f"_l.{c}").alias(c) for c in cols])
    return out if keep_deletes else out.where(~F.col("op").eqNullSafe("d"))   # a change without op is an upsert
