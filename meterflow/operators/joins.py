"""Left outer join that stays balanced when the right side has a hot key.

AQE splits a skewed partition of a LEFT OUTER sort-merge join only on its
left side, so a key holding a third of the right side's rows lands in one
task. An INNER join can be split on either side. This join therefore first
adds to the right side one NULL-padded row for every distinct left key that
has no match (computed from the distinct keys only — small), then inner-joins
on a null-safe key: every left row meets its matches, or exactly its padded
row — the rows of ``left ⟕ right`` — in one pass over the large inputs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def left_join(left: DataFrame, right: DataFrame, left_keys: list[str], right_keys: list[str] | None = None,
              right_cols: list[str] | None = None) -> DataFrame:
    """``left ⟕ right`` on ``left_keys = right_keys`` (SQL semantics: a NULL key
    matches nothing). Output: all left columns, then ``right_cols`` (default:
    right columns not in ``left``)."""
    right_keys = right_keys or left_keys
    rcols = right_cols or [c for c in right.columns if c not in left.columns]
    jk = [f"_jk{i}" for i in range(len(left_keys))]

    def all_set(cols):
        return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])

    # Right rows that can match, with their join key copied to _jk*.
    real = right.where(all_set(right_keys)).select(
        *[F.col(rk).alias(j) for rk, j in zip(right_keys, jk)], *[F.col(c) for c in rcols])
    # Distinct left keys without a match (NULL keys included) get one padded row.
    lkeys = left.select(*[F.col(lk).alias(j) for lk, j in zip(left_keys, jk)]).distinct()
    rkeys = real.select(*jk).distinct()
    missing = lkeys.join(rkeys, reduce(lambda a, b: a & b, [lkeys[j].eqNullSafe(rkeys[j]) for j in jk]), "left_anti")
    padded = missing.select(*jk, *[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in rcols])
    ext = real.unionByName(padded)
    cond = reduce(lambda a, b: a & b, [left[lk].eqNullSafe(ext[j]) for lk, j in zip(left_keys, jk)])
    # Sort-merge: the strategy AQE can split on a skewed key from either side.
    return left.join(ext.hint("merge"), cond, "inner").select(*[left[c] for c in left.columns],
                                                              *[ext[c] for c in rcols])
