"""Evaluate a projection once per row, even when later filters read its columns.

Catalyst pushes a filter below a projection by substituting the projected
expressions into the condition. For cheap expressions that is a win; for a
parse (``from_json``, regex checks, casts) it means the parse runs again
inside the filter — once per reference. A filter is never pushed below a
generator's output, so re-emitting the row through ``inline`` of a
one-element array pins the projection below it at the cost of one codegen'd
generate step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def evaluate_once(df: DataFrame) -> DataFrame:
    return df.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))
