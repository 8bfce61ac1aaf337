"""Mixing sources to target weights by temperature.

Each source's share of the tokens is raised to an exponent and normalised. The
exponent lies between 0 (all sources alike) and 1 (natural shares); it is found
by bisection as the larger of the one that meets the target entropy and the one
that meets the repetition limit (no source read more than so many times). Every
bisection step is an aggregate over the table of sources, which stays in Spark;
a step looks at seven inner points, three halvings at once.

The weights are realised against a token budget: a source is read as often in
full as its share of the budget allows, and the rest is a prefix of a seeded
permutation of its blocks, and of the rows within a block. Sums run over blocks
first and then within each block, so a source of any size is dealt over tasks.

Defined cases: a null source is the source ''; a null text has no tokens; a
source without tokens has weight 0 and its rows 0 copies; repeated rows are
separate rows; an empty table gives no row; other columns pass through ``mix``
unless they clash with the added ones, which then replace them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import WORD, save, whole_row

ADDED = ["n_tokens", "weight", "copies"]


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def permuted(seed: int, what: Column) -> Column:
    """A seeded order of values: 32 hex digits."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(what.cast("string"), F.lit(""))).cast("binary"))


def _bisect(sources: DataFrame, ok, passes: int = 14) -> float:
    """The smallest exponent in [0, 1], to 2^-42, for which ``ok`` holds; it holds from there on up to 1.
    ``ok(a)`` is a boolean aggregate over the sources."""
    lo, hi = 0.0, 1.0
    for _ in range(passes):
        inner = [lo + (hi - lo) * i / 8 for i in range(1, 8)]
        got = sources.agg(*[ok(a).alias(f"ok{i}") for i, a in enumerate(inner)]).first()
        points = [lo, *inner, hi]
        first = next((i + 1 for i, x in enumerate(got) if x), 8)
        lo, hi = points[first - 1], points[first]
    return hi


def exponent(sources: DataFrame, target_entropy: float | None, repeat_limit: float | None, budget: int) -> float:
    """``sources`` has share (> 0) and tokens. The smallest exponent that satisfies what is given:
    entropy of at most ``target_entropy`` nats, no source read over ``repeat_limit`` times."""
    p = F.col("share")
    found = [0.0]
    if target_entropy is not None:
        z, s = (lambda a: F.sum(F.pow(p, F.lit(a)))), (lambda a: F.sum(F.pow(p, F.lit(a)) * F.log(p)))
        found.append(_bisect(sources, lambda a: F.log(z(a)) - F.lit(a) * s(a) / z(a) <= target_entropy))
    if repeat_limit is not None:
        z = lambda a: F.sum(F.pow(p, F.lit(a)))
        found.append(_bisect(sources, lambda a: F.max(F.pow(p, F.lit(a)) / F.col("tokens")) * budget / z(a) <= repeat_limit))
    return max(found)


def plan(docs: DataFrame, evenness: float | None = 0.5, repeat_limit: float | None = 4.0, budget: int | None = None,
         block_rows: int = 1024, seed: int = 0, id_col: str = "doc_id") -> DataFrame:
    """Per row: id, mix_source, n_tokens, weight of its source, copies, and block, block_rank, offset: its place in
    the permutation of the last, partial reading.

    ``evenness`` sets the target entropy between the natural one (0) and that of equal shares (1);
    ``budget`` defaults to the tokens of the table and may be at most ``repeat_limit`` times those."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce("source", F.lit("")).alias("mix_source"),
                       word_count(F.col("text")).alias("n_tokens"))
    rows = save(rows.withColumn("order", permuted(seed, F.col("id"))), "mix-rows")
    stats = save(rows.groupBy("mix_source").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("n_rows")), "mix-sources")
    total, n = stats.filter("tokens > 0").agg(F.sum("tokens"), F.count(F.lit(1))).first()
    budget = total if budget is None else budget
    if total and repeat_limit is not None and budget > repeat_limit * total:
        raise ValueError("the budget needs every source more often than the repetition limit allows")
    live = stats.filter("tokens > 0").withColumn("share", F.col("tokens") / F.lit(total))
    alpha, z = 1.0, 1.0
    if total:
        target = None
        if evenness is not None:
            natural = live.agg(-F.sum(F.col("share") * F.log("share"))).first()[0]
            target = natural + evenness * (math.log(n) - natural)
        alpha = exponent(live, target, repeat_limit, budget)
        z = live.agg(F.sum(F.pow("share", F.lit(alpha)))).first()[0]
    weight = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(total or 1), F.lit(alpha)) / F.lit(z)).otherwise(0.0)
    goal = F.floor(weight * F.lit(budget or 0)).cast("long")
    stats = save(stats.select("mix_source", weight.alias("weight"), F.ceil(F.col("n_rows") / block_rows).alias("n_blocks"),
                              F.when(F.col("tokens") > 0, F.floor(goal / F.col("tokens"))).otherwise(0).alias("full"),
                              F.when(F.col("tokens") > 0, goal % F.col("tokens")).otherwise(0).alias("rest")), "mix-goals")
    unit = F.conv(F.substring("order", 1, 8), 16, 10).cast("long")
    rows = rows.join(stats, "mix_source").withColumn("block", F.floor(unit * F.col("n_blocks") / F.lit(1 << 32)).cast("long"))
    blocks = rows.groupBy("mix_source", "block").agg(F.sum("n_tokens").alias("block_tokens"))
    place = Window.partitionBy("mix_source").orderBy(permuted(seed, F.concat_ws("|", "mix_source", "block")))
    blocks = blocks.select("mix_source", "block", F.row_number().over(place).cast("long").alias("block_rank"),
                           (F.sum("block_tokens").over(place.rowsBetween(Window.unboundedPreceding, 0))
                            - F.col("block_tokens")).alias("before"))
    within = Window.partitionBy("mix_source", "block").orderBy("order", "id").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("upto", F.sum("n_tokens").over(within)).join(blocks, ["mix_source", "block"])
    upto = F.col("before") + F.col("upto")
    last = F.when((upto <= F.col("rest")) & (F.col("n_tokens") > 0), 1).otherwise(0)
    full = F.when(F.col("n_tokens") > 0, F.col("full")).otherwise(0)
    return rows.select("id", "mix_source", "n_tokens", "weight", (full + last).cast("long").alias("copies"), "block",
                       "block_rank", (upto - F.col("n_tokens")).alias("offset"))


def mix(docs: DataFrame, id_col: str = "doc_id", **kw) -> DataFrame:
    """``docs`` with n_tokens, weight and copies; rows of 0 copies stay, marked so."""
    # Rows that repeat an identifier get its copies in turn, so none is multiplied.
    chosen = plan(docs, id_col=id_col, **kw).select(F.col("id").alias("mix_id"), *ADDED)
    turn = F.row_number().over(Window.partitionBy("mix_id", "mix_tokens").orderBy("mix_tokens"))
    kept = whole_row(docs.drop(*ADDED))
    left = docs.select(kept, F.col(id_col).alias("mix_id"), word_count(F.col("text")).alias("mix_tokens")).withColumn("mix_turn", turn)
    right = chosen.withColumn("mix_tokens", F.col("n_tokens")).withColumn("mix_turn2", F.row_number().over(
        Window.partitionBy("mix_id", "mix_tokens").orderBy(F.desc("copies")))).withColumnsRenamed(
        {"mix_id": "mix_id2", "mix_tokens": "mix_tokens2"})
    on = (F.col("mix_id").eqNullSafe(F.col("mix_id2")) & (F.col("mix_tokens") == F.col("mix_tokens2"))
          & (F.col("mix_turn") == F.col("mix_turn2")))
    return left.join(right, on).select("_row.*", *ADDED)
