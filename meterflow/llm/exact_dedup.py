"""Exact dedup by tree-merging runs of digests.

Every scan partition is a run: its texts' digests with the identifier to keep
and a count, folded map-side. Runs then meet in rounds, ``fan_in`` at a time: a
round merges the runs of one group per digest, keeps the winning identifier and
adds the counts, until one run is left. Each run stays spread over tasks by
digest, so no task holds a whole run, and a text that fills a third of the
table is one record per run after the first fold. A digest is the SHA-256 of
the text, verified at every level by a second hash and the byte length: only
records that agree in all three are merged.

Defined cases: a null text counts as empty; a null identifier loses to any
other; rows that repeat identifier and text are one document, which stays or
goes as one (``drop_copies`` leaves one such row); an empty table gives no row;
other columns of the input, whatever their names, are ignored here and carried
through by ``drop_copies``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import save

KEY = ["digest", "check", "n_bytes"]


def digest_runs(docs: DataFrame, id_col: str = "doc_id", text: Column | None = None) -> DataFrame:
    """(id, digest, check, n_bytes, run) of every row; ``text`` is the normalised text."""
    text = F.coalesce(F.col("text") if text is None else text, F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.sha2(text.cast("binary"), 256).alias("digest"),
                       F.xxhash64(text).alias("check"), F.octet_length(text).cast("long").alias("n_bytes"),
                       F.spark_partition_id().cast("long").alias("run"))


def merge_runs(runs: DataFrame, n_runs: int, keep: str = "min", fan_in: int = 16) -> DataFrame:
    """One row per distinct text: KEY, keep_id, group_size. ``keep`` is min or max."""
    best = {"min": F.min, "max": F.max}[keep]
    level = runs.groupBy(*KEY, "run").agg(best("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    while n_runs > 1:
        n_runs = -(-n_runs // fan_in)
        level = (level.withColumn("run", F.floor(F.col("run") / fan_in))
                 .groupBy(*KEY, "run").agg(best("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")))
    return level.drop("run")


def classes(docs: DataFrame, id_col: str = "doc_id", text: Column | None = None, keep: str = "min",
            fan_in: int = 16) -> DataFrame:
    """Per row: id, digest, check, n_bytes, keep_id, group_size, kept."""
    runs = save(digest_runs(docs, id_col, text), "digests")
    n_runs = (runs.agg(F.max("run")).first()[0] or 0) + 1
    # Texts that occur once need no join; the others are read back from the shared folder.
    groups = save(merge_runs(runs, n_runs, keep, fan_in).filter("group_size > 1"), "digest-groups")
    return (runs.drop("run").join(groups, KEY, "left")
            .withColumn("keep_id", F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id")))
            .withColumn("group_size", F.coalesce("group_size", F.lit(1)).cast("long"))
            .withColumn("kept", F.col("id").eqNullSafe(F.col("keep_id"))))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", keep: str = "min") -> DataFrame:
    """``docs`` with one row of every distinct text, all columns kept as they were."""
    rows = save(classes(docs, id_col, keep=keep).select("id", "digest", "kept"), "dedup-classes")
    gone = rows.filter(~F.col("kept")).select("id", "digest").distinct()
    again = rows.filter("kept").groupBy("id", "digest").count().filter("count > 1").select("id", "digest")
    ident = docs[id_col]
    digest = F.sha2(F.coalesce(docs["text"], F.lit("")).cast("binary"), 256)
    left = docs.join(gone, ident.eqNullSafe(gone["id"]) & (digest == gone["digest"]), "left_anti")
    if again.isEmpty():
        return left
    same = ident.eqNullSafe(again["id"]) & (digest == again["digest"])
    return left.join(again, same, "left_anti").unionByName(
        left.join(again, same, "left_semi").dropDuplicates([id_col, "text"]))
