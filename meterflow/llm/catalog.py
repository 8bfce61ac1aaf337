"""The operators' queries: ``(spark, sf_dir) -> DataFrame`` over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import prepare
from . import decontaminate, exact_dedup, hard_negatives, jaccard_join, lang_id, license_scan, lm_score, mixing, periodic_runs, personal_data, secret_scan, token_counts, url_filter
from .common import fold, shared_dir, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare(spark), sf_dir)
    QUERIES[fn.__name__] = run
    return run


@query
def op1_license_scan(spark, sf):
    """Licences of every document, as a whole text and line by line."""
    return license_scan.scan(table(spark, sf, "documents"))


@query
def op2_lm_score(spark, sf):
    """Log10 probability of every document; rows of fold 2 are held out."""
    held_out = fold(F.col("doc_id"), 7) == 2
    return lm_score.score(table(spark, sf, "documents"), [F.col("doc_id"), held_out.alias("held_out")], ~held_out)


@query
def op3_token_counts(spark, sf):
    """Tokens of every document, counted in flat files made from the table."""
    docs, path = table(spark, sf, "documents"), shared_dir(spark, "flat")
    token_counts.write_flat(docs, path)
    return token_counts.by_document(docs, token_counts.count(spark, path)).select("doc_id", "part", "ordinal", "n_tokens", "closed")


@query
def op4_mix_sources(spark, sf):
    """How often each document is read when sources are mixed by temperature."""
    plan = mixing.plan(table(spark, sf, "documents"))
    return plan.select(F.col("id").alias("doc_id"), F.col("mix_source").alias("source"), "n_tokens",
                       F.round("weight", 6).alias("weight"), "copies", "block", "block_rank", "offset")


@query
def op5_language_id(spark, sf):
    """Language of every document; rows of fold 0 are held out."""
    docs = table(spark, sf, "documents")
    held_out = fold(F.col("doc_id"), 5) == 0
    model = lang_id.fit(docs.filter(~held_out).select("doc_id", "text", "lang"))
    return lang_id.predict(docs, model, [F.col("doc_id"), held_out.alias("held_out")])


@query
def op6_jaccard_join(spark, sf):
    """Components of documents linked by shingle similarity."""
    return jaccard_join.components(table(spark, sf, "documents")).withColumnRenamed("id", "doc_id")


@query
def op7_secret_scan(spark, sf):
    """Secrets of every document's text."""
    return secret_scan.report(secret_scan.scan(table(spark, sf, "documents")))


@query
def op8_decontaminate(spark, sf):
    """Documents that hold a benchmark item."""
    return decontaminate.find_items(table(spark, sf, "documents"), table(spark, sf, "benchmark"), [F.col("doc_id")])


@query
def op9_exact_dedup(spark, sf):
    """Groups of equal texts; the largest doc_id of each stays."""
    out = exact_dedup.classes(table(spark, sf, "documents"), keep="max")
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


@query
def op10_url_filter(spark, sf):
    """Verdict on every page's url."""
    return url_filter.judge(table(spark, sf, "pages")).withColumn("ratio", F.round("ratio", 6))


@query
def op11_hard_negatives(spark, sf):
    """Hard negatives of every hundredth vector."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf, "embeddings"), label, F.col("id") % 100 == 0)


@query
def op12_personal_data(spark, sf):
    """Personal data of every document's text."""
    return personal_data.report(personal_data.scan(table(spark, sf, "documents")))


@query
def op13_periodic_runs(spark, sf):
    """Periodic runs of words of every document, some of them made to stutter."""
    return periodic_runs.report(table(spark, sf, "documents"), order=periodic_runs.stutter)
