"""The corpus pipeline: documents to a mixed training set, a stage per operator.

Stages take (spark, docs, sf_dir) and return a table that is written before the
next one reads it. All but the last keep the columns of documents; the last adds
n_tokens, weight and copies (how often a document is to be read; 0: left out by the budget): a plan for the reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterflow.llm import decontaminate, exact_dedup, jaccard_join, lang_id, mixing
from meterflow.llm.common import save, table
from meterflow.session import prepare


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without letters, or without a main language, go."""
    return lang_id.keep_known(docs, docs.select("doc_id", "text", "lang"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every distinct text stays, the smallest doc_id."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every component of similar texts stays, the smallest doc_id."""
    return jaccard_join.drop_near(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that hold a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of every document at target weights of the sources."""
    return mixing.mix(docs)


STAGES = [("language ID", language), ("exact dedup", exact), ("n-gram Jaccard join", near),
          ("benchmark decontamination", benchmark), ("mixing to target weights", mixed)]
#: Language models, components and BM25 retrieval aren't SQL; test_pipeline_stages_are_brute_force holds what
#: each stage keeps of its own input against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
