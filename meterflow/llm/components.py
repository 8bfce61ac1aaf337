"""Connected components of links between nodes, as Spark tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import save


def connect(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(key, label): the smallest key that ``links`` (a, b) connect each of ``nodes`` (key) to.

    Linked nodes start from the smallest of their own and their neighbours' keys. A round takes the smallest
    label among a node's own and its neighbours', then the label's own label, until nothing changes; every
    round is written to the shared folder."""
    alone = nodes.select("key", F.col("key").alias("label"))
    if links.isEmpty():
        return alone
    both = save(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "cc-links")
    labels = both.groupBy(F.col("a").alias("key")).agg(F.min("b").alias("near")).select("key", F.least("key", "near").alias("label"))
    while True:
        near = both.join(labels.select(F.col("key").alias("b"), "label"), "b").groupBy(F.col("a").alias("key")).agg(F.min("label").alias("near"))
        step = labels.join(near, "key").select("key", "label", F.least("label", "near").alias("low"))
        jump = step.select(F.col("key").alias("low"), F.col("low").alias("lower"))
        step = save(step.join(jump, "low").select("key", "label", F.least("low", "lower").alias("low")), "cc-round")
        labels = step.select("key", F.col("low").alias("label"))
        if step.filter("low <> label").isEmpty():
            return nodes.join(labels, "key", "left").select("key", F.coalesce("label", "key").alias("label"))
