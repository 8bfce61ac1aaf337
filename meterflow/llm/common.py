"""Helpers shared by the training-data operators: shared folders, folds, word rules."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import work_dir

# What separates words (space, tab to carriage return), and ASCII letters.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir`` with its scheme kept; the
    library's private folder only where that setting is unset (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return f"{base.rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    return work_dir(spark, "llm", name)


def save(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the
    lineage with a copy that outlives any executor."""
    spark = df.sparkSession
    path = path or shared_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def passing(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``save``, and the folder, for ``remove`` once nothing reads the table any more."""
    path = shared_dir(df.sparkSession, name)
    return save(df, name, path), path


def remove(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def shuffles_freed(spark: SparkSession):
    """A query's shuffle files go as it ends; else they stay until the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def fold(c: Column, n: int) -> Column:
    """crc32 of the value as text, modulo ``n``; null counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")), F.lit(n))


def whole_row(df: DataFrame) -> Column:
    """All columns as one, ``_row``: whatever their names, they meet no column that an operator adds."""
    return F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in df.columns]).alias("_row")
