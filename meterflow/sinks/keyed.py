"""Keyed dimension tables as a log of changes with compaction.

A table is partitioned by a hash bucket of the key. A batch of changes is folded to
the newest per key and appended, so what it writes follows the batch, not the
table. Readers take the newest row per key; a deleted key is a row with op 'd'
(a tombstone). Order and repetition of batches do not matter: folding is by
(modified_ts, lsn), and a batch that is appended twice folds to the same rows.

``compact`` rewrites the buckets whose rows outnumber their keys by a ratio. It first
appends the folded rows and then deletes the files it has read, so readers and
concurrent appends see right rows at every step, and one that dies half-way
leaves rows twice, never too few. A tombstone is purged only once it is
the only row of its key, and older than a horizon: an older change that
comes after that would bring the key back.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.cdc import latest_by_key
from ..session import reliable_checkpoint
from .tables import _exists, partition_filter

# Hash buckets of the key in a keyed table (a table property: keep it fixed).
KEYED_BUCKETS = 64

# Stored with each row of a keyed table: the change it comes from. Rows of tables from before have
# neither and are older than any change of their time.
CHANGE = [T.StructField("op", T.StringType(), True), T.StructField("lsn", T.LongType(), True)]


def _with_key_bucket(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    return df.withColumn("bucket", F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int"))


def _stored(schema: T.StructType) -> T.StructType:
    return T.StructType(schema.fields + CHANGE)


def read_log(spark: SparkSession, path: str, schema: T.StructType, bucket_filter=None) -> DataFrame:
    """All stored rows of a keyed table with ``op``, ``lsn`` and ``bucket`` (empty when it does not
    exist yet), optionally only from the buckets selected by ``bucket_filter``."""
    stored = T.StructType(_stored(schema).fields + [T.StructField("bucket", T.IntegerType(), True)])
    if not _exists(spark, path):
        return spark.createDataFrame([], stored)
    t = spark.read.schema(stored).parquet(path)
    return t if bucket_filter is None else t.where(bucket_filter)


def read_keyed(spark: SparkSession, path: str, keys: list[str], schema: T.StructType, bucket_filter=None) -> DataFrame:
    """Current rows of a keyed table."""
    log = read_log(spark, path, schema, bucket_filter).drop("bucket")
    return latest_by_key(log, keys).select(*schema.fieldNames())


def append_changes(changes: DataFrame, path: str, keys: list[str], schema: T.StructType, buckets: int = KEYED_BUCKETS) -> None:
    """Append a batch of changes (row columns + ``op``, ``lsn``), folded to the newest per key."""
    rows = latest_by_key(changes.select(*schema.fieldNames(), "op", F.col("lsn").cast("bigint").alias("lsn")), keys, keep_deletes=True)
    rows = _with_key_bucket(rows.select(*_stored(schema).fieldNames()), keys, buckets)
    rows.hint("rebalance", "bucket").write.mode("append").partitionBy("bucket").parquet(path)


def compact(spark: SparkSession, path: str, keys: list[str], schema: T.StructType, ratio: float = 2.0,
            purge_before: datetime | None = None) -> list[int]:
    """Rewrite the buckets with more than ``ratio`` rows a key, and those with tombstones to purge
    (changed before ``purge_before``); the buckets rewritten. One compaction of a table runs at a time."""
    if not _exists(spark, path):
        return []
    old = F.col("op").eqNullSafe("d") & (F.col("modified_ts") < F.lit(purge_before)) if purge_before else F.lit(False)
    per_key = read_log(spark, path, schema).groupBy("bucket", *keys).agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(old).alias("only_old"))
    size = per_key.groupBy("bucket").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"),
                                         F.max(F.coalesce("only_old", F.lit(False)) & (F.col("n") == 1)).alias("purge"))
    chosen = sorted(r["bucket"] for r in size.where((F.col("n") > ratio * F.col("k")) | F.col("purge")).select("bucket").collect())
    if not chosen:
        return []
    log = read_log(spark, path, schema, F.col("bucket").isin(chosen)).select("*", F.col("_metadata.file_path").alias("file"))
    # What is read now, and nothing that is appended meanwhile, is folded and then deleted.
    log = reliable_checkpoint(log)
    files = [r["file"] for r in log.select("file").distinct().collect()]
    cols = [c for c in _stored(schema).fieldNames() if c not in keys]
    folded = log.groupBy(*keys, "bucket").agg(F.max_by(F.struct(*cols), F.struct("modified_ts", "lsn")).alias("l"), F.count(F.lit(1)).alias("n"))
    rows = folded.select(*keys, *[F.col(f"l.{c}").alias(c) for c in cols], "bucket", "n")
    rows = rows.where(~(F.coalesce(old, F.lit(False)) & (F.col("n") == 1))).select(*_stored(schema).fieldNames(), "bucket")
    rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", *keys).write.mode("append").partitionBy("bucket").parquet(path)
    _delete(spark, files)
    return chosen


def _delete(spark: SparkSession, files: list[str]) -> None:
    for f in files:
        jpath = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(f))
        jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, False)
