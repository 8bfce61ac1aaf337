"""Table sinks.

Without a transactional table format on the classpath, two idempotent
patterns cover the source system's writes:

* date-partitioned serving rows, replaced per touched date with dynamic
  partition overwrite (a replayed micro-batch writes the same rows again);
* keyed dimension tables take appended changes (``sinks.keyed``).
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


def with_audit(df: DataFrame) -> DataFrame:
    """``ingested_at`` = load time and a surrogate ``id`` (B8). No model reads ``id``;
    a UUID needs no coordination between tasks, unlike a serial."""
    return df.withColumn("ingested_at", F.current_timestamp().cast("timestamp_ntz")).withColumn("id", F.expr("uuid()"))


def append_raw(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Append typed rows to a raw table."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)


def materialize(df: DataFrame, name: str, path: str | None = None) -> None:
    """Full refresh of a mart (B6): a catalog table, or plain parquet at ``path``.

    The new rows are written whole to a folder of their own and then take the old ones' place: a refresh that fails
    leaves the old mart as it was. A catalog table changes by one ``SET LOCATION``; the version before it is kept
    for queries that still read it. A plain folder is swapped by renames."""
    spark = df.sparkSession
    if path:
        parent, _, base = path.rstrip("/").rpartition("/")
        staged = f"{parent}/_staged-{base}-{uuid.uuid4().hex}"
        df.write.parquet(staged)
        swap_folder(spark, staged, path.rstrip("/"))
        return
    database, _, table = name.rpartition(".")
    database = database or spark.catalog.currentDatabase()
    home = f"{spark.catalog.getDatabase(database).locationUri}/_versions/{table}"
    version = f"{home}/{time.time_ns()}-{uuid.uuid4().hex}"
    df.write.parquet(version)
    known = spark.catalog.tableExists(f"{database}.{table}")
    if known and [(f.name, f.dataType) for f in spark.table(name).schema] != [(f.name, f.dataType) for f in df.schema]:
        spark.sql(f"DROP TABLE {database}.{table}")     # other columns: no version of the old ones to keep
        known = False
    if known:
        spark.sql(f"ALTER TABLE {database}.{table} SET LOCATION '{version}'")
        spark.catalog.refreshTable(f"{database}.{table}")
    else:
        spark.sql(f"CREATE TABLE {database}.{table} USING parquet LOCATION '{version}'")
    fs = _fs(spark, home)
    for old in sorted(x.getPath().toString() for x in fs.listStatus(_jpath(spark, home)))[:-2]:
        fs.delete(_jpath(spark, old), True)


def _jpath(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _jpath(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def swap_folder(spark: SparkSession, staged: str, target: str) -> None:
    """``staged``, written whole, takes the place of ``target``, which stays if that fails."""
    fs, new, at = _fs(spark, target), _jpath(spark, staged), _jpath(spark, target)
    parent, _, base = target.rpartition("/")
    aside = _jpath(spark, f"{parent}/_old-{base}-{uuid.uuid4().hex}")
    had = fs.exists(at)
    if had and not fs.rename(at, aside):
        raise OSError(f"{target} could not be moved aside")
    if not fs.rename(new, at):
        if had:
            fs.rename(aside, at)
        raise OSError(f"{staged} could not take the place of {target}")
    if had:
        fs.delete(aside, True)


def _exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_jpath(spark, path))


def make_folder(spark: SparkSession, path: str) -> None:
    _fs(spark, path).mkdirs(_jpath(spark, path))


def publish_folder(spark: SparkSession, staged: str, target: str) -> None:
    """Make a folder that has been written whole appear under its name; an existing one is an error."""
    fs, dst = _fs(spark, target), _jpath(spark, target)
    if fs.exists(dst) or not fs.rename(_jpath(spark, staged), dst):
        raise OSError(f"{staged} was not published as {target}")


def _reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage through the session's shared checkpoint folder (never executor-local)."""
    from ..session import reliable_checkpoint
    return reliable_checkpoint(df)


def partition_filter(df: DataFrame, partition_cols: list[str]):
    """A static predicate on ``partition_cols`` covering the partitions ``df``
    touches, for partition pruning at planning time (joins on partition
    columns are not pruned dynamically here). Only the distinct partition
    values travel to the driver: at most one row per touched partition."""
    vals = df.select(*partition_cols).distinct().collect()
    cond = F.lit(True)
    for c in partition_cols:
        cond = cond & F.col(c).isin(sorted({r[c] for r in vals}))
    return cond


def upsert_partitions(rows: DataFrame, path: str, key: list[str], partition_cols: list[str],
                      sort_cols: list[str] | None = None, version: str | None = None) -> None:
    """Upsert ``rows`` into a table partitioned by ``partition_cols``: last write wins per key (B5), or with
    ``version`` the row of the greatest value of that column, a stored one of none or less.

    Only the partitions present in ``rows`` are read and rewritten (dynamic
    partition overwrite); ``key`` must include the partition columns. The
    merged result is checkpointed before the overwrite so the write never
    reads the files it replaces.
    """
    spark = rows.sparkSession
    merged = rows
    if _exists(spark, path):
        touched = rows.select(*partition_cols).distinct()
        # Read with the rows' schema (partition values keep their type), listing
        # only the touched partitions; the semi join keeps the exact pairs.
        old = (spark.read.schema(rows.schema).parquet(path).where(partition_filter(rows, partition_cols))
               .join(touched, partition_cols, "left_semi"))
        new = rows.select(*old.columns)
        if version:
            # Only what is not older than its stored row replaces it.
            stored = old.select(*key, F.col(version).alias("_stored"))
            new = new.join(stored, key, "left").where(F.col("_stored").isNull() | (F.col("_stored") <= F.col(version))).drop("_stored")
        keep = old.join(new.select(*key), key, "left_anti")
        merged = keep.unionByName(new)
        merged = _reliable_checkpoint(merged)
    # Cluster rows by partition so each partition is written by few tasks;
    # ``rebalance`` lets AQE split a hot partition instead of one task writing it.
    out = merged.hint("rebalance", *partition_cols)
    if sort_cols:
        # Partition columns first: the partitioned writer needs that order, and
        # would otherwise re-sort and lose the clustering inside each file.
        out = out.sortWithinPartitions(*partition_cols, *sort_cols)
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols).parquet(path))


def write_daily_usage(rows: DataFrame, path: str, buckets: int | None = None) -> None:
    """Serving table write (B5, G3): partitioned by (date, bucket of msisdn) — the
    source store's (msisdn, date) partition key — with rows clustered as
    (msisdn, hour, category, usage_type) inside each partition. A micro-batch
    rewrites only the (date, bucket) partitions it touches. Rows that bring
    ``updated_at`` replace only stored ones that are not newer; others get the time of the write."""
    from ..operators.serving import SERVING_KEY, with_bucket
    versioned = "updated_at" in rows.columns
    b = with_bucket(rows if versioned else rows.withColumn("updated_at", F.current_timestamp().cast("timestamp_ntz")), buckets)
    upsert_partitions(b, path, SERVING_KEY + ["bucket"], ["date", "bucket"],
                      ["msisdn", "hour", "category", "usage_type"], version="updated_at" if versioned else None)
