"""Raw and serving tables as batch sources.

Reads always carry an explicit schema, so partition values keep their
declared type and no file is sampled for inference. Column pruning and
predicate pushdown (including partition pruning on ``date``) come from
Catalyst once the caller selects and filters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import schemas

RAW_SCHEMAS = {
    "cdr_data": schemas.CDR_DATA,
    "cdr_voice": schemas.CDR_VOICE,
    "forex_ticks": schemas.FOREX_TICKS,
    "accounts": schemas.ACCOUNTS,
    "addresses": schemas.ADDRESSES,
    "devices": schemas.DEVICES,
}


def load_raw(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Typed raw table ``root/name`` (parquet) with its declared schema; of a keyed table (``schemas.CDC_ROWS``)
    the current rows, without the tombstones of deleted keys."""
    schema, path = RAW_SCHEMAS[name], f"{root.rstrip('/')}/{name}"
    if name not in schemas.CDC_ROWS:
        # The folders of micro-batches below are no column of the table.
        return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
    from ..sinks.keyed import read_keyed
    return read_keyed(spark, path, schemas.CDC_KEYS[name], schema)


#: ``updated_at`` is when the row was written, or the time of the summary it comes from; NULL in tables from before.
SERVING_STORED = T.StructType(schemas.DAILY_USAGE.fields + [
    T.StructField("updated_at", T.TimestampNTZType(), True), T.StructField("bucket", T.IntegerType(), True)])


def read_serving_table(spark: SparkSession, path: str) -> DataFrame:
    """The stored serving table, including its ``bucket`` partition column."""
    return spark.read.schema(SERVING_STORED).parquet(path)


def read_serving_for(spark: SparkSession, path: str, requests: DataFrame, buckets: int | None = None) -> DataFrame:
    """The stored rows that validated lookup requests can touch (A7, C8): the days and buckets they name
    become a partition filter, so no other partition is listed or read. At most one value a stored
    partition travels to the driver: days are cut to those that the table has."""
    from ..operators.serving import lookup_partitions
    from ..sinks.tables import partition_filter
    stored = read_serving_table(spark, path)
    wanted = lookup_partitions(requests, buckets)
    # Partition columns alone are asked for here: this reads no file.
    present = stored.select("date", "bucket").distinct()
    touched = wanted.join(present, ["date", "bucket"], "left_semi")
    return stored.where(partition_filter(touched, ["date", "bucket"])).select(*schemas.DAILY_USAGE.fieldNames())


def scan_serving(spark: SparkSession, path: str, msisdn: str, start_date: str, end_date: str,
                 buckets: int | None = None) -> DataFrame:
    """Keyed range scan of the serving table: one subscriber, dates inclusive.

    ``date`` is a partition column, so only the dates in range are listed;
    ``msisdn`` is pushed down to the parquet row-group filter (rows are
    sorted by msisdn inside each file). Pass the table's ``buckets`` count to
    also prune to the subscriber's one bucket per date; without it no bucket
    is assumed, so a table written with another count is still read right.
    """
    from ..operators.serving import bucket_of
    t = read_serving_table(spark, path)
    cond = (F.col("date") >= start_date) & (F.col("date") <= end_date) & (F.col("msisdn") == msisdn)
    if buckets:
        cond = cond & (F.col("bucket") == bucket_of(F.lit(msisdn), buckets))
    return t.where(cond).select(*schemas.DAILY_USAGE.fieldNames())
