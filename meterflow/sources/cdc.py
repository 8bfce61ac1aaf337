"""Change-data-capture envelopes.

A change event carries ``op`` (c/u/d/r), the row image ``after`` (and
``before`` for deletes), ``source.lsn`` and ``ts_ms``; connectors either send
it bare or wrapped as ``{schema, payload}``. Both forms are accepted. Row
timestamps travel as epoch microseconds.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType, TimestampNTZType

from ..functions.barrier import evaluate_once
from ..schemas import cdc_envelope


def _ts_fields(row: StructType) -> set[str]:
    return {f.name for f in row.fields if isinstance(f.dataType, TimestampNTZType)}


# Why an event cannot be applied.
UNREADABLE, NO_IMAGE, NO_KEY = "unreadable", "no row image", "no key"


@dataclass(frozen=True)
class ChangeSplit:
    """Both outputs of one parse of change events. Persist ``parsed`` when reading both."""
    parsed: DataFrame
    columns: list[str]
    raw_columns: list[str]

    @property
    def good(self) -> DataFrame:
        return self.parsed.where(F.col("error") == "").select(*self.columns)

    @property
    def dead(self) -> DataFrame:
        """Events that cannot be applied, as they came, with ``error``."""
        return self.parsed.where(F.col("error") != "").select(*[F.col(f"_raw.{c}").alias(c) for c in self.raw_columns], "error")


def split_changes(messages: DataFrame, row: StructType, keys: list[str]) -> ChangeSplit:
    """JSON change events → flat changes, and the events that cannot be applied.

    A flat change is ``op, lsn, <row columns>``; non-key columns are NULL for a delete and a delete's
    ``modified_ts`` is the event time. An event is unreadable if its value is no JSON or has none of an
    event's fields, else it lacks the row image (C12: only a delete may) or the key. A message without a
    value is what connectors send after a delete for the broker's own clean-up: no event, in neither output."""
    v = F.from_json("value", cdc_envelope(row), {"mode": "PERMISSIVE"})
    x = messages.where(F.col("value").isNotNull()).select(F.struct(*messages.columns).alias("_raw"), v.alias("v"))

    def pick(field: str) -> Column:
        return F.coalesce(F.col(f"v.payload.{field}"), F.col(f"v.{field}"))

    fields = ("op", "before", "after", "ts_ms", "source")
    x = evaluate_once(x.select("_raw", *[pick(f).alias(f) for f in fields]))
    ts = _ts_fields(row)
    cols = []
    for f in row.fields:
        if f.name in keys:
            c = F.coalesce(F.col(f"after.{f.name}"), F.col(f"before.{f.name}"))
        else:
            c = F.col(f"after.{f.name}")
        if f.name in ts:
            c = F.timestamp_micros(c).cast("timestamp_ntz")
            if f.name == "modified_ts":
                c = F.coalesce(c, F.timestamp_millis(F.col("ts_ms")).cast("timestamp_ntz"))
        cols.append(c.cast(f.dataType).alias(f.name))

    def every(conditions: list[Column]) -> Column:
        return reduce(lambda a, b: a & b, conditions)

    no_image = F.col("after").isNull() & ~F.col("op").eqNullSafe("d")
    has_key = every([F.coalesce(F.col(f"after.{k}"), F.col(f"before.{k}")).isNotNull() for k in keys])
    error = (F.when(every([F.col(f).isNull() for f in fields]), UNREADABLE).when(no_image, NO_IMAGE).when(~has_key, NO_KEY).otherwise(""))
    x = x.select("_raw", "op", F.col("source.lsn").alias("lsn"), *cols, error.alias("error"))
    return ChangeSplit(x, ["op", "lsn", *row.fieldNames()], messages.columns)


def parse_changes(messages: DataFrame, row: StructType, keys: list[str]) -> DataFrame:
    """The changes that can be applied, flat (see ``split_changes``)."""
    return split_changes(messages, row, keys).good


def to_change_events(changes: DataFrame, row: StructType, keys: list[str], table: str) -> DataFrame:
    """Flat changes (row columns + ``op``, ``lsn``) → JSON change events, as a connector
    writes them: deletes carry only the key in ``before``; even log positions
    are sent bare, odd ones wrapped in ``{schema, payload}``."""
    ts = _ts_fields(row)

    def wire(c: str) -> Column:
        return F.unix_micros(F.col(c).cast("timestamp")) if c in ts else F.col(c)

    image = F.struct(*[wire(f.name).alias(f.name) for f in row.fields])
    key_only = F.struct(*[(wire(f.name) if f.name in keys else F.lit(None)).alias(f.name) for f in row.fields])
    is_del = F.col("op") == "d"
    env = F.struct(F.col("op").alias("op"), F.when(is_del, key_only).alias("before"),
                   F.when(~is_del, image).alias("after"),
                   F.unix_millis(F.col("modified_ts").cast("timestamp")).alias("ts_ms"),
                   F.struct(F.col("lsn").alias("lsn"), F.lit(table).alias("table")).alias("source"))
    wrapped = F.struct(F.struct(F.lit("struct").alias("type")).alias("schema"), env.alias("payload"))
    value = F.when(F.col("lsn") % 2 == 0, F.to_json(env)).otherwise(F.to_json(wrapped))
    key = F.to_json(F.struct(*[F.col(k) for k in keys]))
    return changes.select(F.lit(f"crm.crm_system.{table}").alias("topic"), key.alias("key"), value.alias("value"))
