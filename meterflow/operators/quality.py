"""Typed parsing with per-record isolation.

Wire rows are text. Each row is parsed in one projection; a row whose
required field does not parse is routed to a quarantine output with the
names of the failing fields, instead of failing the job or silently
becoming NULL inside a later sum (H10).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.barrier import evaluate_once
from ..functions.parsing import parse_compact_time, parse_event_time, to_int, to_long
from .forex import quote_is_exact

ERRORS = "errors"


@dataclass(frozen=True)
class Split:
    """Both outputs of one parse. Persist ``parsed`` when reading both."""
    parsed: DataFrame
    columns: list[str]
    raw_columns: list[str]

    @property
    def good(self) -> DataFrame:
        return self.parsed.where(F.col(ERRORS) == "").select(*self.columns)

    @property
    def quarantine(self) -> DataFrame:
        raw = [F.col(f"_raw.{c}").alias(c) for c in self.raw_columns]
        return self.parsed.where(F.col(ERRORS) != "").select(*raw, ERRORS)


# Maximum lengths of the raw tables' text columns.
MAX_LENGTHS = {
    "cdr_data": {"msisdn": 20, "data_type": 50, "ip_address": 45, "website_url": 500},
    "cdr_voice": {"msisdn": 20, "call_type": 50, "dest_nr": 20},
    "ticks": {"pair_name": 10},
}


def _split(wire: DataFrame, typed: dict[str, Column], required: list[str],
           max_lengths: dict[str, int] | None = None) -> Split:
    """``typed`` maps output column → parse expression; ``required`` must be non-NULL;
    text in ``max_lengths`` must fit its column (a longer value would not be stored)."""
    raw_cols = wire.columns
    fails = []
    for c in typed:
        bad = F.col(c).isNull() if c in required else F.lit(False)
        if max_lengths and c in max_lengths:
            bad = bad | F.coalesce(F.length(F.col(c)) > max_lengths[c], F.lit(False))
        if c in required or (max_lengths and c in max_lengths):
            fails.append(F.when(bad, F.lit(c)))
    x = wire.select(F.struct(*[F.col(c) for c in raw_cols]).alias("_raw"), *[e.alias(c) for c, e in typed.items()])
    x = x.select("*", F.concat_ws(",", *fails).alias(ERRORS))
    # Parse once: the good/quarantine filters must not re-run the parse.
    return Split(evaluate_once(x), list(typed), raw_cols)


def _cdr_data_columns() -> dict[str, Column]:
    return {
        "msisdn": F.col("msisdn"),
        "tower_id": to_int("tower_id"),
        "up_bytes": to_long("up_bytes"),
        "down_bytes": to_long("down_bytes"),
        "data_type": F.col("data_type"),
        "ip_address": F.col("ip_address"),
        "website_url": F.col("website_url"),
        "event_datetime": parse_event_time("event_datetime"),
    }


def split_cdr_data(wire: DataFrame) -> Split:
    """CSV/topic text of the data feed → typed rows + quarantine."""
    return _split(wire, _cdr_data_columns(), ["tower_id", "up_bytes", "down_bytes", "event_datetime"], MAX_LENGTHS["cdr_data"])


def _cdr_voice_columns() -> dict[str, Column]:
    return {
        "msisdn": F.col("msisdn"),
        "tower_id": to_int("tower_id"),
        "call_type": F.col("call_type"),
        "dest_nr": F.col("dest_nr"),
        "call_duration_sec": to_int("call_duration_sec"),
        "start_time": parse_event_time("start_time"),
    }


def split_cdr_voice(wire: DataFrame) -> Split:
    """CSV/topic text of the voice feed → typed rows + quarantine."""
    return _split(wire, _cdr_voice_columns(), ["tower_id", "call_duration_sec", "start_time"], MAX_LENGTHS["cdr_voice"])


def split_usage_data(wire: DataFrame) -> Split:
    """The data feed for the usage sums: only what they read is required, so a bad tower or a long
    URL costs no bytes. A missing usage type, part of the sums' key, is empty text."""
    typed = _cdr_data_columns() | {"data_type": F.coalesce("data_type", F.lit(""))}
    return _split(wire, typed, ["msisdn", "up_bytes", "down_bytes", "event_datetime"])


def split_usage_voice(wire: DataFrame) -> Split:
    """The voice feed for the usage sums, as ``split_usage_data``."""
    typed = _cdr_voice_columns() | {"call_type": F.coalesce("call_type", F.lit(""))}
    return _split(wire, typed, ["msisdn", "call_duration_sec", "start_time"])


def split_ticks(wire: DataFrame) -> Split:
    """Tick messages (text time, numeric prices) → typed ticks + quarantine, which also takes
    quotes that the marts could not hold exactly (``forex.quote_is_exact``)."""
    def quote(c: str) -> Column:
        x = F.col(c).cast("double")
        return F.when(quote_is_exact(x), x)

    typed = {
        "tick_time": parse_event_time("timestamp"),
        "pair_name": F.col("pair_name"),
        "bid_price": quote("bid_price"),
        "ask_price": quote("ask_price"),
        "spread": F.col("spread").cast("double"),
    }
    return _split(wire, typed, ["tick_time", "bid_price", "ask_price"], MAX_LENGTHS["ticks"])


# The two request error messages of the lookup service.
MISSING_PARAMS = "Missing required parameters: msisdn, start_time, end_time"
BAD_TIME = "Invalid timestamp format. Use YYYYMMDDHHmmss"


def validate_requests(requests: DataFrame) -> DataFrame:
    """Lookup requests with parsed times and an ``error`` column.

    Missing (NULL or empty) parameters are reported first, then a time that
    is not ``yyyyMMddHHmmss``. ``error`` is NULL for a valid request.
    """
    def missing(c: str) -> Column:
        return F.col(c).isNull() | (F.col(c) == "")
    st, et = parse_compact_time("start_time"), parse_compact_time("end_time")
    x = requests.select("*", st.alias("start_ts"), et.alias("end_ts"))
    err = (F.when(missing("msisdn") | missing("start_time") | missing("end_time"), F.lit(MISSING_PARAMS))
           .when(F.col("start_ts").isNull() | F.col("end_ts").isNull(), F.lit(BAD_TIME)))
    return evaluate_once(x.select("*", err.alias("error")))
