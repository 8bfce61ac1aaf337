"""Text → typed values (I6, I7, I9). ``try_*`` forms give NULL on bad input, so
callers can route the row to quarantine instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The accepted event-time layouts (with and without fraction)
# and the compact request layout.
EVENT_TIME_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(\.\d{1,6})?$"
COMPACT_TIME_FORMAT = "yyyyMMddHHmmss"
COMPACT_TIME_PATTERN = r"^\d{14}$"
INTEGER_PATTERN = r"^\s*[+-]?\d+\s*$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_event_time(s) -> Column:
    """``yyyy-MM-dd HH:mm:ss[.ffffff]`` (any fraction length) → TIMESTAMP_NTZ, else NULL."""
    s = _col(s)
    ok = s.rlike(EVENT_TIME_PATTERN)
    return F.when(ok, s.try_cast("timestamp_ntz"))


def parse_compact_time(s) -> Column:
    """``yyyyMMddHHmmss`` → TIMESTAMP_NTZ, else NULL."""
    s = _col(s)
    ok = s.rlike(COMPACT_TIME_PATTERN)
    return F.when(ok, F.try_to_timestamp(s, F.lit(COMPACT_TIME_FORMAT)).cast("timestamp_ntz"))


def to_long(s) -> Column:
    """Text → BIGINT, NULL when not an integer."""
    return _try_cast(s, "bigint")


def to_int(s) -> Column:
    """Text → INT, NULL when not an integer or out of range."""
    return _try_cast(s, "int")


def _try_cast(s, t: str) -> Column:
    # Only integer text: a bare cast would accept (and round) "12.5".
    s = _col(s)
    return F.when(s.rlike(INTEGER_PATTERN), F.trim(s).try_cast(t))
