"""Time buckets on wall-clock timestamps.

``date_trunc`` returns a session-zone TIMESTAMP; the marts keep
TIMESTAMP_NTZ, so every bucket is cast back. With the session pinned to UTC
(see ``session.prepare``) the round trip is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_start(ts) -> Column:
    """DATE_TRUNC('hour', ts)."""
    return F.date_trunc("hour", _col(ts)).cast("timestamp_ntz")


def minute_start(ts) -> Column:
    """DATE_TRUNC('minute', ts)."""
    return F.date_trunc("minute", _col(ts)).cast("timestamp_ntz")


def bucket_start(ts, minutes: int) -> Column:
    """Start of the N-minute bucket inside the hour: hour + N * floor(minute / N).

    ``minutes`` must divide 60 (15, 30, 60 are used); 60 is the hour itself,
    1 the minute.
    """
    if 60 % minutes:
        raise ValueError(f"bucket of {minutes} minutes does not divide the hour")
    ts = _col(ts)
    if minutes == 60:
        return hour_start(ts)
    if minutes == 1:
        return minute_start(ts)
    offset = F.make_dt_interval(F.lit(0), F.lit(0), (F.minute(ts) / minutes).cast("int") * minutes, F.lit(0))
    return (F.date_trunc("hour", ts) + offset).cast("timestamp_ntz")


def day_string(ts) -> Column:
    """Day key ``yyyy-MM-dd`` of a timestamp."""
    return F.date_format(_col(ts), "yyyy-MM-dd")
