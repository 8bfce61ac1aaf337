"""Column-level helpers: every one returns a built-in Spark expression (codegen, no UDF)."""

from .timebuckets import bucket_start, day_string, hour_start, minute_start  # noqa: F401
from .rates import Rates, RATES  # noqa: F401
from .parsing import parse_event_time, parse_compact_time, to_long, to_int  # noqa: F401
