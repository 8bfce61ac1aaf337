"""Explicit schemas for every dataset. Wire data is read as text, never inferred."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


S, I, L, D, TS = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.TimestampNTZType()

# Column order of the CSV drops and JSON topics (all fields travel as text).
CDR_DATA_FIELDS = ["msisdn", "tower_id", "up_bytes", "down_bytes", "data_type",
                   "ip_address", "website_url", "event_datetime"]
CDR_VOICE_FIELDS = ["msisdn", "tower_id", "call_type", "dest_nr", "call_duration_sec", "start_time"]
TICK_FIELDS = ["timestamp", "pair_name", "bid_price", "ask_price", "spread"]

CDR_DATA_WIRE = _struct(*[(f, S) for f in CDR_DATA_FIELDS])
CDR_VOICE_WIRE = _struct(*[(f, S) for f in CDR_VOICE_FIELDS])
TICK_WIRE = _struct(("timestamp", S), ("pair_name", S), ("bid_price", D), ("ask_price", D), ("spread", D))

CDR_DATA = _struct(("msisdn", S), ("tower_id", I), ("up_bytes", L), ("down_bytes", L),
                   ("data_type", S), ("ip_address", S), ("website_url", S), ("event_datetime", TS))
CDR_VOICE = _struct(("msisdn", S), ("tower_id", I), ("call_type", S), ("dest_nr", S),
                    ("call_duration_sec", I), ("start_time", TS))
FOREX_TICKS = _struct(("tick_time", TS), ("pair_name", S), ("bid_price", D), ("ask_price", D), ("spread", D))

ACCOUNTS = _struct(("account_id", L), ("owner_name", S), ("email", S), ("phone_number", S),
                   ("modified_ts", TS))
ADDRESSES = _struct(("account_id", L), ("street_address", S), ("city", S), ("state", S),
                    ("postal_code", S), ("country", S), ("modified_ts", TS))
DEVICES = _struct(("device_id", L), ("account_id", L), ("device_name", S), ("device_type", S),
                  ("device_os", S), ("modified_ts", TS))

# Key column(s) of each CDC-maintained table.
CDC_KEYS = {"accounts": ["account_id"], "addresses": ["account_id"], "devices": ["device_id"]}
CDC_ROWS = {"accounts": ACCOUNTS, "addresses": ADDRESSES, "devices": DEVICES}


def cdc_row_wire(row: T.StructType) -> T.StructType:
    """Row image as the change feed sends it: timestamps as epoch microseconds."""
    return T.StructType([T.StructField(f.name, L if isinstance(f.dataType, T.TimestampNTZType) else f.dataType, True)
                         for f in row.fields])


def cdc_envelope(row: T.StructType) -> T.StructType:
    """Change event, bare or wrapped in ``{schema, payload}``."""
    img = cdc_row_wire(row)
    body = [T.StructField("op", S), T.StructField("before", img), T.StructField("after", img),
            T.StructField("ts_ms", L), T.StructField("source", _struct(("lsn", L), ("table", S)))]
    return T.StructType(body + [T.StructField("payload", T.StructType(body))])


# Nested daily summary (one message per subscriber and day).
DATA_STATS = _struct(("up", L), ("down", L))
VOICE_STATS = _struct(("duration", L), ("count", L))
COSTS = _struct(("data_cost_wak", D), ("voice_cost_wak", D), ("total_cost_wak", D))
USAGE_SUMMARY = _struct(("msisdn", S), ("date", S),
                        ("data_usage", T.MapType(S, DATA_STATS)),
                        ("voice_usage", T.MapType(S, VOICE_STATS)),
                        ("costs", COSTS), ("timestamp", S))

# Serving table: one row per (msisdn, date, hour, category, usage_type).
DAILY_USAGE = _struct(("msisdn", S), ("date", S), ("hour", I), ("category", S), ("usage_type", S),
                      ("up_bytes", L), ("down_bytes", L), ("call_duration_sec", L), ("call_count", L),
                      ("data_cost_wak", D), ("voice_cost_wak", D), ("total_cost_wak", D))

LOOKUP_REQUEST = _struct(("request_id", L), ("msisdn", S), ("start_time", S), ("end_time", S))

# Messages on a topic (Kafka record shape).
TOPIC_MESSAGE = _struct(("topic", S), ("key", S), ("value", S))
