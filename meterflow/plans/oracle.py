"""Independent DuckDB SQL for every job in the catalogue (the acceptance oracle).

Written directly against the base tables (through the shared adapter CTEs),
in the plain relational form of each mart, so that a defect in the Spark
operator cannot hide in both.
"""

from __future__ import annotations

from ..sources.fixtures import cte

ORACLE: dict[str, str] = {}


def oracle(name: str, *tables: str):
    def deco(fn):
        body = fn().strip()
        # A body is either the final SELECT or more CTEs followed by it.
        sep = "\n" if body.upper().startswith("SELECT") else ",\n"
        ORACLE[name] = cte(*tables) + sep + body
        return fn
    return deco


def B(ts: str, n: int) -> str:
    """N-minute bucket start, the relational way."""
    if n == 60:
        return f"date_trunc('hour', {ts})"
    if n == 1:
        return f"date_trunc('minute', {ts})"
    return f"(date_trunc('hour', {ts}) + INTERVAL 1 MINUTE * ({n} * (minute({ts}) // {n})))"


@oracle("time_buckets", "cdr_data")
def _():
    t = "event_datetime"
    return f"""SELECT msisdn, event_datetime, {B(t, 1)} AS time_1min, {B(t, 15)} AS time_15min,
        {B(t, 30)} AS time_30min, {B(t, 60)} AS time_1hr, strftime({t}, '%Y-%m-%d') AS day FROM cdr_data"""


@oracle("cdr_data_15min", "cdr_data")
def _():
    t = "event_datetime"
    return f"""SELECT msisdn, data_type, {B(t, 15)} AS time_15min, {B(t, 30)} AS time_30min, {B(t, 60)} AS time_1hr,
        CAST(SUM(up_bytes) AS BIGINT) AS total_up_bytes, CAST(SUM(down_bytes) AS BIGINT) AS total_down_bytes,
        COUNT(*) AS session_count
      FROM cdr_data GROUP BY msisdn, data_type, time_15min, time_30min, time_1hr"""


@oracle("cdr_voice_15min", "cdr_voice")
def _():
    t = "start_time"
    return f"""SELECT msisdn, call_type, {B(t, 15)} AS time_15min, {B(t, 30)} AS time_30min, {B(t, 60)} AS time_1hr,
        CAST(SUM(call_duration_sec) AS BIGINT) AS total_duration_sec, COUNT(*) AS call_count
      FROM cdr_voice GROUP BY msisdn, call_type, time_15min, time_30min, time_1hr"""


# Every usage event in one shape; a measure that its category lacks is 0.
_EVENTS = """ev AS (
        SELECT 'data' AS category, msisdn, data_type AS usage_type, event_datetime AS moment, up_bytes AS up, down_bytes AS down, 0 AS secs FROM cdr_data
        UNION ALL BY NAME
        SELECT 'voice' AS category, msisdn, call_type AS usage_type, start_time AS moment, 0 AS up, 0 AS down, call_duration_sec AS secs FROM cdr_voice),
      tag(interval_type, minutes) AS (VALUES ('15min', 15), ('30min', 30), ('1hr', 60))"""
_WIDTH = "to_minutes(CAST(minutes AS INTEGER))"


def _summed(rel: str, group: str) -> str:
    return f"""SELECT interval_type, msisdn, datetime, usage_type, category, CAST(sum(up) AS BIGINT) AS total_up_bytes,
        CAST(sum(down) AS BIGINT) AS total_down_bytes, CAST(sum(up + down) AS BIGINT) AS total_bytes,
        CAST(sum(secs) AS BIGINT) AS call_duration_sec, count(*) AS session_count
      FROM {rel} GROUP BY {group}"""


@oracle("cdr_usage_summary", "cdr_data", "cdr_voice")
def _():
    # The grain stays a quarter of an hour whatever the tag: a group's bucket is its quarter's.
    return _EVENTS + f""",
      q AS (SELECT *, time_bucket(INTERVAL 15 MINUTE, moment) AS quarter, time_bucket({_WIDTH}, moment) AS datetime FROM ev CROSS JOIN tag)
      {_summed("q", "interval_type, msisdn, datetime, usage_type, category, quarter")}"""


@oracle("cdr_usage_rollup", "cdr_data", "cdr_voice")
def _():
    return _EVENTS + f""",
      q AS (SELECT *, time_bucket({_WIDTH}, moment) AS datetime FROM ev CROSS JOIN tag)
      {_summed("q", "interval_type, msisdn, datetime, usage_type, category")}"""


@oracle("daily_data_usage", "cdr_data")
def _():
    return """SELECT msisdn, strftime(event_datetime, '%Y-%m-%d') AS date, data_type,
        CAST(SUM(up_bytes) AS BIGINT) AS up_bytes, CAST(SUM(down_bytes) AS BIGINT) AS down_bytes
      FROM cdr_data GROUP BY ALL"""


@oracle("daily_voice_usage", "cdr_voice")
def _():
    return """SELECT msisdn, strftime(start_time, '%Y-%m-%d') AS date, call_type,
        CAST(SUM(call_duration_sec) AS BIGINT) AS call_duration_sec, COUNT(*) AS call_count
      FROM cdr_voice GROUP BY ALL"""


# Cents, rounded half-up on the exact value: data 4900/2^30 per byte, voice 100/60 per second.
def _cents_data(b: str) -> str:
    return f"((CAST({b} AS HUGEINT) * 4900 * 2 + 1073741824) // 2147483648)"


def _cents_voice(s: str) -> str:
    return f"((CAST({s} AS HUGEINT) * 100 * 2 + 60) // 120)"


def _cents_total(b: str, s: str) -> str:
    return (f"((CAST({b} AS HUGEINT) * 294000 + CAST({s} AS HUGEINT) * 107374182400) * 2 + 64424509440)"
            " // 128849018880")


@oracle("cdr_daily_costs", "cdr_data", "cdr_voice")
def _():
    return f"""u AS (
        SELECT msisdn, strftime(event_datetime, '%Y-%m-%d') AS date, up_bytes + down_bytes AS b, 0 AS s FROM cdr_data
        UNION ALL
        SELECT msisdn, strftime(start_time, '%Y-%m-%d'), 0, call_duration_sec FROM cdr_voice),
      g AS (SELECT msisdn, date, CAST(SUM(b) AS BIGINT) AS data_bytes, CAST(SUM(s) AS BIGINT) AS voice_seconds
            FROM u GROUP BY ALL)
      SELECT msisdn, date, data_bytes, voice_seconds,
        CAST({_cents_data('data_bytes')} AS DOUBLE) / 100 AS data_cost_wak,
        CAST({_cents_voice('voice_seconds')} AS DOUBLE) / 100 AS voice_cost_wak,
        CAST({_cents_total('data_bytes', 'voice_seconds')} AS DOUBLE) / 100 AS total_cost_wak
      FROM g"""


# -- mart 4 ---------------------------------------------------------------------------------

_MU = "CAST(round((bid_price + ask_price) * 1000000) AS BIGINT)"


@oracle("tick_mid_price", "forex_ticks")
def _():
    return f"""SELECT tick_time, pair_name, bid_price, ask_price, {_MU} AS mid_units,
        CAST({_MU} AS DOUBLE) / 2000000 AS mid_price FROM forex_ticks"""


def _candle_ctes(minutes: int, name: str) -> str:
    # Time and price as one order key, of which the least and greatest tick open and close the candle.
    return f"""{name} AS (SELECT pair_name, time_bucket(INTERVAL {minutes} MINUTE, tick_time) AS candle_time,
          arg_min(mu, (tick_time, mu)) AS o, arg_max(mu, (tick_time, mu)) AS c, max(mu) AS h, min(mu) AS l, count(*) AS n
        FROM ticks GROUP BY ALL)"""


_TICKS = f"ticks AS (SELECT tick_time, pair_name, {_MU} AS mu FROM forex_ticks)"


def _priced_sql(name: str, with_count: bool) -> str:
    n = ", n AS tick_count" if with_count else ""
    return (f"SELECT pair_name, candle_time, CAST(o AS DOUBLE) / 2000000 AS open_price, CAST(h AS DOUBLE) / 2000000 AS high_price, "
            f"CAST(l AS DOUBLE) / 2000000 AS low_price, CAST(c AS DOUBLE) / 2000000 AS close_price{n} FROM {name}")


for _key, _m, _cnt in (("ohlc_m1", 1, True), ("ohlc_m30", 30, False), ("ohlc_h1", 60, False),
                       ("ohlc_m1_windowed", 1, True)):
    ORACLE[_key] = cte("forex_ticks") + ",\n" + _TICKS + ",\n" + _candle_ctes(_m, "k") + "\n" + _priced_sql("k", _cnt)


def _ind_sql(name: str, tag: str) -> str:
    def avg(x: str, n: int) -> str:
        w = f"(PARTITION BY pair_name ORDER BY candle_time ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
        return f"CAST(SUM({x}) OVER {w} AS DOUBLE) / COUNT(*) OVER {w} / 2000000"
    return (f"SELECT pair_name, candle_time, CAST(o AS DOUBLE) / 2000000 AS open_price, CAST(h AS DOUBLE) / 2000000 AS high_price, "
            f"CAST(l AS DOUBLE) / 2000000 AS low_price, CAST(c AS DOUBLE) / 2000000 AS close_price, '{tag}' AS timeframe, "
            f"{avg('o', 8)} AS ema_8, {avg('o', 21)} AS ema_21, {avg('h - l', 8)} AS atr_8, {avg('h - l', 21)} AS atr_21 "
            f"FROM {name}")


ORACLE["forex_ohlc_indicators"] = (
    cte("forex_ticks") + ",\n" + _TICKS + ",\n" + _candle_ctes(1, "m1") + ",\n" + _candle_ctes(30, "m30") + ",\n"
    + _candle_ctes(60, "h1") + "\n" + "\nUNION ALL\n".join(
        _ind_sql(n, t) for n, t in (("m1", "M1"), ("m30", "M30"), ("h1", "H1")))
    + "\nORDER BY pair_name, timeframe, candle_time")


@oracle("tick_partition_key", "forex_ticks")
def _():
    return "SELECT tick_time, pair_name, pair_name || '-' || strftime(tick_time, '%Y-%m-%d %H:%M') AS message_key FROM forex_ticks"


# -- mart 2 ---------------------------------------------------------------------------------

_INTER = """i AS (SELECT msisdn, tower_id, event_datetime FROM cdr_data
               UNION SELECT msisdn, tower_id, start_time FROM cdr_voice),
      n AS (SELECT msisdn, tower_id, event_datetime,
              lag(tower_id) OVER w AS prev_tower, lag(event_datetime) OVER w AS prev_time,
              lead(tower_id) OVER w AS next_tower, lead(event_datetime) OVER w AS next_time
            FROM i WINDOW w AS (PARTITION BY msisdn ORDER BY event_datetime, tower_id))"""


@oracle("tower_interactions", "cdr_data", "cdr_voice")
def _():
    return _INTER + "\nSELECT * FROM n"


@oracle("tower_sessions", "cdr_data", "cdr_voice")
def _():
    return _INTER + """,
      f AS (SELECT *, SUM(CASE WHEN prev_tower IS NOT DISTINCT FROM tower_id THEN 0 ELSE 1 END)
                 OVER (PARTITION BY msisdn ORDER BY event_datetime, tower_id ROWS UNBOUNDED PRECEDING) AS sid FROM n),
      g AS (SELECT msisdn, tower_id, MIN(event_datetime) AS session_start, MAX(event_datetime) AS session_end
            FROM f GROUP BY msisdn, sid, tower_id)
      SELECT msisdn, tower_id, session_start, session_end,
        CAST(epoch_us(session_end) - epoch_us(session_start) AS DOUBLE) / 3600000000 AS duration_hours
      FROM g WHERE session_start < session_end"""


# -- mart 3 ---------------------------------------------------------------------------------

# The contract's account columns, in its order: an account, its address if any, one row a device.
_INFO_COLUMNS = ["account_id", "owner_name", "email", "phone_number", "street_address", "city", "state", "postal_code", "country",
                 "device_id", "device_name", "device_type", "device_os"]
_INFO = f"""info AS (SELECT {", ".join(_INFO_COLUMNS)} FROM accounts LEFT JOIN addresses USING (account_id) LEFT JOIN devices USING (account_id))"""
# Bytes and seconds of every subscriber-hour from one pass over both feeds; money from the sums.
_HOURLY = """used AS (
        SELECT msisdn, date_trunc('hour', event_datetime) AS hour, up_bytes + down_bytes AS b, 0 AS s FROM cdr_data
        UNION ALL SELECT msisdn, date_trunc('hour', start_time), 0, call_duration_sec FROM cdr_voice),
      costs AS (SELECT msisdn, hour, CAST(sum(b) AS BIGINT) AS data_bytes, CAST(sum(s) AS BIGINT) AS voice_seconds,
                  sum(b)::DOUBLE * 49 / 1073741824 AS data_cost_zar, sum(s)::DOUBLE / 60 AS voice_cost_zar,
                  sum(b)::DOUBLE * 49 / 1073741824 + sum(s)::DOUBLE / 60 AS total_cost_zar
                FROM used GROUP BY msisdn, hour)"""
_RB = """bal AS (SELECT c.*, (SELECT sum(e.data_bytes)::DOUBLE * 49 / 1073741824 + sum(e.voice_seconds)::DOUBLE / 60
                   FROM costs e WHERE e.msisdn IS NOT DISTINCT FROM c.msisdn AND e.hour <= c.hour) AS cumulative_cost_zar FROM costs c)"""
_WAK = ", ".join(f"{c}_cost_zar AS {c}_cost_wak" for c in ("data", "voice", "total", "cumulative"))


@oracle("crm_account_info", "accounts", "addresses", "devices")
def _():
    return _INFO + "\nSELECT * FROM info"


@oracle("hourly_data_cost", "cdr_data")
def _():
    return """SELECT msisdn, date_trunc('hour', event_datetime) AS hour, CAST(SUM(up_bytes + down_bytes) AS BIGINT) AS data_bytes,
        CAST(SUM(up_bytes + down_bytes) AS DOUBLE) * 49 / 1073741824 AS data_cost_zar FROM cdr_data GROUP BY ALL"""


@oracle("hourly_voice_cost", "cdr_voice")
def _():
    return """SELECT msisdn, date_trunc('hour', start_time) AS hour, CAST(SUM(call_duration_sec) AS BIGINT) AS voice_seconds,
        CAST(SUM(call_duration_sec) AS DOUBLE) / 60 AS voice_cost_zar FROM cdr_voice GROUP BY ALL"""


@oracle("hourly_costs", "cdr_data", "cdr_voice")
def _():
    return _HOURLY + "\nSELECT * FROM costs"


ORACLE["hourly_costs_union"] = ORACLE["hourly_costs"]


@oracle("running_balance", "cdr_data", "cdr_voice")
def _():
    return _HOURLY + ",\n" + _RB + f"\nSELECT *, {_WAK} FROM bal"


@oracle("crm_flattened", "cdr_data", "cdr_voice", "accounts", "addresses", "devices")
def _():
    return _INFO + ",\n" + _HOURLY + ",\n" + _RB + f"""
      SELECT msisdn, hour AS datetime, {", ".join(_INFO_COLUMNS)}, data_cost_zar, voice_cost_zar, total_cost_zar, cumulative_cost_zar, {_WAK}
      FROM bal LEFT JOIN info ON phone_number = msisdn"""


# -- raw layer ------------------------------------------------------------------------------

_INT_RE = r"^\s*[+-]?\d+\s*$"
_TS_RE = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(\.\d{1,6})?$"


def _int(c: str, t: str = "INTEGER") -> str:
    return f"CASE WHEN regexp_matches({c}, '{_INT_RE}') THEN TRY_CAST(trim({c}) AS {t}) END"


def _ts(c: str) -> str:
    return f"CASE WHEN regexp_matches({c}, '{_TS_RE}') THEN TRY_CAST({c} AS TIMESTAMP) END"


_DATA_PARSED = f"""p AS (SELECT msisdn AS r_msisdn, tower_id AS r_tower_id, up_bytes AS r_up_bytes, down_bytes AS r_down_bytes,
          data_type AS r_data_type, ip_address AS r_ip_address, website_url AS r_website_url,
          event_datetime AS r_event_datetime,
          msisdn, {_int('tower_id')} AS tower_id, {_int('up_bytes', 'BIGINT')} AS up_bytes,
          {_int('down_bytes', 'BIGINT')} AS down_bytes, data_type, ip_address, website_url,
          {_ts('event_datetime')} AS event_datetime
        FROM cdr_data_wire),
      q AS (SELECT *, concat_ws(',', CASE WHEN length(msisdn) > 20 THEN 'msisdn' END,
                 CASE WHEN tower_id IS NULL THEN 'tower_id' END,
                 CASE WHEN up_bytes IS NULL THEN 'up_bytes' END, CASE WHEN down_bytes IS NULL THEN 'down_bytes' END,
                 CASE WHEN length(data_type) > 50 THEN 'data_type' END,
                 CASE WHEN length(ip_address) > 45 THEN 'ip_address' END,
                 CASE WHEN length(website_url) > 500 THEN 'website_url' END,
                 CASE WHEN event_datetime IS NULL THEN 'event_datetime' END) AS errors FROM p)"""

_DATA_GOOD = ("SELECT msisdn, tower_id, up_bytes, down_bytes, data_type, ip_address, website_url, event_datetime "
              "FROM q WHERE errors = ''")


@oracle("cdr_data_typed", "cdr_data_wire")
def _():
    return _DATA_PARSED + "\n" + _DATA_GOOD


ORACLE["topic_json_parse"] = ORACLE["cdr_data_typed"]


@oracle("cdr_quarantine", "cdr_data_wire")
def _():
    return _DATA_PARSED + """
      SELECT r_msisdn AS msisdn, r_tower_id AS tower_id, r_up_bytes AS up_bytes, r_down_bytes AS down_bytes,
        r_data_type AS data_type, r_ip_address AS ip_address, r_website_url AS website_url,
        r_event_datetime AS event_datetime, errors FROM q WHERE errors <> ''"""


_VOICE_PARSED = f"""p AS (SELECT msisdn AS r_msisdn, tower_id AS r_tower_id, call_type AS r_call_type, dest_nr AS r_dest_nr,
          call_duration_sec AS r_call_duration_sec, start_time AS r_start_time,
          msisdn, {_int('tower_id')} AS tower_id, call_type, dest_nr, {_int('call_duration_sec')} AS call_duration_sec,
          {_ts('start_time')} AS start_time
        FROM cdr_voice_wire),
      q AS (SELECT *, concat_ws(',', CASE WHEN length(msisdn) > 20 THEN 'msisdn' END,
                 CASE WHEN tower_id IS NULL THEN 'tower_id' END,
                 CASE WHEN length(call_type) > 50 THEN 'call_type' END,
                 CASE WHEN length(dest_nr) > 20 THEN 'dest_nr' END,
                 CASE WHEN call_duration_sec IS NULL THEN 'call_duration_sec' END,
                 CASE WHEN start_time IS NULL THEN 'start_time' END) AS errors FROM p)"""


@oracle("cdr_voice_typed", "cdr_voice_wire")
def _():
    return _VOICE_PARSED + "\nSELECT msisdn, tower_id, call_type, dest_nr, call_duration_sec, start_time FROM q WHERE errors = ''"


@oracle("cdr_voice_quarantine", "cdr_voice_wire")
def _():
    return _VOICE_PARSED + """
      SELECT r_msisdn AS msisdn, r_tower_id AS tower_id, r_call_type AS call_type, r_dest_nr AS dest_nr,
        r_call_duration_sec AS call_duration_sec, r_start_time AS start_time, errors FROM q WHERE errors <> ''"""


@oracle("timestamp_parse", "cdr_data_wire")
def _():
    return f"SELECT event_datetime AS event_text, {_ts('event_datetime')} AS event_time FROM cdr_data_wire"


@oracle("ticks_typed", "tick_wire")
def _():
    return f"""SELECT * FROM (SELECT {_ts('timestamp')} AS tick_time, pair_name, bid_price, ask_price, spread FROM tick_wire)
      WHERE tick_time IS NOT NULL AND bid_price IS NOT NULL AND ask_price IS NOT NULL
        AND COALESCE(length(pair_name) <= 10, true)"""


@oracle("cdr_to_topic_json", "cdr_data_wire")
def _():
    return """SELECT 'cdr-data' AS topic, CASE WHEN msisdn <> '' THEN msisdn END AS key,
        CAST(to_json({'msisdn': msisdn, 'tower_id': tower_id, 'up_bytes': up_bytes, 'down_bytes': down_bytes,
                 'data_type': data_type, 'ip_address': ip_address, 'website_url': website_url,
                 'event_datetime': event_datetime}) AS VARCHAR) AS value
      FROM cdr_data_wire"""


@oracle("cdc_parse_changes", "account_changes")
def _():
    return """SELECT op, lsn, account_id, CASE WHEN op <> 'd' THEN owner_name END AS owner_name,
        CASE WHEN op <> 'd' THEN email END AS email, CASE WHEN op <> 'd' THEN phone_number END AS phone_number,
        modified_ts FROM account_changes"""


def _latest(table: str, key: str, cols: str) -> str:
    return f"""SELECT {key}, {cols}, modified_ts FROM (
        SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY modified_ts DESC, lsn DESC) AS rn FROM {table})
      WHERE rn = 1 AND op <> 'd'"""


ORACLE["cdc_latest_accounts"] = cte("account_changes") + "\n" + _latest(
    "account_changes", "account_id", "owner_name, email, phone_number")
ORACLE["cdc_latest_addresses"] = cte("address_changes") + "\n" + _latest(
    "address_changes", "account_id", "street_address, city, state, postal_code, country")
ORACLE["cdc_latest_devices"] = cte("device_changes") + "\n" + _latest(
    "device_changes", "device_id", "account_id, device_name, device_type, device_os")


# -- serving ----------------------------------------------------------------------------------

_TYPE_USAGE = """tu0 AS (
        SELECT msisdn, strftime(event_datetime, '%Y-%m-%d') AS date, 'data' AS category, data_type AS usage_type,
               up_bytes, down_bytes, 0 AS dur, 0 AS calls FROM cdr_data
        UNION ALL
        SELECT msisdn, strftime(start_time, '%Y-%m-%d'), 'voice', call_type, 0, 0, call_duration_sec, 1 FROM cdr_voice),
      tu AS (SELECT msisdn, date, category, usage_type, CAST(SUM(up_bytes) AS BIGINT) AS up_bytes,
               CAST(SUM(down_bytes) AS BIGINT) AS down_bytes, CAST(SUM(dur) AS BIGINT) AS call_duration_sec,
               CAST(SUM(calls) AS BIGINT) AS call_count FROM tu0 GROUP BY ALL)"""
_ROWS = f"""rows AS (SELECT msisdn, date, CAST(0 AS INTEGER) AS hour, category, usage_type, up_bytes, down_bytes,
          call_duration_sec, call_count,
          CASE WHEN category = 'data' THEN CAST({_cents_data('up_bytes + down_bytes')} AS DOUBLE) / 100 ELSE 0.0 END
            AS data_cost_wak,
          CASE WHEN category <> 'data' THEN CAST({_cents_voice('call_duration_sec')} AS DOUBLE) / 100 ELSE 0.0 END
            AS voice_cost_wak
        FROM tu)"""
_ROWS_SELECT = "SELECT *, data_cost_wak + voice_cost_wak AS total_cost_wak FROM rows"


@oracle("daily_usage_rows", "cdr_data", "cdr_voice")
def _():
    return _TYPE_USAGE + ",\n" + _ROWS + "\n" + _ROWS_SELECT


ORACLE["daily_summary_rows"] = ORACLE["daily_usage_rows"]


@oracle("classify_usage", "cdr_data", "cdr_voice")
def _():
    return _TYPE_USAGE + """
      SELECT msisdn, date, usage_type,
        CASE WHEN up_bytes > 0 OR down_bytes > 0 THEN 'data' ELSE 'call' END AS category,
        CASE WHEN up_bytes > 0 OR down_bytes > 0 THEN up_bytes + down_bytes ELSE call_duration_sec END AS total,
        CASE WHEN up_bytes > 0 OR down_bytes > 0 THEN 'bytes' ELSE 'seconds' END AS measure
      FROM tu"""


_REQ = """req AS (SELECT *,
          CASE WHEN regexp_matches(start_time, '^\\d{14}$') THEN try_strptime(start_time, '%Y%m%d%H%M%S') END AS st,
          CASE WHEN regexp_matches(end_time, '^\\d{14}$') THEN try_strptime(end_time, '%Y%m%d%H%M%S') END AS et
        FROM lookup_requests),
      req2 AS (SELECT *, CASE
          WHEN msisdn IS NULL OR msisdn = '' OR start_time IS NULL OR start_time = '' OR end_time IS NULL OR end_time = ''
            THEN 'Missing required parameters: msisdn, start_time, end_time'
          WHEN st IS NULL OR et IS NULL THEN 'Invalid timestamp format. Use YYYYMMDDHHmmss' END AS error FROM req)"""


@oracle("lookup_request_errors", "lookup_requests")
def _():
    return _REQ + "\nSELECT request_id, msisdn, start_time, end_time, error FROM req2 WHERE error IS NOT NULL"


@oracle("usage_lookup", "lookup_requests", "cdr_data", "cdr_voice")
def _():
    return _REQ + ",\n" + _TYPE_USAGE + """
      SELECT r.request_id, u.msisdn, strftime(r.st, '%Y-%m-%d %H:%M:%S') AS request_start,
        strftime(r.et, '%Y-%m-%d %H:%M:%S') AS request_end,
        CASE WHEN u.category = 'data' THEN 'data' ELSE 'call' END AS category, u.usage_type,
        CASE WHEN u.category = 'data' THEN u.up_bytes + u.down_bytes ELSE u.call_duration_sec END AS total,
        CASE WHEN u.category = 'data' THEN 'bytes' ELSE 'seconds' END AS measure,
        u.date || ' 00:00:00' AS start_time
      FROM req2 r JOIN tu u ON r.msisdn = u.msisdn
        AND u.date BETWEEN strftime(r.st, '%Y-%m-%d') AND strftime(r.et, '%Y-%m-%d')
      WHERE r.error IS NULL"""


# -- streams ----------------------------------------------------------------------------------

ORACLE["stream_daily_usage"] = cte("cdr_data", "cdr_voice") + ",\n" + _TYPE_USAGE + "\nSELECT * FROM tu"
ORACLE["stream_daily_usage_late"] = ORACLE["stream_daily_usage"]
ORACLE["stream_raw_ingest"] = ORACLE["cdr_data_typed"]


@oracle("cdr_csv_typed", "cdr_data_drop")
def _():
    return f"""SELECT msisdn, CAST(tower_id AS INTEGER) AS tower_id, CAST(up_bytes AS BIGINT) AS up_bytes, CAST(down_bytes AS BIGINT) AS down_bytes,
        data_type, CASE WHEN layout < 2 THEN ip_address END AS ip_address, website_url, {_ts('event_datetime')} AS event_datetime
      FROM cdr_data_drop WHERE up_bytes NOT LIKE '%bad%'"""


ORACLE["stream_csv_ingest"] = ORACLE["cdr_csv_typed"]
ORACLE["stream_cdc_accounts"] = ORACLE["cdc_latest_accounts"]


@oracle("stream_daily_summary", "cdr_data", "cdr_voice")
def _():
    return _TYPE_USAGE + f""",
      s AS (SELECT msisdn, date, COUNT(*) FILTER (WHERE category = 'data') AS data_types,
                   COUNT(*) FILTER (WHERE category = 'voice') AS voice_types,
                   CAST(SUM(up_bytes + down_bytes) AS BIGINT) AS b, CAST(SUM(call_duration_sec) AS BIGINT) AS s
            FROM tu GROUP BY ALL)
      SELECT msisdn, date, CAST(data_types AS INTEGER) AS data_types, CAST(voice_types AS INTEGER) AS voice_types,
        CAST({_cents_data('b')} AS DOUBLE) / 100 AS data_cost_wak,
        CAST({_cents_voice('s')} AS DOUBLE) / 100 AS voice_cost_wak,
        CAST({_cents_total('b', 's')} AS DOUBLE) / 100 AS total_cost_wak
      FROM s"""


@oracle("tower_session_pair_summary", "cdr_data", "cdr_voice")
def _():
    return _INTER + """,
      r AS (SELECT msisdn, tower_id, event_datetime,
              COALESCE(next_tower = tower_id, false) OR prev_tower IS NULL AS is_s,
              COALESCE(prev_tower = tower_id, false) OR next_tower IS NULL AS is_e
            FROM n),
      w AS (SELECT *,
              COUNT(*) FILTER (WHERE is_e) OVER later AS end_count,
              MIN(event_datetime) FILTER (WHERE is_e) OVER later AS first_end,
              MAX(event_datetime) FILTER (WHERE is_e) OVER later AS last_end,
              SUM(epoch_us(event_datetime)) FILTER (WHERE is_e) OVER later AS sum_us
            FROM r WHERE is_s OR is_e
            WINDOW later AS (PARTITION BY msisdn, tower_id ORDER BY event_datetime
                             ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))
      SELECT msisdn, tower_id, event_datetime AS session_start, end_count, first_end, last_end,
        CAST(sum_us - end_count * epoch_us(event_datetime) AS DOUBLE) / 3600000000 AS total_duration_hours
      FROM w WHERE is_s AND end_count > 0"""


@oracle("usage_lookup_response", "lookup_requests", "cdr_data", "cdr_voice")
def _():
    return _REQ + ",\n" + _TYPE_USAGE + """,
      hits AS (
        SELECT r.request_id,
          CASE WHEN u.category = 'data' THEN 'data' ELSE 'call' END AS category, u.usage_type,
          CASE WHEN u.category = 'data' THEN u.up_bytes + u.down_bytes ELSE u.call_duration_sec END AS total,
          CASE WHEN u.category = 'data' THEN 'bytes' ELSE 'seconds' END AS measure,
          u.date || ' 00:00:00' AS start_time
        FROM req2 r JOIN tu u ON r.msisdn = u.msisdn
          AND u.date BETWEEN strftime(r.st, '%Y-%m-%d') AND strftime(r.et, '%Y-%m-%d')
        WHERE r.error IS NULL),
      agg AS (
        SELECT request_id, list({'category': category, 'usage_type': usage_type, 'total': total,
                                 'measure': measure, 'start_time': start_time}
                                ORDER BY category, usage_type, total, measure, start_time) AS usage
        FROM hits GROUP BY request_id)
      SELECT r.request_id, CAST(to_json({'msisdn': r.msisdn, 'start_time': strftime(r.st, '%Y-%m-%d %H:%M:%S'),
                                    'end_time': strftime(r.et, '%Y-%m-%d %H:%M:%S'),
                                    'usage': COALESCE(a.usage, [])}) AS VARCHAR) AS response
      FROM req2 r LEFT JOIN agg a ON r.request_id = a.request_id
      WHERE r.error IS NULL"""


@oracle("daily_summary_nested", "cdr_data", "cdr_voice")
def _():
    return _TYPE_USAGE + f""",
      s AS (
        SELECT msisdn, date,
          COALESCE(map_from_entries(list({{'key': usage_type, 'value': {{'up': up_bytes, 'down': down_bytes}}}}
                   ORDER BY usage_type) FILTER (WHERE category = 'data')), MAP {{}}) AS data_usage,
          COALESCE(map_from_entries(list({{'key': usage_type, 'value': {{'duration': call_duration_sec,
                   'count': call_count}}}} ORDER BY usage_type) FILTER (WHERE category = 'voice')), MAP {{}}) AS voice_usage,
          CAST(SUM(CASE WHEN category = 'data' THEN up_bytes + down_bytes ELSE 0 END) AS BIGINT) AS b,
          CAST(SUM(CASE WHEN category = 'voice' THEN call_duration_sec ELSE 0 END) AS BIGINT) AS s
        FROM tu GROUP BY msisdn, date)
      SELECT msisdn, date, CAST(to_json({{'msisdn': msisdn, 'date': date, 'data_usage': data_usage,
          'voice_usage': voice_usage,
          'costs': {{'data_cost_wak': CAST({_cents_data('b')} AS DOUBLE) / 100,
                    'voice_cost_wak': CAST({_cents_voice('s')} AS DOUBLE) / 100,
                    'total_cost_wak': CAST({_cents_total('b', 's')} AS DOUBLE) / 100}}}}) AS VARCHAR) AS summary
      FROM s"""


ORACLE["stream_idle_flush"] = ORACLE["stream_daily_summary"]
ORACLE["stream_daily_usage_bounded"] = ORACLE["stream_daily_usage"]
ORACLE["stream_summary_to_serving"] = ORACLE["daily_usage_rows"]
ORACLE["stream_cdc_addresses"] = ORACLE["cdc_latest_addresses"]
ORACLE["stream_cdc_devices"] = ORACLE["cdc_latest_devices"]


@oracle("stream_cdc_dead_letters", "account_changes")
def _():
    # Deletes have no row image to lose.
    return """SELECT lsn, CASE WHEN lsn % 53 = 0 THEN 'unreadable' WHEN lsn % 59 = 0 THEN 'no row image' ELSE 'no key' END AS error
      FROM account_changes WHERE lsn % 53 = 0 OR (lsn % 59 = 0 AND op <> 'd') OR (lsn % 59 <> 0 AND lsn % 61 = 0)"""
