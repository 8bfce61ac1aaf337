"""Adapters from the shared test tables to this library's domain tables.

The test data is a generic event/customer/order star schema. Each adapter is
a list of SQL expressions written in the dialect subset that Spark and DuckDB
share, so the very same text builds the Spark DataFrame (``selectExpr``) and
the CTE prefix of the independent DuckDB oracle. Every adapter is a pure
projection/filter of a whole table: its size grows with the input.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

MSISDN_OF_USER = "'27' || lpad(CAST(user_id AS STRING), 8, '0')"
# A number of their own for all but one pair of customers in five, who share one, at every size.
PHONE_OF_CUSTOMER = "'27' || lpad(CAST({k} - CASE WHEN {k} % 10 = 1 THEN 1 ELSE 0 END AS STRING), 8, '0')"

# Fixed values of the domains: data types, call types, currency pairs,
# provinces, device types and device operating systems.
DATA_TYPE_OF_ID = ("CASE event_id % 5 WHEN 0 THEN 'video' WHEN 1 THEN 'audio' WHEN 2 THEN 'image' "
                   "WHEN 3 THEN 'text' ELSE 'application' END")
CALL_TYPE_OF_ID = "CASE WHEN event_id % 2 = 0 THEN 'voice' ELSE 'video' END"
PAIR_OF_ID = "CASE WHEN event_id % 2 = 0 THEN 'MRVZAR' ELSE 'WAKMRV' END"
STATE_OF = ("CASE {k} % 9 WHEN 0 THEN 'EC' WHEN 1 THEN 'FS' WHEN 2 THEN 'GP' WHEN 3 THEN 'KZN' "
            "WHEN 4 THEN 'LP' WHEN 5 THEN 'MP' WHEN 6 THEN 'NC' WHEN 7 THEN 'NW' ELSE 'WC' END")
DEVICE_TYPE_OF = ("CASE {k} % 4 WHEN 0 THEN 'Mobile' WHEN 1 THEN 'Tablet' WHEN 2 THEN 'Laptop' "
                  "ELSE 'Desktop' END")
DEVICE_OS_OF = ("CASE {k} % 5 WHEN 0 THEN 'iOS' WHEN 1 THEN 'Android' WHEN 2 THEN 'Windows' "
                "WHEN 3 THEN 'macOS' ELSE 'Linux' END")

UP = "100000 + (event_id * 7919) % 900001"
DOWN = "100000 + (event_id * 104729) % 900001"
BID_UNITS = "(10000 + (event_id * 7919) % 10001)"   # price in 1/10000
SPREAD_UNITS = "(100 + (event_id * 13) % 401)"
TS_TEXT = "CAST(ts AS STRING)"


@dataclass(frozen=True)
class Adapter:
    name: str
    source: str                      # FROM clause over the base tables
    columns: list[str]               # "expr AS name"
    where: str | None = None
    tables: tuple[str, ...] = field(default=())

    def sql(self) -> str:
        w = f" WHERE {self.where}" if self.where else ""
        return f"SELECT {', '.join(self.columns)} FROM {self.source}{w}"


DATA_EVENTS = "event_type IN ('view', 'click', 'error')"
VOICE_EVENTS = "event_type IN ('purchase', 'signup')"

ADAPTERS: dict[str, Adapter] = {a.name: a for a in [
    Adapter("cdr_data", "events", [
        f"{MSISDN_OF_USER} AS msisdn",
        "CAST(1 + event_id % 3 AS INT) AS tower_id",
        f"{UP} AS up_bytes",
        f"{DOWN} AS down_bytes",
        f"{DATA_TYPE_OF_ID} AS data_type",
        "'10.' || CAST(user_id % 256 AS STRING) || '.' || CAST(event_id % 256 AS STRING) || '.1' AS ip_address",
        "'https://www.site' || CAST(event_id % 97 AS STRING) || '.co.za' AS website_url",
        "ts AS event_datetime",
    ], DATA_EVENTS, ("events",)),
    Adapter("cdr_voice", "events", [
        f"{MSISDN_OF_USER} AS msisdn",
        "CAST(1 + event_id % 3 AS INT) AS tower_id",
        f"{CALL_TYPE_OF_ID} AS call_type",
        "'27' || lpad(CAST((event_id * 7) % 100000000 AS STRING), 8, '0') AS dest_nr",
        "CAST(1 + (event_id * 31) % 1800 AS INT) AS call_duration_sec",
        "ts AS start_time",
    ], VOICE_EVENTS, ("events",)),
    Adapter("forex_ticks", "events", [
        "ts AS tick_time",
        f"{PAIR_OF_ID} AS pair_name",
        f"{BID_UNITS} / 10000 AS bid_price",
        f"({BID_UNITS} + {SPREAD_UNITS}) / 10000 AS ask_price",
        f"{SPREAD_UNITS} / 10000 AS spread",
    ], None, ("events",)),
    Adapter("accounts", "customer", [
        "c_custkey AS account_id",
        "c_name AS owner_name",
        "lower(replace(c_name, '#', '.')) || '@example.co.za' AS email",
        PHONE_OF_CUSTOMER.format(k="c_custkey") + " AS phone_number",
    ], None, ("customer",)),
    Adapter("addresses",
            "customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey", [
                "c_custkey AS account_id",
                "CAST(c_custkey AS STRING) || ' Main Road' AS street_address",
                "n_name AS city",
                STATE_OF.format(k="c_custkey") + " AS state",
                "lpad(CAST(c_custkey % 10000 AS STRING), 4, '0') AS postal_code",
                "r_name AS country",
            ], None, ("customer", "nation", "region")),
    Adapter("devices", "orders", [
        "o_orderkey AS device_id",
        "o_custkey AS account_id",
        "o_orderpriority AS device_name",
        DEVICE_TYPE_OF.format(k="o_orderkey") + " AS device_type",
        DEVICE_OS_OF.format(k="o_orderkey") + " AS device_os",
    ], None, ("orders",)),
    # Wire form of the data drop: every field is text; some rows carry a bad
    # measure or a bad time, half the times have no fraction.
    Adapter("cdr_data_wire", "events", [
        f"{MSISDN_OF_USER} AS msisdn",
        "CAST(1 + event_id % 3 AS STRING) AS tower_id",
        f"CASE WHEN event_id % 97 = 0 THEN 'bad' ELSE CAST({UP} AS STRING) END AS up_bytes",
        f"CAST({DOWN} AS STRING) AS down_bytes",
        f"{DATA_TYPE_OF_ID} AS data_type",
        "'10.' || CAST(user_id % 256 AS STRING) || '.' || CAST(event_id % 256 AS STRING) || '.1' AS ip_address",
        "'https://www.site' || CAST(event_id % 97 AS STRING) || '.co.za' AS website_url",
        f"CASE WHEN event_id % 89 = 0 THEN 'not a time' WHEN event_id % 2 = 0 THEN substr({TS_TEXT}, 1, 19) "
        f"ELSE {TS_TEXT} END AS event_datetime",
    ], DATA_EVENTS, ("events",)),
    Adapter("cdr_voice_wire", "events", [
        f"{MSISDN_OF_USER} AS msisdn",
        "CAST(1 + event_id % 3 AS STRING) AS tower_id",
        f"{CALL_TYPE_OF_ID} AS call_type",
        "'27' || lpad(CAST((event_id * 7) % 100000000 AS STRING), 8, '0') AS dest_nr",
        "CASE WHEN event_id % 101 = 0 THEN '12.5' ELSE CAST(1 + (event_id * 31) % 1800 AS STRING) END "
        "AS call_duration_sec",
        f"CASE WHEN event_id % 2 = 0 THEN substr({TS_TEXT}, 1, 19) ELSE {TS_TEXT} END AS start_time",
    ], VOICE_EVENTS, ("events",)),
    # CSV drops of the data feed: addresses with separators and quotes, and which of three headers a row's file has.
    Adapter("cdr_data_drop", "events", [
        f"{MSISDN_OF_USER} AS msisdn",
        "CAST(1 + event_id % 3 AS STRING) AS tower_id",
        f"CASE WHEN event_id % 97 = 0 THEN 'bad, \"bad\"' ELSE CAST({UP} AS STRING) END AS up_bytes",
        f"CAST({DOWN} AS STRING) AS down_bytes",
        f"{DATA_TYPE_OF_ID} AS data_type",
        "'10.' || CAST(user_id % 256 AS STRING) || '.' || CAST(event_id % 256 AS STRING) || '.1' AS ip_address",
        "'https://www.site' || CAST(event_id % 97 AS STRING) || '.co.za/?q=\"a,' || CAST(event_id % 7 AS STRING) || '\",b' AS website_url",
        f"{TS_TEXT} AS event_datetime",
        "CAST(event_id % 3 AS INT) AS layout",
    ], DATA_EVENTS, ("events",)),
    # Tick messages: text time (some unreadable), numeric prices.
    Adapter("tick_wire", "events", [
        f"CASE WHEN event_id % 83 = 0 THEN 'n/a' ELSE {TS_TEXT} END AS timestamp",
        f"{PAIR_OF_ID} AS pair_name",
        f"{BID_UNITS} / 10000 AS bid_price",
        f"({BID_UNITS} + {SPREAD_UNITS}) / 10000 AS ask_price",
        f"{SPREAD_UNITS} / 10000 AS spread",
    ], None, ("events",)),
    # Change feed of the three CRM tables, one change per order.
    Adapter("account_changes", "orders", [
        "o_custkey AS account_id",
        "'Owner#' || CAST(o_orderkey AS STRING) AS owner_name",
        "'owner' || CAST(o_orderkey AS STRING) || '@example.co.za' AS email",
        PHONE_OF_CUSTOMER.format(k="o_custkey") + " AS phone_number",
        "o_orderdate AS modified_ts",
        "o_orderkey AS lsn",
        "CASE WHEN o_orderkey % 50 = 0 THEN 'd' WHEN o_orderkey % 3 = 0 THEN 'c' ELSE 'u' END AS op",
    ], None, ("orders",)),
    Adapter("address_changes", "orders", [
        "o_custkey AS account_id",
        "CAST(o_orderkey AS STRING) || ' Long Street' AS street_address",
        "'City' || CAST(o_orderkey % 100 AS STRING) AS city",
        STATE_OF.format(k="o_orderkey") + " AS state",
        "lpad(CAST(o_orderkey % 10000 AS STRING), 4, '0') AS postal_code",
        "'ZAR' AS country",
        "o_orderdate AS modified_ts",
        "o_orderkey AS lsn",
        "CASE WHEN o_orderkey % 45 = 0 THEN 'd' WHEN o_orderkey % 4 = 0 THEN 'c' ELSE 'u' END AS op",
    ], None, ("orders",)),
    Adapter("device_changes", "orders", [
        "o_custkey * 10 + o_orderkey % 3 AS device_id",
        "o_custkey AS account_id",
        "o_orderpriority AS device_name",
        DEVICE_TYPE_OF.format(k="o_orderkey") + " AS device_type",
        DEVICE_OS_OF.format(k="o_orderkey") + " AS device_os",
        "o_orderdate AS modified_ts",
        "o_orderkey AS lsn",
        "CASE WHEN o_orderkey % 40 = 0 THEN 'd' WHEN o_orderkey % 5 = 0 THEN 'c' ELSE 'u' END AS op",
    ], None, ("orders",)),
    # Bulk usage lookups: one request per customer; some lack the subscriber,
    # some carry a malformed start time.
    Adapter("lookup_requests", "customer", [
        "c_custkey AS request_id",
        "CASE WHEN c_custkey % 40 = 7 THEN NULL ELSE " + PHONE_OF_CUSTOMER.format(k="c_custkey") + " END AS msisdn",
        "CASE WHEN c_custkey % 25 = 0 THEN 'invalid' ELSE "
        "'202401' || lpad(CAST(1 + c_custkey % 20 AS STRING), 2, '0') || '010203' END AS start_time",
        "'202401' || lpad(CAST(6 + c_custkey % 20 AS STRING), 2, '0') || '235959' AS end_time",
    ], None, ("customer",)),
]}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Build one domain table from the base tables in ``sf_dir``."""
    a = ADAPTERS[name]
    if name == "addresses":
        c = read_table(spark, sf_dir, "customer")
        n = read_table(spark, sf_dir, "nation")
        r = read_table(spark, sf_dir, "region")
        df = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    else:
        df = read_table(spark, sf_dir, a.source)
    if a.where:
        df = df.where(a.where)
    return df.selectExpr(*a.columns)


def load_all(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {n: load(spark, sf_dir, n) for n in names}


def cte(*names: str) -> str:
    """``WITH`` prefix defining the named domain tables for the DuckDB oracle."""
    return "WITH " + ",\n".join(f"{n} AS ({ADAPTERS[n].sql()})" for n in names)


def load_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same adapter over a file stream of its base table (one-table adapters only)."""
    a = ADAPTERS[name]
    if len(a.tables) != 1:
        raise ValueError(f"{name} joins several tables; stream one table at a time")
    src = a.tables[0]
    schema = read_table(spark, sf_dir, src).schema
    df = (spark.readStream.schema(schema).option("pathGlobFilter", f"{src}.parquet")
          .parquet(sf_dir.rstrip("/")))
    if a.where:
        df = df.where(a.where)
    return df.selectExpr(*a.columns)
