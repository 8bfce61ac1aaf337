"""Plan guards over every batch job: no nested-loop or cartesian joins, pruned
scans, hash aggregation except where a whole row is kept per key."""

import re

import pytest

import __spark_entry__ as E
from meterflow.plans.catalog import JOBS

SF = "/root/testdata/sf0.001"
BATCH = sorted(k for k in JOBS if not k.startswith("stream_"))


@pytest.mark.parametrize("key", BATCH)
def test_plan_shape(spark, key):
    plan = E.queries()[key](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    # Unused event columns never leave the scan.
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan) + re.findall(r"FileScan parquet [^\[]*\[([^\]]*)\]", plan):
        assert "props" not in schema and "value:" not in schema and "c_acctbal" not in schema
    if "SortAggregate" in plan:
        assert key.startswith("cdc_latest"), key


def _final_plan(df) -> str:
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    return qe.executedPlan().toString().split("== Initial Plan ==")[0]


def _shuffles(plan: str) -> int:
    return sum(1 for line in plan.splitlines()
               if line.strip(" :+-*()0123456789").startswith("Exchange hashpartitioning"))


@pytest.mark.parametrize("key", ["cdr_usage_summary", "cdr_usage_rollup", "cdr_daily_costs", "ohlc_m1",
                                 "ohlc_m30", "ohlc_h1", "hourly_costs_union", "daily_usage_rows"])
def test_single_shuffle_jobs(spark, key):
    assert _shuffles(_final_plan(E.queries()[key](spark, SF))) == 1


def test_forex_mart_reads_ticks_once(spark):
    # Candles are aggregated once and materialised; the indicator pass reads them.
    plan = _final_plan(E.queries()["forex_ohlc_indicators"](spark, SF))
    assert plan.count("FileScan") <= 1


def test_crm_fan_out_join_is_a_splittable_inner_join(spark):
    plan = E.queries()["crm_flattened"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    main = [l for l in plan.splitlines() if "Join" in l and "_jk0" in l and "LeftAnti" not in l]
    assert main and "SortMergeJoin" in main[0] and "Inner" in main[0]


@pytest.mark.parametrize("key", ["topic_json_parse", "ticks_typed", "cdc_parse_changes", "cdc_latest_accounts"])
def test_json_parsed_once(spark, key):
    plan = E.queries()[key](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


@pytest.mark.parametrize("key", ["cdr_data_typed", "cdr_quarantine"])
def test_typed_parse_once(spark, key):
    plan = E.queries()[key](spark, SF)._jdf.queryExecution().executedPlan().toString()
    # Four typed fields, one regex guard each: nothing re-evaluated inside filters.
    assert plan.count("RLIKE") == 4


def test_interactions_dedupe_map_side(spark):
    from meterflow.operators import sessions
    from meterflow.sources.fixtures import load
    df = sessions.interactions(load(spark, SF, "cdr_data"), load(spark, SF, "cdr_voice"))
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    ex = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    # A partial HashAggregate under the first shuffle: copies collapse before it.
    assert any("HashAggregate" in line for line in lines[ex + 1:])


@pytest.mark.parametrize("key", ["crm_flattened", "tower_session_pair_summary"])
def test_feeds_are_scanned_once(spark, key):
    """What reads the feeds has been written once: the plan of the result reads that, not the feeds again."""
    assert "events.parquet" not in _final_plan(E.queries()[key](spark, SF))


def test_kafka_options(spark, monkeypatch):
    """The Kafka branch of the topic source, as far as it goes without a connector: what it asks the reader for."""
    from meterflow.sources import topics
    asked = {}

    class Reader:
        def format(self, f):
            asked["format"] = f
            return self

        def option(self, k, v):
            asked[k] = v
            return self

        def load(self):
            return spark.createDataFrame([("t", bytearray(b"k"), bytearray(b"v"), 1)], "topic string, key binary, value binary, offset long")

    class Session:
        readStream = Reader()

    out = topics.read_topics(Session(), ["a", "b"], "kafka", bootstrap="h:9092", streaming=True, max_per_trigger=9)
    assert asked == {"format": "kafka", "maxOffsetsPerTrigger": 9, "kafka.bootstrap.servers": "h:9092", "subscribe": "a,b", "startingOffsets": "earliest"}
    assert [tuple(r) for r in out.collect()] == [("t", "k", "v")]
