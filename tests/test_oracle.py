"""Every registered job against its DuckDB oracle on the smallest test tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import TABLES, digest, type_diffs  # noqa: E402
from meterflow.plans.catalog import JOBS  # noqa: E402

SF = "/root/testdata/sf0.001"
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
@pytest.mark.parametrize("key", sorted(JOBS))
def test_job_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if key not in ORACLE:
        assert df.columns
        return
    cur = con.execute(ORACLE[key])
    assert type_diffs(df, cur) == []
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(rows, df.columns) == digest(orows, ocols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns and df.count() >= 0


def test_every_job_has_an_oracle():
    assert set(JOBS) <= set(ORACLE)
