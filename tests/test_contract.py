"""The driver contract: entry(), queries() and oracle_sql(), each query checked
against its DuckDB oracle on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as entry
from oracle_check import compare, duck

from conftest import SF_SMALL

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns == ["n_name", "customer_count"]


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert len(QUERIES) >= 40


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # no query may pair rows without an equi-join key
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan, plan
    result = df.toPandas()
    if name not in ORACLES:
        assert len(result) > 0
        return
    ok, msg = compare(result, con.execute(ORACLES[name]).fetchdf())
    assert ok, msg
