"""Every registered query against its SQL, and rules every plan must keep."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as contract
from tallyhouse.registry import QUERIES
from tests.oracle_check import compare, connect

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables here")

# The text operators, where present, have tests of their own.
SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def engine():
    return connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(contract.queries())
    assert set(QUERIES) <= set(SQL) <= set(contract.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows_as_sql(spark, engine, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for refused in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert refused not in plan, refused
    assert compare(df, engine, SQL[name]) == []


def test_entry(spark):
    assert contract.entry(spark).count() > 0
