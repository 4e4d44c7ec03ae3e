"""Every registered query against its SQL on the smallest tables."""

import pytest
from compare import connect, difference, spark_rows, sql_rows

import __spark_entry__ as entry
from qaloom.plans.catalog import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"

# Pairs of everything with everything, and Python called row by row.
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"]


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in FORBIDDEN if node in plan]
    got = spark_rows(df)
    assert difference(got, sql_rows(con, ORACLES[name])) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and all(r.chunks >= r.documents > 0 for r in rows)
