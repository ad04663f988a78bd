"""Every registered query against its SQL, and the others for rows and schema."""

import pytest
from check_oracles import compare, connect

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
#: Those have tests of their own, against brute force.
LLM = set(entry.CORPUS_QUERIES)


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, con, sf, name):
    df = QUERIES[name](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert compare(con, df, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - LLM))
def test_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
