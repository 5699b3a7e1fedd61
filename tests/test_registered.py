"""Every registered query against its SQL, over the whole of the smallest tables."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry_point
from permitwright.suite.registry import QUERIES as REGISTERED

QUERIES = {name: entry_point.queries()[name] for name in REGISTERED}
ORACLE = {name: sql for name, sql in entry_point.oracle_sql().items() if name in REGISTERED}

# Python workers, and joins that pair every row with every other.
UNWANTED = ["EvalPython", "InPandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin"]


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(name, spark, sf_dir, con):
    result = QUERIES[name](spark, sf_dir)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert [step for step in UNWANTED if step in plan] == []
    assert differences(result, con, ORACLE[name]) == []


def test_entry_has_rows(spark):
    assert entry_point.entry(spark).limit(1).count() == 1


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
