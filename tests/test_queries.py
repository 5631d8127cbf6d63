"""Every registered query against its SQL counterpart, run by another engine on the same tables."""

import pytest
from conftest import SMALL
from oracle_check import connect, difference

import __spark_entry__ as entry_point
from ripplelake.plans import oracle, registry

QUERIES, SQL = registry.queries(), oracle.oracle_sql()
ROWS_ONLY = {"t04_watermark_variant"}

SLOW_STEPS = ["BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"]


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_its_counterpart():
    assert set(SQL) == set(QUERIES) - ROWS_ONLY


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_result(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    assert difference(duck, df, SQL[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    for step in SLOW_STEPS:
        assert step not in plan


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_has_rows(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_entry(spark):
    assert entry_point.entry(spark).columns == ["hour", "edits", "bots", "humans"]


def test_importable_without_a_session():
    assert len(registry.TABLE) == len(QUERIES) >= 100
