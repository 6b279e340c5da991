"""Every registered query against its SQL at the smallest scale, and what its plan must not contain."""

import pytest

import __spark_entry__ as entry_points
from tests.compare import compare, connect
from venuelake import catalog

SF = "/root/testdata/sf0.001"
NAMES = list(catalog.all_queries())


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(catalog.all_oracles()) == set(NAMES)
    assert set(NAMES) <= set(entry_points.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    df = entry_points.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name}: {bad}"
    assert compare(df, con, entry_points.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry_points.entry(spark).count() == 7


def test_filters_and_columns_reach_the_scan(spark):
    plan = entry_points.queries()["j_topn_semi"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "l_tax" not in plan and "l_discount" not in plan
    plan = entry_points.queries()["r_service_account"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "o_totalprice" not in plan
