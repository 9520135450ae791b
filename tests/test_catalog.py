"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as driver
from lakesync import catalog
from tests.conftest import SF
from tools.compare import connect, differences

QUERIES, ORACLES = catalog.QUERIES, catalog.ORACLES


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert differences(spark, con, QUERIES[name], ORACLES[name], SF) == ""


def test_entry_returns_rows(spark):
    assert driver.entry(spark).count() > 0


def test_no_query_runs_python_or_a_nested_loop(spark):
    for name, build in QUERIES.items():
        plan = build(spark, SF)._jdf.queryExecution().executedPlan().toString()
        for node in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert node not in plan, f"{name}: {node}"


def test_change_windows_reach_the_scan(spark):
    for name in ("window_closed", "window_half_open", "window_minute", "shared_discovery"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        pushed = plan.split("PushedFilters: ")[1].split("]")[0]
        assert "GreaterThanOrEqual(ts" in pushed, f"{name}: {pushed}"
