"""Plan properties that matter at scale, read from the physical plans."""

import pytest

import __spark_entry__ as E
from skyframe.plans import adapters as ad

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_adapter_joins_only_what_columns_need(spark):
    plan = _plan(ad.flights(spark, SF, ["carrier", "arr_delay"]))
    assert "part.parquet" in plan and "orders.parquet" not in plan and "customer.parquet" not in plan


def test_scans_are_pruned_and_aggregates_partial(spark):
    df = E.queries()["air02_carriers_star"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "partial_count" in plan
    phys = df._jdf.queryExecution().sparkPlan().toString()
    assert "l_extendedprice" not in phys and "l_shipdate" not in phys      # only the needed columns


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_no_cartesian_products(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
