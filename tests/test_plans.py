"""What the plans must not do, and what must reach the scans."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from paxflow.config import Roles
from paxflow.operators import metrics, rolling, split
from workload import views as V

SF_DIR = "/root/testdata/sf0.001"
MODELS = {
    "gbt_forecast", "gbt_predictions", "forecast_quality", "feature_importance", "top_features", "learning_curve"
}


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - MODELS))
def test_no_pairwise_joins_and_no_row_functions(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan


def test_windows_read_only_what_they_need(spark):
    rows = V.table(spark, SF_DIR, "orders")
    roles = Roles(time="o_orderdate", row_id="o_orderkey", target="o_totalprice")
    plan = plan_of(rolling.narrow(rows, ["o_orderstatus"], roles))
    (columns,) = set(re.findall(r"ReadSchema: struct<([^>]*)>", plan))
    names = {c.split(":")[0] for c in columns.split(",")}
    assert names == {"o_orderkey", "o_orderdate", "o_totalprice", "o_orderstatus"}


def test_sets_and_days_are_filtered_in_the_scan(spark):
    rows = V.table(spark, SF_DIR, "orders")
    roles = Roles(time="o_orderdate", row_id="o_orderkey")
    limits = split.Limits("1999-01-01", "2000-07-01", "2001-01-01")
    for part in split.split_sets(rows, limits, roles):
        assert re.search(r"PushedFilters: \[[^\]]*LessThan\(o_orderdate", plan_of(part))
    both = metrics.forecast_join(
        rows, rows.select("o_orderkey", "o_orderdate"), roles, day="1998-01-01"
    )
    assert len(re.findall(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(o_orderdate", plan_of(both))) == 2


def test_grouping_sets_come_from_one_scan(spark):
    plan = plan_of(entry.queries()["by_dims_grouping_sets"](spark, SF_DIR))
    physical = plan[plan.index("Physical Plan") :]
    assert physical.count("FileScan") == 1
    # Expanded after the first aggregation, not before.
    assert physical.index("Expand") < physical.rindex("HashAggregate")


def test_row_features_are_not_broadcast(spark):
    rows = V.orders(spark, SF_DIR)
    plan = plan_of(rolling.rolling_features(rows, ["terminal"], roles=V.ROLES))
    physical = plan[plan.index("Physical Plan") :]
    # The join of the rows stands on top; what is broadcast below has one row per sort partition.
    assert physical.index("SortMergeJoin") < physical.index("BroadcastHashJoin")
