"""Plan-shape guards: the physical plans keep the shuffles we designed for
(read from ``explain``, as a user would)."""

import re

import pytest

from paths import SF_SMALL
from tidecast.plans import catalog

Q = catalog.queries()


def _plan(spark, capsys, name):
    capsys.readouterr()
    Q[name](spark, SF_SMALL).explain("formatted")
    return capsys.readouterr().out


def _exchanges(plan: str) -> list[str]:
    tree = plan.split("\n\n")[0]
    return re.findall(r"(?<!Broadcast)Exchange \(\d+\)", tree)   # shuffles only


@pytest.mark.parametrize("name,limit", [
    ("error_by_horizon", 2),      # panel aggregation + the one Store window partitioning
    ("compare_methods", 2),
    ("best_scenario", 2),         # forecast + insights + ranking add no shuffle
    ("forecast_response", 2),
    ("days_until_next_promo", 2),  # asc and desc promo scans share the partitioning
])
def test_shuffle_count(spark, capsys, name, limit):
    plan = _plan(spark, capsys, name)
    assert len(_exchanges(plan)) <= limit, plan


def test_scan_prunes_and_pushes(spark, capsys):
    plan = _plan(spark, capsys, "error_by_horizon")
    li = [b for b in plan.split("\n\n") if "lineitem.parquet" in b][0]
    # only the three columns the flagship needs are read
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in li
    assert "PushedFilters: [IsNotNull(l_suppkey)]" in li
    # the store dimension and the supplier side are broadcast (Spark's size estimate)
    assert "BroadcastHashJoin" in plan
    # the leakage column's distinct count is pruned away
    assert "count(distinct" not in plan.lower()


def test_store_filter_reaches_the_scan(spark, capsys):
    plan = _plan(spark, capsys, "filter_store")
    sup = [b for b in plan.split("\n\n") if "supplier.parquet" in b][0]
    assert "In(s_nationkey, [1,3,7])" in sup
