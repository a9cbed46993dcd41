"""Physical-plan shape: no cartesian products, no Python UDFs, pruned scans,
partial top-1 dedupe, and the shuffle budget of the fact."""

import re

import pytest

from closebook.plans.catalog import QUERIES


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark, small_sf):
    return {name: _plan(fn(spark, small_sf)) for name, fn in QUERIES.items()}


def test_no_cartesian_or_nested_loop_join(plans):
    for name, plan in plans.items():
        assert "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name


def test_no_python_udf(plans):
    for name, plan in plans.items():
        assert not re.search(r"BatchEvalPython|ArrowEvalPython|PythonUDF|FlatMapGroupsInPandas", plan), name


def test_dedupe_is_a_partial_top1(plans):
    plan = plans["stg_orders"]
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_lineitem_scan_is_pruned(plans):
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plans["completed_order_items"])
    line_scans = [s for s in scans if "l_orderkey" in s]
    assert line_scans
    for s in line_scans:
        assert "l_returnflag" not in s and "l_tax" not in s and "l_shipdate" not in s


def test_fact_shuffle_budget(plans, spark, small_sf):
    # lines once, orders once (their dedupe's partitioning serves the joins) and
    # per-order partial sums once; the hot-order list is a sketch's, made before.
    plan = plans["completed_order_items"]
    assert len(re.findall(r"Exchange hashpartitioning\(order_id#\d+", plan)) == 3
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 3
    assert len(re.findall(r"Exchange hashpartitioning", plans["order_line_economics"])) == 2


def line_scans(plan):
    return [s for s in re.findall(r"FileScan parquet \[([^\]]*)\]", plan) if "l_orderkey" in s]


def test_line_scan_budgets(plans):
    # the second scan of the fact reads per-order sums
    assert len(line_scans(plans["completed_order_items"])) == 2
    assert len(line_scans(plans["unrecognised_revenue_check"])) == 2
    for name in ("order_line_economics", "orphan_lines", "missing_cost_lines"):
        assert len(line_scans(plans[name])) == 1, name
    # these read the categories of orders twice, from a stored table
    for name in ("revenue_performance_monthly", "yoy_calendar"):
        assert not line_scans(plans[name]), name
    # the checks read stored marts; raw lines, and the ledger derived from lines, are left
    assert len(line_scans(plans["dq_summary"])) <= 5


def test_unrecognised_revenue_reads_its_tables(plans):
    plan = plans["unrecognised_revenue_check"]
    assert line_scans(plan) and "o_orderstatus" in plan and "LocalTableScan" not in plan


def test_order_grain_marts_shuffle_no_line_rows(plans):
    # customer 360: orders (dedupe), per-order partial line sums, customers,
    # metrics by customer -- the lines themselves are never exchanged.
    for name in ("customer_360", "order_totals", "customer_aov_per_order"):
        plan = plans[name]
        line_exchanges = re.findall(r"Exchange hashpartitioning\(order_id#\d+, \d+\)", plan)
        assert "partial_sum" in plan, name
        assert len(line_exchanges) == 2, (name, line_exchanges)   # orders + partial sums


def test_ledger_joins_chart_by_broadcast_and_shares_one_exchange(plans):
    plan = plans["gl_activity_monthly"]
    assert re.search(r"BroadcastHashJoin \[account_code#\d+\], \[account_code#\d+\], Inner", plan)
    # the monthly aggregate and both windows (lag 12, YTD) share one exchange
    assert len(re.findall(r"Exchange hashpartitioning\(account_code#\d+, \d+\)", plan)) == 1
