"""One order (and one customer) holds a third of all lines.

With a low hot-key threshold the line-to-order join spreads the hot order
over several salted tasks; results must equal a brute-force computation in
plain Python, and the hot order's lines must land in several partitions.
"""

import datetime as dt
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal as D
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from closebook.config import MartConfig
from closebook.plans.models import Marts
from closebook.sources.schemas import RAW_SCHEMAS
from closebook.sources.tpch import CHART_OF_ACCOUNTS

T = dt.datetime


def _feeds(spark):
    orders, items = [], []
    n_small = 400
    for k in range(n_small):
        oid = f"O{k}"
        orders.append((oid, f"C{k % 50}", dt.date(2024, 1 + k % 12, 1 + k % 28), None, None,
                       "delivered" if k % 3 else "shipped", "online", "east",
                       D("1.00"), D("0"), D("0"), D("0"), D("1.00"), T(2024, 1, 1)))
        for j in range(1 + k % 4):
            items.append((f"I{k}-{j}", oid, f"P{j}", 1 + j, D("10.00"), D("0.1000"), T(2024, 1, 1)))
    small_lines = len(items)
    orders.append(("HOT", "BIG", dt.date(2024, 5, 5), None, None, "delivered", "retail", "west",
                   D("1.00"), D("0"), D("0"), D("0"), D("1.00"), T(2024, 1, 1)))
    for j in range(small_lines // 2):
        items.append((f"H{j}", "HOT", f"P{j % 3}", 1 + j % 5, D("3.50"), D("0.0500"), T(2024, 1, 1)))
    for j in range(3):                       # lines of an order that does not exist
        items.append((f"X{j}", "MISSING", "P0", 1, D("10.00"), D("0.0000"), T(2024, 1, 1)))
    products = [(f"P{i}", f"S{i}", f"n{i}", "cat" + str(i % 2), "s", "b",
                 D("2.00"), D("12.00"), True, T(2024, 1, 1)) for i in range(4)]
    customers = [(f"C{i}", "a", "b", "e", "consumer", "x", "y", dt.date(2023, 1, 1), T(2024, 1, 1))
                 for i in range(50)]
    customers.append(("BIG", "a", "b", "e", "corporate", "x", "y", dt.date(2023, 1, 1), T(2024, 1, 1)))
    mk = lambda rows, name: spark.createDataFrame(rows, RAW_SCHEMAS[name]).repartition(8)
    return SimpleNamespace(
        orders=mk(orders, "orders"), order_items=mk(items, "order_items"),
        customers=mk(customers, "customers"), products=mk(products, "products"),
        gl_entries=mk([], "gl_entries"),
        chart_of_accounts=mk([r + (T(2024, 1, 1),) for r in CHART_OF_ACCOUNTS], "chart_of_accounts"),
        budgets=mk([], "budgets")), items, products


@pytest.fixture
def skewed_conf(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _brute(items, products):
    cost = {p[0]: p[6] for p in products}
    by_order = defaultdict(lambda: [D(0), D(0), 0])
    for _, oid, pid, q, price, disc, _ in items:
        net = (q * price * (1 - disc)).quantize(D("0.01"), rounding=ROUND_HALF_UP)
        by_order[oid][0] += net
        by_order[oid][1] += q * cost[pid]
        by_order[oid][2] += 1
    return by_order


def test_hot_order_results_and_split(spark, skewed_conf):
    raw, items, products = _feeds(spark)
    m = Marts(raw, MartConfig(rows_per_join_task=60))
    fact = m.completed_order_items
    rows = fact.groupBy("order_id").agg(
        F.sum("revenue").alias("rev"), F.max("order_total_revenue").alias("tot"),
        F.max("order_line_count").alias("n"), F.sum("cogs").alias("cogs")).collect()
    want = _brute(items, products)
    want.pop("MISSING")
    got = {r["order_id"]: r for r in rows}
    assert set(got) == set(want)
    for oid, (rev, cogs, n) in want.items():
        assert got[oid]["rev"] == rev and got[oid]["tot"] == rev
        assert got[oid]["n"] == n and got[oid]["cogs"] == cogs
    dim = {r["customer_id"]: r for r in m.customer_360.collect()}
    assert dim["BIG"]["total_completed_orders"] == 1
    assert dim["BIG"]["lifetime_revenue"] == want["HOT"][0]

    # The hot order's lines were joined in several partitions (salts).
    parts = (fact.where(F.col("order_id") == "HOT")
                 .select(F.spark_partition_id().alias("p")).distinct().count())
    assert parts > 1


def test_hot_order_left_and_anti_joins(spark, skewed_conf):
    from closebook.plans import sales
    raw, items, _ = _feeds(spark)
    cfg = MartConfig(rows_per_join_task=60)
    m = Marts(raw, cfg)
    econ = m.order_line_economics
    assert econ.count() == len(items)                        # left join keeps every line
    assert econ.where(F.col("customer_id").isNull()).count() == 3
    assert econ.where(F.col("order_id") == "HOT").select("customer_id").distinct().collect()[0][0] == "BIG"
    orphans = sales.orphan_lines(m.stg_order_items, m.stg_orders, m.hot_orders)
    assert sorted(r["order_item_id"] for r in orphans.collect()) == ["X0", "X1", "X2"]
