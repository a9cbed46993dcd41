"""Shuffles of the line fact, the checks and the incremental refresh at scale."""

import os
import re
from types import SimpleNamespace

import pytest

from closebook.operators.quality import Check, run_checks, words
from closebook.operators.skew import crowded
from closebook.plans import incremental, refresh, sales
from closebook.plans.catalog import QUERIES, marts
from closebook.plans.models import Marts
from closebook.session import ensure_checkpoint_dir
from closebook.sources import sinks


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def test_lines_meet_part_and_product_in_one_shuffle(spark, small_sf, no_broadcast):
    # as where parts are too many to be broadcast: each of the two scans of the lines
    # is shuffled once by product
    plan = plan_of(marts(spark, small_sf).completed_order_items)
    assert "hashpartitioning(l_partkey" not in plan
    by_product = re.findall(r"Exchange hashpartitioning\(product_id#\d+", plan)
    assert 2 <= len(by_product) <= 4, by_product        # lines and products, twice
    plan = plan_of(marts(spark, small_sf).order_line_economics)
    assert len(re.findall(r"Exchange hashpartitioning\(product_id#\d+", plan)) == 2


def test_orders_by_category_are_shuffled_once(spark, small_sf, no_broadcast):
    plan = plan_of(marts(spark, small_sf).order_categories)
    assert "hashpartitioning(order_id#" in plan
    assert not re.search(r"hashpartitioning\(order_id#\d+, category", plan)
    assert len(re.findall(r"Exchange hashpartitioning\(order_id#\d+", plan)) == 2   # lines, orders


def test_order_categories_are_alike_with_and_without_hot_orders(spark, small_sf):
    m = marts(spark, small_sf)
    one = sales.order_categories(m.line_values, m.stg_orders, m.cfg, [])
    two = sales.order_categories(m.line_values, m.stg_orders, m.cfg, [("ORD-1", 2)])
    assert sorted(map(repr, one.collect())) == sorted(map(repr, two.collect()))


def test_sketches_only_for_crowded_parts(spark, small_sf, monkeypatch):
    rows = spark.createDataFrame([("hot",)] * 50 + [(f"k{i}",) for i in range(40)] + [(None,)] * 60,
                                 "k string")
    assert crowded(rows, "k", 50) is None               # nulls meet nothing
    found = {r["k"] for r in crowded(rows, "k", 49).collect()}
    assert "hot" in found and None not in found and len(found) < 10

    def no_sketch(*a):
        raise AssertionError("no order can be hot")
    monkeypatch.setattr(sales, "order_sketch", no_sketch)
    assert marts(spark, small_sf).hot_orders == []


def test_checks_take_one_exchange_and_no_join(spark):
    child = spark.createDataFrame(
        [(i, None if i % 7 == 0 else i % 5, i % 3) for i in range(40)], "id int, p int, v int")
    parent = spark.createDataFrame([(0,), (1,), (1,), (None,)], "p int")
    checks = [Check("not_null", "child", "p"),
              *[Check("expression", "child", None, expression=f"v <> {i % 3} or id < {i}")
                for i in range(64)],
              Check("unique", "child", "id"), Check("unique", "child", "v"),
              Check("unique_combination", "child", columns=("p", "v")),
              Check("relationships", "child", "p", to_model="parent", to_field="p")]
    res = run_checks(checks, {"child": child, "parent": parent}.get)
    plan = plan_of(res)
    assert "Join" not in plan and len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    rows = [(r["id"], r["p"], r["v"]) for r in child.collect()]
    got = [r["failures"] for r in res.collect()]
    groups = [(p, v) for _, p, v in rows]
    assert got == [
        sum(p is None for _, p, _ in rows),
        *[sum(v == i % 3 and x >= i for x, _, v in rows) for i in range(64)],
        0, 3, sum(groups.count(g) > 1 for g in set(groups)),
        sum(p is not None and p not in (0, 1) for _, p, _ in rows)]


def test_checks_derive_the_ledger_once(spark, small_sf):
    plan = plan_of(QUERIES["dq_summary"](spark, small_sf))
    scans = [s for s in re.findall(r"FileScan parquet \[([^\]]*)\]", plan) if "l_orderkey" in s]
    assert len(scans) == 1                               # the check of the raw lines


def test_stored_tables_leave_no_shuffle_files(spark, tmp_path):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)

    def files():
        disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {f for f in re.findall(r"shuffle_\d+_\d+_\d+\.data", disk.getAllFiles().mkString(" "))}
    had = files()
    df = spark.range(10000).selectExpr("id % 700 AS k", "id").groupBy("k").count()
    assert sinks.stored(df, str(tmp_path / "t")).count() == 700
    path = sinks.write_clustered(df.selectExpr("k % 3 AS m", "k", "count"), str(tmp_path / "c"),
                                 "m", ("count",), "k")
    left = [f for f in files() - had]
    assert len(left) <= 1, left                          # the count() above is not a stored table
    assert spark.read.parquet(path).count() == 700 and spark.conf.get(name, None) == before


def test_incremental_refresh_deletes_its_scratch(spark, small_sf, tmp_path):
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = {f for f in os.listdir(folder) if f.startswith("closebook-incremental-")}
    raw, out = marts(spark, small_sf).raw, str(tmp_path / "fact")
    incremental.refresh_fact(spark, raw, out)
    path = incremental.refresh_fact(spark, raw, out)
    assert spark.read.parquet(path).count() == marts(spark, small_sf).completed_order_items.count()
    assert {f for f in os.listdir(folder) if f.startswith("closebook-incremental-")} <= before


# ------------------------------------- F2-F8: what the checks store and read
def rows_of(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture
def stored_columns(monkeypatch):
    """Table -> the columns of those that ``refresh`` stores."""
    seen, real = {}, sinks.stored

    def stored(df, path, *a):
        seen[path.rsplit("/", 1)[1]] = df.columns
        return real(df, path, *a)
    monkeypatch.setattr(sinks, "stored", stored)
    return seen


def feeds(spark):
    """Raw feeds with repeated products and lines, a null order, a null category, an
    order without lines and one that is not completed."""
    lines = [("i1", "A", "p1", 2, "5.00", "0.10"), ("i1", "A", "p1", 2, "5.00", "0.10"),
             ("i2", "A", "p2", 1, "7.00", None), ("i3", "B", "p3", 3, "1.50", "0.00"),
             ("i4", None, "p1", 1, "2.00", "0.00"), ("i5", "C", "p1", 1, "9.00", "0.00"),
             ("i6", "B", "gone", 1, None, "0.00"), ("i7", "B", None, 4, "3.00", "0.25")]
    orders = [("A", "c1", "delivered", "2021-03-05"), ("B", "c2", " Shipped", "2021-04-07"),
              ("C", "c1", "pending", "2021-04-09"), ("D", "c3", "delivered", "2021-05-01"),
              ("A", "c1", "pending", "2021-03-01"), (None, "c1", "delivered", "2021-05-01")]
    products = [("p1", "x", "2.00", "6.00"), ("p1", "y", None, "6.50"), ("p2", None, "3.00", "0.00"),
                ("p3", "x", "1.00", None)]

    items = spark.createDataFrame(
        [(*r, "2021-06-01") for r in lines],
        "order_item_id string, order_id string, product_id string, quantity int, "
        "unit_price string, discount_pct string, _loaded_at string").selectExpr(
        "order_item_id", "order_id", "product_id", "quantity",
        "cast(unit_price AS decimal(18,2)) unit_price",
        "cast(discount_pct AS decimal(9,4)) discount_pct",
        "cast(_loaded_at AS timestamp_ntz) _loaded_at")
    heads = spark.createDataFrame(
        orders,
        "order_id string, customer_id string, status string, at string").selectExpr(
        "order_id", "customer_id", "cast(at AS date) order_date", "cast(at AS date) shipped_date",
        "cast(null AS date) delivered_date", "status", "'online' channel", "'ASIA' region",
        *[f"cast(1 AS decimal(18,2)) {c}_amount"
          for c in ("subtotal", "discount", "tax", "shipping", "total")],
        "cast(at AS timestamp_ntz) _loaded_at")
    goods = spark.createDataFrame(
        products, "product_id string, category string, cost string, list string"
    ).selectExpr("product_id", "product_id sku", "product_id product_name", "category",
                 "'s' subcategory", "'b' brand", "cast(cost AS decimal(18,2)) cost_price",
                 "cast(list AS decimal(18,2)) list_price", "true is_active",
                 "timestamp_ntz'2021-01-01 00:00:00' _loaded_at")
    return SimpleNamespace(order_items=items, orders=heads, products=goods)


def test_fact_without_totals_equals_the_whole(spark, small_sf):
    for m in (marts(spark, small_sf), Marts(feeds(spark))):
        whole = m.completed_order_items
        columns = [c for c in sales.FACT_COLUMNS if c not in sales.ORDER_TOTALS]
        assert whole.columns == [*sales.FACT_COLUMNS]
        lean = sales.fact_columns(m.completed_lines, columns)
        assert rows_of(lean) == rows_of(whole.select(columns))
        for of in (sales.order_facts_of, sales.order_categories_of):
            a, b = of(lean), of(whole)
            assert rows_of(a.select(sorted(a.columns))) == rows_of(b.select(sorted(b.columns)))
    for c in columns:                                    # what each is made of is enough
        few = m.completed_lines.select(*sales.made_of([c]))
        assert sales.fact_columns(few, [c]).schema[0].dataType == whole.schema[c].dataType


def test_a_fact_that_one_model_reads_is_not_stored(spark, small_sf, stored_columns):
    for name in ("dq_unique", "dq_relationships"):
        plan = plan_of(QUERIES[name](spark, small_sf))
        assert "completed_order_items" not in stored_columns, name
        scans = [s for s in re.findall(r"FileScan parquet \[([^\]]*)\]", plan) if "l_orderkey" in s]
        assert len(scans) == 1, name                     # no sums of orders, none for customers


def test_the_stored_fact_has_what_is_read(spark, small_sf, stored_columns):
    QUERIES["dq_expression"](spark, small_sf)
    kept = set(stored_columns["completed_order_items"])
    assert "revenue" in kept and "order_id" in kept
    assert kept.isdisjoint({"order_item_sk", "order_item_id", "product_id", "sku", "brand",
                            "order_month", "gross_profit", *sales.ORDER_TOTALS})


def test_checks_of_totals_read_the_whole_fact(spark, small_sf, stored_columns):
    checks = [Check("expression", "completed_order_items", None,
                    expression="Order_Total_Revenue >= 0 and order_line_count < 3"),
              Check("not_null", "customer_360", "lifetime_revenue")]
    m = marts(spark, small_sf)
    res = run_checks(checks, refresh.stored_models(
        m, {"completed_order_items", "customer_360"}, words(checks)))
    assert set(sales.ORDER_TOTALS) <= set(stored_columns["completed_order_items"])
    fact, dim = m.completed_order_items, m.customer_360
    assert [r["failures"] for r in res.collect()] == [
        fact.where("not (order_total_revenue >= 0 and order_line_count < 3)").count(),
        dim.where("lifetime_revenue is null").count()]
