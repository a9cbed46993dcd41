"""Checks that read no price: lines meet no product for them."""

import re
import shutil

import pytest

from closebook.operators.dedupe import keyed
from closebook.plans import sales
from closebook.plans.catalog import QUERIES, marts
from closebook.plans.models import Marts
from closebook.sources.tpch import RawFeeds
from test_round_four import feeds, plan_of, rows_of


@pytest.fixture
def repeated_parts(spark, small_sf, tmp_path):
    """Driver tables whose parts come twice in part, one of them without a key."""
    for name in ("orders", "lineitem", "customer", "supplier", "nation", "region"):
        shutil.copy(f"{small_sf}/{name}.parquet", tmp_path)
    part = spark.read.parquet(f"{small_sf}/part.parquet")
    again = part.where("p_partkey % 3 = 0").selectExpr(
        "if(p_partkey = 3, null, p_partkey) AS p_partkey", "p_name", "p_brand", "p_type", "p_size",
        "p_retailprice + 1 AS p_retailprice")
    part.unionByName(again).write.parquet(str(tmp_path / "part.parquet"))
    return str(tmp_path)


def test_a_keyed_side_is_dropped_only_if_its_key_is_unique(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")
    once = spark.createDataFrame([(1, 5), (2, 6), (None, 7), (None, 8)], "p int, w int")
    twice = once.union(spark.createDataFrame([(1, 9)], "p int, w int"))
    for right, dropped in ((once, True), (twice, False)):
        j = left.join(keyed(right, "p"), left.k == right.p, "left")
        assert ("Join" not in plan_of(j.select("v"))) == dropped
        plain = left.join(right, left.k == right.p, "left")
        assert rows_of(j.select("v")) == rows_of(plain.select("v"))
        assert rows_of(j.select("v", "w")) == rows_of(plain.select("v", "w"))


def test_checks_without_prices_meet_no_product(spark, small_sf):
    # What is left are the checks of the parts themselves, as products.
    for name in ("dq_unique", "dq_relationships", "dq_not_null", "dq_expression"):
        plan = plan_of(QUERIES[name](spark, small_sf))
        scans = [s for s in re.findall(r"FileScan parquet \[([^\]]*)\]", plan) if "p_partkey" in s]
        assert len(scans) == (name != "dq_expression"), name


def test_unpriced_lines_equal_the_priced(spark, small_sf, repeated_parts):
    for m in (marts(spark, small_sf), marts(spark, repeated_parts), Marts(feeds(spark))):
        columns = [c for c in sales.FACT_COLUMNS if c not in sales.ORDER_TOTALS
                   and sales.PRICED.isdisjoint(sales.made_of([c]))]
        assert {"order_item_sk", "order_id", "customer_id", "order_month"} <= set(columns)
        lean, whole = (sales.fact_columns(x, columns) for x in (m.unpriced_lines, m.completed_lines))
        assert rows_of(lean) == rows_of(whole)
    raw, few = RawFeeds(spark, repeated_parts), RawFeeds(spark, small_sf)
    assert raw.unpriced_items.count() > few.unpriced_items.count()
    for r in (raw, few):
        assert rows_of(r.unpriced_items) == rows_of(r.order_items)
        stored = r.ledger_of(spark.createDataFrame(r.order_postings.collect(),
                                                   r.order_postings.schema))
        assert rows_of(stored) == rows_of(r.gl_entries)


def test_checks_count_lines_of_repeated_parts(spark, repeated_parts):
    failures = {r["check_id"]: r["failures"] for r in QUERIES["dq_unique"](
        spark, repeated_parts).collect()}
    m = marts(spark, repeated_parts)
    twice = m.completed_lines.groupBy("order_item_id").count().where("count > 1").count()
    assert twice > 0 and failures["unique__completed_order_items__order_item_id"] == twice
