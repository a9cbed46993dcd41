"""Whole-row dedupe, raw digits, assertions, null and hot keys, failed writes, clock."""

import datetime as dt
from decimal import Decimal as D
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from closebook.__main__ import feeds_from, main
from closebook.config import MartConfig
from closebook.operators.quality import Check, run_checks
from closebook.plans import checks, finance, sales, staging
from closebook.plans.catalog import MODEL_QUERIES
from closebook.plans.models import Marts
from closebook.plans.refresh import refresh
from closebook.sources import sinks
from closebook.sources.files import read_csv_seed
from closebook.sources.schemas import RAW_SCHEMAS
from fixture_feeds import feeds

T = dt.datetime(2024, 1, 5)


def _order(delivered, subtotal, channel="online"):
    return ("O1", "C1", dt.date(2024, 1, 1), None, delivered, "delivered", channel, "north",
            D(subtotal), D(0), D(0), D(0), D(10), T)


def test_tied_orders_do_not_depend_on_input_order(spark):
    a, b = _order(dt.date(2024, 1, 3), "10.00"), _order(dt.date(2024, 1, 9), "7.00")
    c, d = _order(None, "7.00", None), _order(None, "7.00", "")
    for rows in ([a, b], [c, d], [a, c]):
        kept = [staging.stg_orders(spark.createDataFrame(r, RAW_SCHEMAS["orders"]).coalesce(1)).collect()
                for r in (rows, rows[::-1])]
        assert len(kept[0]) == 1 and kept[0] == kept[1]
    wide = spark.createDataFrame([a, b], RAW_SCHEMAS["orders"])
    narrow = wide.withColumn("subtotal_amount", F.col("subtotal_amount").cast("decimal(18,2)"))
    assert staging.stg_orders(wide).collect() == staging.stg_orders(narrow).collect()


def test_raw_digits_reach_staging(spark, tmp_path):
    (tmp_path / "raw_order_items.csv").write_text(
        "order_item_id,order_id,product_id,quantity,unit_price,discount_pct,_loaded_at\n"
        "I1,O1,P1,100,3.335,0.33333,2024-01-01 00:00:00\n")
    raw = read_csv_seed(spark, "order_items", str(tmp_path / "raw_order_items.csv"))
    row = staging.stg_order_items(raw).first()
    want = (100 * D("3.335") * (1 - D("0.33333"))).quantize(D("0.01"))
    assert row["net_amount"] == want
    assert (row["unit_price"], row["discount_pct"]) == (D("3.34"), D("0.3333"))


def test_check_ids_tell_long_expressions_apart():
    long = "order_date >= DATE '2020-01-01' and order_total_revenue "
    ids = {Check("expression", "m", None, expression=long + x).check_id for x in ("> 0", "< 9")}
    assert len(ids) == 2


def test_unrecognised_revenue_of_a_stored_fact(spark, tmp_path):
    raw = feeds(spark)
    m = Marts(raw)
    sinks.write_table(m.completed_order_items, str(tmp_path / "fact"))
    fact = sinks.read_table(spark, str(tmp_path / "fact"))
    assert finance.unrecognised_revenue_check(fact, m.stg_orders).count() == 0
    victim = fact.first()["order_id"]
    cancelled = m.stg_orders.withColumn("order_status", F.when(
        F.col("order_id") == victim, "cancelled").otherwise(F.col("order_status")))
    found = finance.unrecognised_revenue_check(fact, cancelled).collect()
    assert found and {(r["order_id"], r["order_status"]) for r in found} == {(victim, "cancelled")}
    gone = finance.unrecognised_revenue_check(fact, m.stg_orders.where(F.col("order_id") != victim))
    assert {r["order_status"] for r in gone.collect()} == {None}
    assert {a.name: a.cadence for a in checks.ASSERTIONS} == {
        "revenue_reconciliation": "weekly", "unrecognised_revenue": "every build"}


def test_checks_count_duplicates_orphans_and_flags(spark):
    child = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), (None, 2), ("z", 2), ("z", 3)],
                                  "k string, v int")
    parent = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    get = {"child": child, "parent": parent}.__getitem__
    found = {r["kind"]: r["failures"] for r in run_checks([
        Check("not_null", "child", "v"), Check("unique", "child", "k"),
        Check("unique_combination", "child", columns=("k", "v")),
        Check("relationships", "child", "k", to_model="parent", to_field="k"),
        Check("expression", "child", "v", expression="v < 3"),
        Check("accepted_values", "child", "k", values=("a", "b"))], get).collect()}
    assert found == {"not_null": 1, "unique": 2, "unique_combination": 1, "relationships": 2,
                     "expression": 1, "accepted_values": 2}
    none = child.limit(0)
    assert {r["failures"] for r in run_checks(
        [Check("not_null", "child", "v"), Check("unique", "child", "k")],
        {"child": none}.__getitem__).collect()} == {0}


def test_lines_without_an_order_id_are_kept_and_spread(spark):
    raw = feeds(spark)
    lines = spark.range(600).select(
        F.concat(F.lit("N"), "id").alias("order_item_id"), F.lit(None).cast("string").alias("order_id"),
        F.lit("P1").alias("product_id"), F.lit(1).alias("quantity"),
        F.lit(2).cast("decimal(16,6)").alias("unit_price"),
        F.lit(0).cast("decimal(9,8)").alias("discount_pct"), F.lit(T).cast("timestamp_ntz").alias("_loaded_at"))
    m = Marts(SimpleNamespace(**{**vars(raw), "order_items": raw.order_items.unionByName(lines)}))
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                          "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for got in (m.order_line_economics,
                    sales.orphan_lines(m.stg_order_items, m.stg_orders, m.hot_orders)):
            rows = got.where(F.col("order_id").isNull())
            per_task = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
            assert sum(per_task) == 600 and max(per_task) < 300
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "32MB")


def test_an_order_is_split_without_a_cap(spark):
    from closebook.operators.skew import hot_keys, sketch
    rows = spark.range(30_000).select(F.when(F.col("id") < 20_000, "hot").otherwise(
        F.col("id").cast("string")).alias("k"))
    assert hot_keys(sketch(rows, "k"), 3) == [("hot", 6667)]


def test_clustered_files_are_even_under_a_hot_day(spark, tmp_path):
    n = 60_000
    df = spark.range(n).select(
        F.concat(F.lit("I"), F.lpad("id", 8, "0")).alias("order_item_id"),
        F.when(F.col("id") % 3 == 0, F.lit(dt.date(2024, 1, 7))).otherwise(
            F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 60).cast("int"))).alias("order_date"),
        F.lit("online").alias("sales_channel"), F.md5(F.col("id").cast("string")).alias("x"))
    df = df.withColumn("order_month", F.trunc("order_date", "month")).repartition(4)
    v = sinks.write_clustered(df, str(tmp_path / "t"), "order_month", ("order_date", "sales_channel"),
                              "order_item_id", file_bytes=60_000)
    per_file = [r["count"] for r in spark.read.parquet(v).groupBy(F.input_file_name()).count().collect()]
    assert sum(per_file) == n and len(per_file) >= 20
    assert max(per_file) <= 2 * n / len(per_file)


def test_a_failed_rewrite_leaves_the_table(spark, tmp_path):
    path, snap = str(tmp_path / "t"), str(tmp_path / "snap")
    good, bad = spark.range(100), spark.range(100).select(
        F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    sinks.write_table(good, path)
    with pytest.raises(Exception):
        sinks.write_table(bad, path)
    assert sinks.read_table(spark, path).count() == 100
    for k in (7, 8, 9):
        sinks.write_table(spark.range(k), path)
    assert sinks.read_table(spark, path).count() == 9
    assert len([p for p in (tmp_path / "t").iterdir() if p.is_dir()]) == 2
    with pytest.raises(Exception):
        sinks.write_versioned(bad, snap, "1")
    assert spark.read.parquet(sinks.write_versioned(good, snap, "1")).count() == 100
    with pytest.raises(FileExistsError):
        sinks.write_versioned(good, snap, "1")
    with pytest.raises(FileNotFoundError):
        sinks.read_table(spark, str(tmp_path / "none"))


def test_a_mart_refreshed_alone_reads_the_stored_upstream(spark, tmp_path):
    out, raw = str(tmp_path / "marts"), feeds(spark)
    refresh(spark, raw, out)
    whole = {n: sinks.read_table(spark, f"{out}/{n}").collect()
             for n in ("customer_360", "revenue_performance_monthly", "income_statement_monthly")}
    empty = SimpleNamespace(**{**vars(raw), "order_items": raw.order_items.limit(0),
                               "gl_entries": raw.gl_entries.limit(0)})
    refresh(spark, empty, out, select=tuple(whole))
    for n, rows in whole.items():
        assert sorted(map(repr, sinks.read_table(spark, f"{out}/{n}").collect())) == sorted(map(repr, rows))


def test_the_clock_of_a_run(spark, tmp_path, capsys):
    from closebook.sources.files import write_feeds
    base = write_feeds(feeds(spark), str(tmp_path / "feeds"),
                       names=tuple(RAW_SCHEMAS))
    newest = spark.read.parquet(f"{base}/raw_orders").agg(F.max("_loaded_at")).first()[0]
    states = []
    for hours in (1, 30, 100):
        main(["freshness", "--sources", base, "--as-of", (newest + dt.timedelta(hours=hours)).isoformat()],
             spark)
        states.append([x for x in capsys.readouterr().out.splitlines() if x.startswith("orders")][0]
                      .split("\t")[1])
    assert states == ["pass", "warn", "error"]
    early = {c.check_id: c.expression for c in checks.all_checks(MartConfig(as_of=dt.date(2021, 1, 1)))}
    assert any("2021-01-01" in (e or "") for e in early.values())


def test_feeds_without_extracts_and_table_sources(spark, tmp_path):
    raw = feeds(spark)
    for ns, names in (("sales_raw", ("orders", "order_items", "customers", "products")),
                      ("fin_raw", ("gl_entries", "chart_of_accounts", "budgets"))):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {ns} LOCATION '{tmp_path}/{ns}'")
        for n in names:
            df = getattr(raw, n)
            if n == "order_items":  # a source may hold wider or narrower types
                df = df.withColumn("quantity", F.col("quantity").cast("long"))
            df.write.mode("overwrite").saveAsTable(f"{ns}.raw_{n}")
    try:
        stored = feeds_from(spark, "sales_raw", "table", "fin_raw")
        assert stored.order_items.schema["quantity"].dataType.simpleString() == "int"
        m, lazy = Marts(stored), Marts(raw)
        for n in ("completed_order_items", "income_statement_monthly"):
            assert sorted(map(repr, m.model(n).collect())) == sorted(map(repr, lazy.model(n).collect()))
        history = MODEL_QUERIES["customer_history"](m)
        assert history.count() == m.stg_customers.count()
        assert MODEL_QUERIES["segment_at_purchase"](m).count() > 0
    finally:
        spark.sql("DROP DATABASE sales_raw CASCADE"), spark.sql("DROP DATABASE fin_raw CASCADE")


def test_monthly_mart_from_lines_equals_that_from_the_stored_fact(spark, small_sf):
    from closebook.sources.tpch import RawFeeds
    m = Marts(RawFeeds(spark, small_sf))
    stored = sales.revenue_performance_monthly(
        sales.order_categories_of(m.completed_order_items), sales.new_customers_monthly(m.customer_360))
    lazy = m.revenue_performance_monthly
    assert stored.exceptAll(lazy).count() == 0 and lazy.exceptAll(stored).count() == 0
    dim = sales.customer_360(m.stg_customers, sales.order_facts_of(m.completed_order_items))
    assert dim.exceptAll(m.customer_360).count() == 0 and m.customer_360.exceptAll(dim).count() == 0
