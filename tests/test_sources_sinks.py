"""CSV seeds with declared types, source catalog, sinks and the full refresh."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from closebook.plans.refresh import ALL_MARTS, refresh
from closebook.sources import sinks
from closebook.sources.files import SourceCatalog, read_csv_seed
from fixture_feeds import feeds

CSV = (
    "product_id,sku,product_name,category,subcategory,brand,cost_price,list_price,is_active,_loaded_at\n"
    'P1,S1,"Lámpara ""Zen"", 40cm",home,lamps,Lumo,10.50,21.00,true,2024-01-01 00:00:00\n'
    "P2,S2,Stool 18\" high,home,chairs,Oak,,35.00,false,2024-01-02 10:30:00\n"
)


def test_csv_seed_types_quotes_and_blanks(spark, tmp_path):
    p = tmp_path / "raw_products.csv"
    p.write_text(CSV, encoding="utf-8")
    rows = {r["product_id"]: r for r in read_csv_seed(spark, "products", str(p)).collect()}
    assert rows["P1"]["product_name"] == 'Lámpara "Zen", 40cm'
    assert rows["P1"]["cost_price"] == D("10.50") and rows["P2"]["cost_price"] is None
    assert rows["P2"]["is_active"] is False
    assert rows["P2"]["_loaded_at"] == dt.datetime(2024, 1, 2, 10, 30)


def test_csv_seed_fails_fast_on_bad_value(spark, tmp_path):
    p = tmp_path / "raw_products.csv"
    p.write_text(CSV.replace("21.00", "twenty"), encoding="utf-8")
    with pytest.raises(Exception):
        read_csv_seed(spark, "products", str(p)).collect()


def test_source_catalog_locations(spark, tmp_path):
    cat = SourceCatalog({"raw_sales": str(tmp_path / "sales"), "raw_finance": "/x/fin"}, fmt="csv")
    assert cat.location("orders").endswith("sales/raw_orders.csv")
    assert cat.location("budgets") == "/x/fin/raw_budgets.csv"
    tables = SourceCatalog({"raw_sales": "raw.sales", "raw_finance": "raw.finance"}, fmt="table")
    assert tables.location("gl_entries") == "raw.finance.raw_gl_entries"
    (tmp_path / "sales").mkdir()
    (tmp_path / "sales" / "raw_products.csv").write_text(CSV, encoding="utf-8")
    assert cat.read(spark, "products").count() == 2


def test_refresh_writes_marts(spark, tmp_path):
    out = str(tmp_path / "marts")
    paths = refresh(spark, feeds(spark), out)
    assert set(paths) == set(ALL_MARTS)
    fact = spark.read.parquet(paths["completed_order_items"])
    assert fact.count() == 4
    assert sorted(r[0] for r in fact.select("order_month").distinct().collect()) == [
        dt.date(2024, 4, 1), dt.date(2025, 4, 1)]
    dim = spark.read.parquet(paths["customer_360"])
    assert dim.where(F.col("customer_id") == "C2").first()["lifetime_revenue"] == D("106.00")
    pnl = spark.read.parquet(paths["income_statement_monthly"])
    assert pnl.count() == 3
    # marts built from the stored upstream tables equal the lazy models
    from closebook.plans.models import Marts
    lazy = Marts(feeds(spark))
    for name in ("revenue_performance_monthly", "income_statement_monthly"):
        stored = spark.read.parquet(paths[name])
        model = lazy.model(name)
        assert stored.exceptAll(model).count() == 0 and model.exceptAll(stored).count() == 0


def test_versioned_sink_never_overwrites(spark, tmp_path):
    df = spark.range(3)
    p = sinks.write_versioned(df, str(tmp_path / "snap"), "1")
    assert spark.read.parquet(p).count() == 3
    with pytest.raises(Exception):
        sinks.write_versioned(df, str(tmp_path / "snap"), "1")


def test_snapshot_runs_write_new_versions(spark, tmp_path):
    from types import SimpleNamespace

    from closebook.plans.refresh import snapshot_customers
    base = str(tmp_path / "customers_snapshot")
    f = feeds(spark)
    v1 = snapshot_customers(spark, f, base, "1", dt.datetime(2024, 6, 1))
    moved = f.customers.withColumn(
        "city", F.when(F.col("customer_id") == "C2", F.lit("Beijing")).otherwise(F.col("city")))
    f2 = SimpleNamespace(**{**vars(f), "customers": moved.where(F.col("customer_id") != "C4")})
    v2 = snapshot_customers(spark, f2, base, "2", dt.datetime(2024, 7, 1), previous=v1)
    snap = spark.read.parquet(v2)
    assert spark.read.parquet(v1).count() == 4                 # earlier version untouched
    rows = sorted((r["customer_id"], r["city"], r["valid_to"]) for r in snap.collect())
    assert rows == [("C1", "madrid", None),
                    ("C2", "beijing", None), ("C2", "xian", dt.datetime(2024, 7, 1)),
                    ("C3", "lima", None),
                    ("C4", "arica", dt.datetime(2024, 7, 1))]


def test_queries_on_stored_feeds_equal_derived(spark, small_sf, tmp_path):
    from closebook.plans.catalog import QUERIES, on_marts
    from closebook.plans.models import Marts
    from closebook.sources.files import StoredFeeds, write_feeds
    from closebook.sources.tpch import RawFeeds
    base = write_feeds(RawFeeds(spark, small_sf), str(tmp_path / "feeds"), files=3)
    stored = Marts(StoredFeeds(spark, base))
    for name in ("completed_order_items", "income_statement_monthly", "customer_history",
                 "dq_summary"):
        a = on_marts(stored, name)
        b = QUERIES[name](spark, small_sf)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name
