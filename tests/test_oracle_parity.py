"""Every registered query equals its DuckDB oracle on the smallest driver tables."""

import pytest

import __spark_entry__ as entry_mod
from closebook.plans.catalog import QUERIES
from closebook.plans.oracle import ORACLE_SQL as ORACLE
from compare import compare, duck


@pytest.fixture(scope="module")
def con(small_sf):
    return duck(small_sf)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_mod.queries()) and set(ORACLE) <= set(entry_mod.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, small_sf, name):
    ok, msg = compare(QUERIES[name](spark, small_sf), con, ORACLE[name])
    assert ok, f"{name}: {msg}"


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert "net_revenue" in df.columns


@pytest.mark.parametrize("name", ["stg_orders", "stg_gl_entries", "customer_history",
                                  "source_freshness", "completed_order_items", "date_spine"])
def test_results_do_not_depend_on_session_time_zone(spark, con, small_sf, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        ok, msg = compare(QUERIES[name](spark, small_sf), con, ORACLE[name])
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert ok, f"{name}: {msg}"
