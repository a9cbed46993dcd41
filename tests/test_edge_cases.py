"""Edge rows: zero list price, future order date, month gap in a series."""

from pyspark.sql import functions as F
import datetime as dt
from decimal import Decimal as D

from closebook.operators.quality import Check, run_checks
from closebook.plans import sales, staging
from closebook.sources.schemas import RAW_SCHEMAS

d = dt.date


def test_zero_list_price_gives_null_ratios(spark):
    raw = spark.createDataFrame(
        [("P0", "S", "Free", "x", "y", "z", D("0.00"), D("0.00"), True, None)],
        RAW_SCHEMAS["products"])
    p = staging.stg_products(raw)
    assert p.first()["base_margin_pct"] is None
    items = spark.createDataFrame([("I", "O", "P0", 1, D("0.00"), None, None)],
                                  RAW_SCHEMAS["order_items"])
    lv = sales.line_values(staging.stg_order_items(items), p).first()
    assert lv["effective_discount_pct"] is None and lv["gross_margin_pct"] is None


def test_future_order_date_fails_days_since_check(spark):
    dim = spark.createDataFrame([("C1", -3), ("C2", 10), ("C3", None)],
                                "customer_id string, days_since_last_order int")
    chk = Check("expression", "dim", "days_since_last_order",
                expression="days_since_last_order >= 0 or days_since_last_order is null")
    assert run_checks([chk], lambda _: dim).first()["failures"] == 1


def _series_fact(spark):
    months = [d(2023, m, 1) for m in (1, 2, 3, 4, 5, 7, 8, 9, 10, 11, 12)] + [d(2024, 1, 1), d(2024, 2, 1)]
    rows = []
    for i, m in enumerate(months):
        rev = D(100 + i)
        rows.append((m, "online", "east", "tools", f"O{i}", "C1", 1, rev, D("1.00"), rev - 1,
                     0.5, rev, 0.1))
    return spark.createDataFrame(
        rows, "order_month date, sales_channel string, region string, category string, "
              "order_id string, customer_id string, quantity int, revenue decimal(18,2), "
              "cogs decimal(18,2), gross_profit decimal(18,2), gross_margin_pct double, "
              "order_total_revenue decimal(18,2), effective_discount_pct double")


def test_lag_12_is_rows_back_calendar_yoy_is_a_year_back(spark):
    fact = _series_fact(spark)
    dim = spark.createDataFrame([("C1", d(2023, 1, 5))], "customer_id string, first_order_date date")
    cats = sales.order_categories_of(fact.withColumn("order_date", F.col("order_month")))
    monthly = sales.revenue_performance_monthly(cats, sales.new_customers_monthly(dim))
    feb = monthly.where("order_month = DATE'2024-02-01'").first()
    # 12 rows back from 2024-02 is 2023-01 (revenue 100) because 2023-06 is missing.
    assert feb["yoy_revenue_growth_pct"] == round((112 - 100) / 100, 4)
    cal = sales.yoy_calendar(sales.monthly_revenue(cats)).where("order_month = DATE'2024-02-01'").first()
    assert cal["prior_year_revenue"] == D("101.00")            # 2023-02
    assert cal["yoy_calendar_growth_pct"] == round((112 - 101) / 101, 4)
    jan = monthly.where("order_month = DATE'2024-01-01'").first()
    assert jan["ytd_revenue"] == D("111.00")                   # YTD restarts each year
    assert jan["new_customers"] == 0 and jan["returning_customers"] == 1
