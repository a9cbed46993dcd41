"""Registered queries.

``MODEL_QUERIES`` maps each query name to a function of the model graph
(``Marts``), so a query runs on any raw feeds: feeds derived from the driver
tables, staged parquet feeds (``StoredFeeds``) or CSV seeds. ``QUERIES``
binds them to the driver contract ``(spark, sf_dir) -> DataFrame``, deriving
the raw feeds from the whole driver tables in ``sf_dir``. At the output edge
DECIMAL columns become DOUBLE, so the result compares value-for-value with
the SQL oracle (``oracle.py``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from types import SimpleNamespace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from closebook.config import DEFAULT_CONFIG
from closebook.functions import calendar, columns as C
from closebook.operators import quality, snapshot
from closebook.plans import checks, finance, incremental, refresh, sales, staging
from closebook.plans.models import Marts
from closebook.session import scratch_folder
from closebook.sources.tpch import RawFeeds

Query = Callable[[SparkSession, str], DataFrame]
ModelQuery = Callable[[Marts], DataFrame]


def edge(df: DataFrame) -> DataFrame:
    """Cast DECIMAL columns to DOUBLE (the comparison type of the oracle)."""
    return df.select(*[
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
        else F.col(f.name) for f in df.schema.fields])


# Integer metrics that are NULL for prospects leave the query as DOUBLE:
# pandas turns a nullable integer column into float64 on one engine and into a
# nullable Int64 on another, while a DOUBLE column converts the same way.
NULLABLE_COUNTS = {"customer_360": ("total_completed_orders", "total_units_purchased",
                                    "days_since_last_order")}


def marts(spark: SparkSession, sf_dir: str) -> Marts:
    return Marts(RawFeeds(spark, sf_dir), DEFAULT_CONFIG)


def _model(name: str) -> ModelQuery:
    return lambda m: m.model(name)


# ----------------------------------------------------------------- history
def customer_history(m: Marts) -> DataFrame:
    """SCD2 history of segment, country and city over the dated extracts, however
    many there are: one read of the extracts and one shuffle."""
    ext = getattr(m.raw, "customer_extracts", None)
    if ext is None:  # a feed without dated extracts: its customers are the one load
        ext = m.raw.customers.withColumns({"load_no": F.lit(1), "load_ts": C.ntz(m.cfg.as_of)})
    loads = getattr(m.raw, "customer_loads", None)
    if loads is None:
        loads = ext.select("load_no", "load_ts").distinct()
    return snapshot.history_of(staging.stg_customers(ext, "load_no"), loads, m.cfg.snapshot_key,
                               m.cfg.snapshot_check_cols)


def segment_at_purchase(m: Marts) -> DataFrame:
    """Completed revenue by month and by the customer's segment at order time
    (as-of merge of orders with the SCD2 history; order grain, so no line rows
    are shuffled). Customers with very many orders are divided by time."""
    orders = m.order_facts.select("order_id", "customer_id", "order_date", "order_month",
                                  "order_line_count", "order_total_revenue")
    when = F.col("order_date")
    cuts = snapshot.time_cuts(orders, "customer_id", when, "order_id", m.hot_customers)
    j = snapshot.as_of_merge(orders, customer_history(m), "customer_id", when,
                             ["customer_segment"], cuts, "order_id")
    return j.groupBy("order_month", "customer_segment").agg(
        F.sum("order_line_count").alias("lines"), F.sum("order_total_revenue").alias("revenue"))


# ------------------------------------------------------------- incremental
#: An earlier day: what was loaded before it is the first run's feed.
FIRST_RUN = dt.date(2024, 1, 1)


def incremental_fact(m: Marts) -> DataFrame:
    """The line fact made in two runs: a full one on the orders and lines loaded
    before ``FIRST_RUN``, and an incremental one on the whole feed."""
    spark = m.stg_orders.sparkSession
    early = F.col("_loaded_at") < C.ntz(FIRST_RUN)
    before = SimpleNamespace(
        orders=m.raw.orders.where(early), order_items=m.raw.order_items.where(early),
        customers=m.raw.customers, products=m.raw.products, gl_entries=m.raw.gl_entries,
        chart_of_accounts=m.raw.chart_of_accounts, budgets=m.raw.budgets,
        # The hot orders of the whole feed will do for a part of it.
        order_line_sketch=getattr(m.raw, "order_line_sketch", None),
        order_line_ids=getattr(m.raw, "order_line_ids", None))
    out = scratch_folder(spark, "incremental-fact")
    incremental.refresh_fact(spark, before, out, m.cfg)
    path = incremental.refresh_fact(spark, m.raw, out, m.cfg)
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in m.completed_order_items.schema]
    return spark.read.parquet(path).select(*columns)


# ----------------------------------------------------------------- checks
def _dq(kind: str | None) -> ModelQuery:
    """The checks run as after a build: a mart that several models read is written
    once (to a scratch folder here), with the columns that are read."""
    def q(m: Marts) -> DataFrame:
        chosen = checks.all_checks(m.cfg) if kind is None else checks.checks_of_kind(kind, m.cfg)
        named = {c.model for c in chosen} | {c.to_model for c in chosen}
        res = quality.run_checks(chosen, refresh.stored_models(m, named, quality.words(chosen)))
        return quality.summarize(res) if kind is None else res
    return q


def source_freshness(m: Marts) -> DataFrame:
    return checks.freshness(m.raw, C.ntz(m.cfg.as_of), m.cfg)


# -------------------------------------------------------------- functions
def date_spine(m: Marts) -> DataFrame:
    o = m.raw.orders.where(F.col("order_id").isNotNull())
    bounds = o.agg(F.min("order_date").alias("start_date"),
                   F.date_add(F.max("order_date"), 1).alias("end_date"))
    return calendar.date_spine(bounds, datepart="day")


def calendar_attributes(m: Marts) -> DataFrame:
    per_day = m.stg_orders.groupBy("order_date").agg(F.count(F.lit(1)).alias("orders"))
    return per_day.select("order_date", "orders", *calendar.calendar_columns("order_date"))


def cents_to_dollars(m: Marts) -> DataFrame:
    cents = (F.col("net_amount") * F.lit(100)).cast("bigint")
    items = m.stg_order_items.select("order_item_id", cents.alias("net_amount_cents"))
    return items.select("order_item_id", "net_amount_cents",
                        C.cents_to_dollars("net_amount_cents").alias("net_amount_dollars"),
                        C.cents_to_dollars("net_amount_cents", 0).alias("net_amount_whole_dollars"))


def title_case(m: Marts) -> DataFrame:
    return m.stg_products.select("product_id", "product_name",
                                 C.title_case("product_name").alias("product_title"))


def surrogate_key(m: Marts) -> DataFrame:
    return m.stg_order_items.select(
        "order_item_id",
        C.surrogate_key("order_item_id").alias("order_item_sk"),
        C.surrogate_key("order_id", "product_id").alias("order_product_sk"))


MODEL_QUERIES: dict[str, ModelQuery] = {
    "stg_orders": _model("stg_orders"),
    "stg_order_items": _model("stg_order_items"),
    "stg_customers": _model("stg_customers"),
    "stg_products": _model("stg_products"),
    "stg_gl_entries": _model("stg_gl_entries"),
    "stg_budgets": _model("stg_budgets"),
    "order_line_economics": _model("order_line_economics"),
    "orphan_lines": lambda m: sales.orphan_lines(m.stg_order_items, m.stg_orders, m.hot_orders),
    "missing_cost_lines": lambda m: sales.missing_cost_lines(m.order_line_economics),
    "gl_classified": _model("gl_classified"),
    "completed_order_items": _model("completed_order_items"),
    "completed_order_items_incremental": incremental_fact,
    "order_totals": lambda m: sales.order_totals(m.order_facts),
    "customer_360": _model("customer_360"),
    "customer_tier_counts": lambda m: sales.customer_tier_counts(m.customer_360),
    "revenue_performance_monthly": _model("revenue_performance_monthly"),
    "new_customers_monthly": lambda m: sales.new_customers_monthly(m.customer_360),
    "gl_activity_monthly": _model("gl_activity_monthly"),
    "gl_ytd": lambda m: finance.gl_ytd(m.gl_activity_monthly),
    "gl_yoy": lambda m: finance.gl_yoy(m.gl_activity_monthly),
    "gl_anomalies": lambda m: finance.gl_anomalies(m.gl_activity_monthly, m.cfg),
    "ledger_completeness": lambda m: finance.ledger_completeness(m.stg_gl_entries, m.cfg),
    "refund_items": _model("refund_items"),
    "net_revenue_monthly": lambda m: finance.net_revenue_monthly(m.order_facts, m.refund_items),
    "income_statement_monthly": lambda m: m.income_statement_monthly.orderBy("entry_month"),
    "budget_variance":
        lambda m: finance.budget_variance(m.income_statement_monthly).orderBy("entry_month"),
    "revenue_reconciliation": lambda m: m.revenue_reconciliation.orderBy(F.desc("month")),
    "unrecognised_revenue_check": lambda m: finance.unrecognised_revenue_check(
        m.completed_order_items, m.stg_orders, m.cfg, m.hot_orders),
    "date_spine": date_spine,
    "calendar_attributes": calendar_attributes,
    "cents_to_dollars": cents_to_dollars,
    "title_case": title_case,
    "surrogate_key": surrogate_key,
    "dq_not_null": _dq("not_null"),
    "dq_unique": _dq("unique"),
    "dq_accepted_values": _dq("accepted_values"),
    "dq_relationships": _dq("relationships"),
    "dq_expression": _dq("expression"),
    "dq_unique_combination": _dq("unique_combination"),
    "dq_summary": _dq(None),
    "source_freshness": source_freshness,
    "customer_history": customer_history,
    "segment_at_purchase": segment_at_purchase,
    "avg_order_value_per_order": lambda m: sales.avg_order_value_per_order(m.order_facts),
    "customer_aov_per_order": lambda m: sales.customer_aov_per_order(m.order_facts),
    "revenue_performance_filled":
        lambda m: sales.revenue_performance_filled(m.stored_order_categories),
    "customer_reach": lambda m: sales.customer_reach(m.customer_bitmaps),
    "yoy_calendar": lambda m: sales.yoy_calendar(
        sales.monthly_revenue(m.stored_order_categories)),
}


def on_marts(m: Marts, name: str) -> DataFrame:
    """Run a registered query on an existing model graph (for example one
    built on stored raw feeds), with the output-edge casts."""
    df = edge(MODEL_QUERIES[name](m))
    for c in NULLABLE_COUNTS.get(name, ()):
        df = df.withColumn(c, F.col(c).cast("double"))
    return df


def _query(name: str) -> Query:
    return lambda spark, sf_dir: on_marts(marts(spark, sf_dir), name)


QUERIES: dict[str, Query] = {name: _query(name) for name in MODEL_QUERIES}
