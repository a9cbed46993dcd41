"""Sales layer: line economics, completed-items fact, customer 360, monthly KPIs.

Shuffle plan (see README, "Physical plan"):

* lines meet orders in the one big join, on order_id (with a salt, if there are
  hot orders): the line side is shuffled once, the order side is one row per
  order (plus copies for hot orders only, see ``operators/skew.py``). Products are joined by broadcast
  only when the planner's size estimate is under the broadcast threshold
  (AQE re-checks with the runtime size).
* order-level totals are a partial (map-side) ``groupBy(order_id)`` over the
  lines, attached to the one row per order before lines meet orders; no
  window gathers an order's lines in one task, and an order with very many
  lines is split over several join tasks (``operators/skew.py``).
* every order-grain mart (customer 360, order totals, per-order AOV, the
  sales side of the reconciliation) reads ``order_facts``: completed orders
  joined with the partial per-order sums of their lines, so no line-level
  rows are shuffled for them. The monthly mart reads the same by order and
  category (``order_categories``); only the line fact joins lines to orders.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from closebook.config import DEFAULT_CONFIG, MartConfig
from closebook.functions import calendar
from closebook.functions.columns import (
    RATIO_SUM, day_of_week, mean_money, mean_ratio, money, month_of, quarter_of, ratio4,
    surrogate_key, week_of_year, year_of,
)
from closebook.operators import bitmaps
from closebook.operators.skew import HotKeys, hot_keys, salted_join, sketch


def line_inputs(items: DataFrame, products: DataFrame) -> DataFrame:
    """Staged lines with the columns of their product.

    Products are a dimension; the planner broadcasts them when their size is
    under the broadcast threshold and shuffles otherwise.
    """
    oi, p = items.alias("oi"), products.alias("p")
    j = oi.join(p, F.col("oi.product_id") == F.col("p.product_id"), "left")
    return j.select(
        F.col("oi.order_item_id"), F.col("oi.order_id"), F.col("oi.product_id"),
        F.col("p.sku"), F.col("p.product_name"), F.col("p.category"),
        F.col("p.subcategory"), F.col("p.brand"),
        F.col("p.cost_price").alias("standard_cost"), F.col("p.list_price"),
        F.col("oi.quantity"), F.col("oi.unit_price"), F.col("oi.discount_pct"),
        F.col("oi.net_amount").alias("revenue"),
    )


def _economics() -> dict[str, Column]:
    """Cost, margin and discount of a line, from the columns of ``line_inputs``."""
    net, lst, cost = F.col("revenue"), F.col("list_price"), F.col("standard_cost")
    line_cost = F.col("quantity") * F.coalesce(cost, F.lit(0))
    return {
        "effective_discount_pct": ratio4(lst - F.col("unit_price"), lst),
        "cogs": money(line_cost),
        "has_missing_cost": cost.isNull(),
        "gross_profit": money(net - line_cost),
        "gross_margin_pct": ratio4(net - line_cost, net),
    }


def line_economics(lines: DataFrame) -> DataFrame:
    """Line-level economics that need only the product. What joins lines to orders
    adds them after the join: they follow from columns that are shuffled anyway."""
    return lines.withColumns(_economics())


def line_values(items: DataFrame, products: DataFrame) -> DataFrame:
    return line_economics(line_inputs(items, products))


_ORDER_COLS = ("customer_id", "order_date", "shipped_date", "delivered_date", "order_status",
               "sales_channel", "region")
_LINE_COLS = ("sku", "product_name", "category", "subcategory", "brand", "standard_cost",
              "list_price", "quantity", "unit_price", "discount_pct", "effective_discount_pct",
              "revenue", "cogs", "has_missing_cost", "gross_profit", "gross_margin_pct")


def _econ_columns(cfg: MartConfig) -> list:
    return [
        "order_item_id", "order_id", "product_id", "customer_id",
        "order_date", "shipped_date", "delivered_date",
        month_of("order_date").alias("order_month"),
        year_of("order_date").alias("order_year"),
        "order_status", "sales_channel", "region", *_LINE_COLS,
        F.col("order_status").isin(*cfg.completed_statuses).alias("is_revenue_recognized"),
    ]


def order_sketch(items: DataFrame) -> DataFrame:
    """Heavy-hitter sketch of the lines' order ids (one per load of lines)."""
    return sketch(items.select("order_id"), "order_id")


def hot_orders(sketches: DataFrame, cfg: MartConfig = DEFAULT_CONFIG) -> HotKeys:
    """Orders with so many lines that their join work is split (a bounded list,
    made by a small job over ``order_sketch`` tables)."""
    return hot_keys(sketches, cfg.rows_per_join_task)


def order_line_economics(lines: DataFrame, orders: DataFrame, hot: HotKeys,
                         cfg: MartConfig = DEFAULT_CONFIG) -> DataFrame:
    """One row per staged line; orphan lines and lines without a product are kept
    (order columns null, recognition flag null). ``lines`` is ``line_inputs``;
    hot orders are split over several join tasks (``salted_join``)."""
    o = orders.select("order_id", *_ORDER_COLS)
    j = salted_join(lines, o, "order_id", hot, "order_item_id", how="left")
    return line_economics(j).select(*_econ_columns(cfg))


def orphan_lines(items: DataFrame, orders: DataFrame, hot: HotKeys) -> DataFrame:
    """Staged lines whose order_id has no staged order (the relationships test)."""
    o = orders.select("order_id")
    return (salted_join(items, o, "order_id", hot, "order_item_id", how="left_anti")
            .select("order_item_id", "order_id", "product_id", "quantity",
                    F.col("net_amount").alias("revenue")))


def missing_cost_lines(econ: DataFrame) -> DataFrame:
    return econ.where(F.col("has_missing_cost")).select(
        "order_item_id", "order_id", "product_id", "sku", "order_status", "quantity",
        "revenue", "cogs", "gross_profit", "gross_margin_pct")


def completed_orders(orders: DataFrame, cfg: MartConfig = DEFAULT_CONFIG) -> DataFrame:
    return orders.where(F.col("order_status").isin(*cfg.completed_statuses))


def order_sums(lines: DataFrame) -> DataFrame:
    """Per order_id totals of its lines; partial aggregation runs map-side, so a
    very large order is combined before the shuffle."""
    return lines.groupBy("order_id").agg(*_order_sums())


def _order_sums() -> list[Column]:
    return [F.sum("revenue").alias("order_total_revenue"),
            F.sum("cogs").alias("order_total_cogs"),
            F.sum("gross_profit").alias("order_total_gross_profit"),
            F.count(F.lit(1)).alias("order_line_count"),
            F.sum("quantity").alias("order_units")]


def order_facts(lv: DataFrame, orders: DataFrame,
                cfg: MartConfig = DEFAULT_CONFIG) -> DataFrame:
    """One row per completed order that has lines: order attributes plus the
    totals of its lines.

    Every order-grain mart reads this instead of the line fact: only the
    partial per-order sums of the lines are shuffled, and both join sides have
    one row per order_id. A completed order's lines are all completed lines,
    so the totals equal those of the fact's lines. ``lv`` is ``line_values``.
    """
    return (completed_orders(orders, cfg).select("order_id", *_ORDER_COLS)
            .join(order_sums(lv), "order_id", "inner")
            .withColumn("order_month", month_of("order_date")))


def order_totals(facts: DataFrame) -> DataFrame:
    """One row per completed order: totals of its lines."""
    return facts.select("order_id", "customer_id", "order_date", "order_total_revenue",
                        "order_total_cogs", "order_total_gross_profit", "order_line_count",
                        "order_units")


ORDER_TOTALS = ("order_total_revenue", "order_total_cogs", "order_total_gross_profit",
           "order_line_count")


def completed_order_items(lines: DataFrame, facts: DataFrame, hot: HotKeys,
                          cfg: MartConfig = DEFAULT_CONFIG) -> DataFrame:
    """The completed-items fact: recognised lines, key, calendar parts, order totals.

    Same rows as filtering the line economics on the recognition flag: each
    line meets its completed order (with the order's line totals attached)
    in one join, for which whole lines are shuffled once; no window gathers a
    group of lines. Without hot orders the order side keeps the partitioning of
    its dedupe; an order with very many lines is split over several join tasks
    (``operators/skew.py``). ``lines`` is ``line_inputs``.
    ``order_status`` is kept (the checks on this fact read it).
    """
    o = facts.select("order_id", *_ORDER_COLS, *ORDER_TOTALS)
    return fact_columns(salted_join(lines, o, "order_id", hot, "order_item_id"), FACT_COLUMNS)


def completed_lines(lines: DataFrame, orders: DataFrame, hot: HotKeys,
                    cfg: MartConfig = DEFAULT_CONFIG) -> DataFrame:
    """The rows of the fact without their order's totals, for ``fact_columns``: the
    lines are read once. An order without lines has no row in either."""
    o = completed_orders(orders, cfg).select("order_id", *_ORDER_COLS)
    return salted_join(lines, o, "order_id", hot, "order_item_id")


#: The columns of the fact, in order; the last are the totals of the line's order.
FACT_COLUMNS = (
    "order_item_sk", "order_item_id", "order_id", "product_id", "customer_id",
    "order_date", "shipped_date", "delivered_date", "order_month", "order_year", "day_of_week",
    "fiscal_quarter", "iso_week", "order_status", "sales_channel", "region", "category",
    "subcategory", "brand", "sku", "quantity", "list_price", "unit_price", "discount_pct",
    "effective_discount_pct", "revenue", "cogs", "gross_profit", "gross_margin_pct",
    "has_missing_cost", *ORDER_TOTALS)

#: Those that follow from others of the fact: they are made when rows are written, after
#: all shuffles. ``order_month`` is not among them, as rows are ordered by it.
LATE_COLUMNS = ("order_item_sk", "order_year", "day_of_week", "fiscal_quarter", "iso_week",
                "effective_discount_pct")

#: What the columns that are made of others are made of.
_MADE_OF = {
    "order_item_sk": ("order_item_id",),
    **dict.fromkeys(("order_month", "order_year", "day_of_week", "fiscal_quarter", "iso_week"),
                    ("order_date",)),
    "effective_discount_pct": ("list_price", "unit_price"),
    "cogs": ("quantity", "standard_cost"),
    "has_missing_cost": ("standard_cost",),
    **dict.fromkeys(("gross_profit", "gross_margin_pct"), ("quantity", "standard_cost", "revenue")),
}


#: What a line has of its product, and what follows from the product's price.
PRICED = frozenset(("sku", "product_name", "category", "subcategory", "brand", "standard_cost",
                    "list_price", "unit_price", "revenue"))


def fact_columns(rows: DataFrame, columns: Sequence[str],
                 kept: Sequence[str] = ()) -> DataFrame:
    """Columns of the fact from lines with their orders (``made_of`` of them); those in
    ``kept`` are there already."""
    d = F.col("order_date")
    made = {"order_item_sk": surrogate_key("order_item_id"),
            "order_month": month_of(d), "order_year": year_of(d), "day_of_week": day_of_week(d),
            "fiscal_quarter": F.quarter(d), "iso_week": week_of_year(d), **_economics()}
    return rows.select(*[made[c].alias(c) if c in made and c not in kept else c
                         for c in columns])


def early_columns(fact: DataFrame) -> DataFrame:
    """Rows of the fact without the columns that ``with_late_columns`` makes."""
    return fact.select(*[c for c in FACT_COLUMNS if c not in LATE_COLUMNS])


def with_late_columns(rows: DataFrame) -> DataFrame:
    """The whole rows of the fact from ``early_columns``, whose order they keep."""
    late = fact_columns(rows, (*LATE_COLUMNS, *rows.columns), kept=rows.columns)
    return late.select(*FACT_COLUMNS)


def made_of(columns: Iterable[str]) -> list[str]:
    """What ``fact_columns`` reads for some columns of the fact."""
    return sorted({b for c in columns for b in _MADE_OF.get(c, (c,))})


def refund_items(lines: DataFrame, orders: DataFrame, booked: DataFrame, hot: HotKeys,
                 cfg: MartConfig = DEFAULT_CONFIG) -> DataFrame:
    """The refund fact: every line of a refunded order, with negative quantity and
    amounts, so that it adds up with the completed-items fact to net revenue.
    ``is_booked``: the ledger has a refund entry for the order (``booked``); customer
    service issues some refunds that never reach it. Orders meet the ledger's
    orders first, one row each; lines meet them once, as in the fact."""
    o = (orders.where(F.col("order_status") == cfg.refunded_status)
         .select("order_id", "customer_id", "order_date", "sales_channel", "region")
         .join(booked, "order_id", "left"))
    f = line_economics(salted_join(lines, o, "order_id", hot, "order_item_id"))
    return f.select(
        "order_item_id", "order_id", "product_id", "customer_id", "order_date",
        month_of("order_date").alias("order_month"), "sales_channel", "region", "category",
        (-F.col("quantity")).alias("quantity"), (-F.col("revenue")).alias("revenue"),
        (-F.col("cogs")).alias("cogs"), (-F.col("gross_profit")).alias("gross_profit"),
        F.coalesce("_booked", F.lit(False)).alias("is_booked"))


def _customer_totals(facts: DataFrame) -> DataFrame:
    """Per customer from the order facts (one shuffle on customer_id).

    Equal to the line-grain definition: distinct orders = order rows, and the
    line-weighted mean of the order total is sum(total * lines) / sum(lines)
    over lines whose order total is not null.
    """
    total = F.col("order_total_revenue")
    weighted_n = F.when(total.isNotNull(), F.col("order_line_count"))
    return facts.groupBy("customer_id").agg(
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        F.count(F.lit(1)).alias("total_completed_orders"),
        F.sum("order_units").alias("total_units_purchased"),
        money(F.sum(total)).alias("lifetime_revenue"),
        money(F.sum("order_total_gross_profit")).alias("lifetime_gross_profit"),
        mean_money(F.sum(total * F.col("order_line_count")), F.sum(weighted_n)).alias("avg_order_value"),
        ratio4(F.count(F.lit(1)) - F.lit(1.0), F.count(F.lit(1))).alias("repurchase_rate"),
    )


def customer_tier(revenue, cfg: MartConfig = DEFAULT_CONFIG):
    expr = None
    for threshold, name in cfg.tiers:
        cond = revenue >= F.lit(threshold)
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr.when(revenue > 0, cfg.bronze_tier).otherwise(cfg.prospect_tier)


#: The columns of the customer mart that need no order.
PARTY_COLUMNS = ("customer_id", "first_name", "last_name", "full_name", "email",
                 "customer_segment", "country", "city", "registration_date")


def customer_360(customers: DataFrame, facts: DataFrame,
                 cfg: MartConfig = DEFAULT_CONFIG) -> DataFrame:
    """One row per staged customer, prospects included (metrics null).
    ``facts`` is the order-grain ``order_facts``."""
    m = _customer_totals(facts)
    c = customers.alias("c")
    j = c.join(m.alias("m"), F.col("c.customer_id") == F.col("m.customer_id"), "left")
    as_of = F.lit(cfg.as_of)
    last = F.col("m.last_order_date")
    return j.select(
        *[F.col(f"c.{n}") for n in PARTY_COLUMNS],
        *[F.col(f"m.{n}") for n in ("first_order_date", "last_order_date",
                                    "total_completed_orders", "total_units_purchased",
                                    "lifetime_revenue", "lifetime_gross_profit",
                                    "avg_order_value", "repurchase_rate")],
        F.datediff(as_of, last).alias("days_since_last_order"),
        customer_tier(F.col("m.lifetime_revenue"), cfg).alias("customer_tier"),
        ((last >= F.add_months(as_of, -cfg.churn_lookback_months))
         & (last < F.date_sub(as_of, cfg.churn_quiet_days))).alias("is_churn_risk"),
    )


def customer_tier_counts(dim: DataFrame) -> DataFrame:
    return dim.groupBy("customer_tier").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("lifetime_revenue").alias("lifetime_revenue"),
        F.coalesce(F.sum("total_completed_orders"), F.lit(0)).alias("completed_orders"),
    )


def new_customers_monthly(dim: DataFrame) -> DataFrame:
    return (dim.where(F.col("first_order_date").isNotNull())
               .groupBy(month_of("first_order_date").alias("cohort_month"))
               .agg(F.countDistinct("customer_id").alias("new_customers")))


_GRAIN = ["order_month", "sales_channel", "region", "category"]


def _line_sums() -> list:
    return [F.count(F.lit(1)).alias("lines"), F.sum("quantity").alias("units"),
            F.sum("revenue").alias("revenue"), F.sum("cogs").alias("cogs"),
            F.sum("gross_profit").alias("gross_profit"),
            F.sum(F.col("gross_margin_pct").cast(RATIO_SUM)).alias("gm_sum"),
            F.count("gross_margin_pct").alias("gm_n"),
            F.sum(F.col("effective_discount_pct").cast(RATIO_SUM)).alias("disc_sum"),
            F.count("effective_discount_pct").alias("disc_n")]


_ORDER_KEYS = ["order_id", "customer_id", "order_date", "order_month", "sales_channel", "region"]
#: What the customer mart and the monthly mart read of the fact, but for totals of orders.
CUSTOMER_READS = (*_ORDER_KEYS, "quantity", "revenue", "cogs", "gross_profit")
MONTHLY_READS = (*CUSTOMER_READS, "category", "gross_margin_pct", "effective_discount_pct")


def order_categories(lv: DataFrame, orders: DataFrame, cfg: MartConfig = DEFAULT_CONFIG,
                     hot: HotKeys | None = None) -> DataFrame:
    """One row per completed order and category: sums of its lines, and the
    order's total. Lines are read once; the total is a window over an order's
    categories, not over its lines. Where no order is hot (an empty list), one
    shuffle on order_id serves the sums, the total and the join; else lines are
    combined before theirs."""
    if hot is not None and not hot:
        lv = lv.where(F.col("order_id").isNotNull()).repartition("order_id")
    sums = lv.groupBy("order_id", "category").agg(*_line_sums())
    total = F.sum("revenue").over(Window.partitionBy("order_id"))
    return (completed_orders(orders, cfg).withColumn("order_month", month_of("order_date"))
            .select(*_ORDER_KEYS)
            .join(sums.withColumn("order_total_revenue", total), "order_id"))


def order_categories_of(fact: DataFrame) -> DataFrame:
    """``order_categories`` from the (stored) line fact. Where that has no totals of
    orders, they are a window over an order's categories."""
    if "order_total_revenue" not in fact.columns:
        sums = fact.groupBy(*_ORDER_KEYS, "category").agg(*_line_sums())
        return sums.withColumn("order_total_revenue",
                               F.sum("revenue").over(Window.partitionBy("order_id")))
    return fact.groupBy(*_ORDER_KEYS, "category", "order_total_revenue").agg(*_line_sums())


def order_facts_of(fact: DataFrame) -> DataFrame:
    """``order_facts``, as the customer mart reads them, from the (stored) line fact."""
    if not set(ORDER_TOTALS) <= set(fact.columns):
        return fact.groupBy(*_ORDER_KEYS).agg(*_order_sums())
    return fact.groupBy(*_ORDER_KEYS, *ORDER_TOTALS).agg(F.sum("quantity").alias("order_units"))


def first_order_months(order_cats: DataFrame, customers: DataFrame) -> DataFrame:
    """New customers by month of their first completed order."""
    first = order_cats.groupBy("customer_id").agg(F.min("order_date").alias("first_order_date"))
    return (first.join(customers.select("customer_id"), "customer_id", "left_semi")
            .groupBy(month_of("first_order_date").alias("cohort_month"))
            .agg(F.count(F.lit(1)).alias("new_customers")))


def monthly_revenue(order_cats: DataFrame) -> DataFrame:
    return order_cats.groupBy(*_GRAIN).agg(money(F.sum("revenue")).alias("net_revenue"))


def _kpis(order_cats: DataFrame) -> DataFrame:
    # Rows are orders within a group already: plain counts and one distinct.
    line_totals = F.col("order_total_revenue") * F.col("lines")
    return order_cats.groupBy(*_GRAIN).agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.countDistinct("customer_id").alias("total_customers"),
        F.sum("units").alias("units_sold"),
        money(F.sum("revenue")).alias("net_revenue"),
        money(F.sum("cogs")).alias("total_cogs"),
        money(F.sum("gross_profit")).alias("gross_profit"),
        mean_ratio(F.sum("gm_sum"), F.sum("gm_n")).alias("avg_gross_margin_pct"),
        mean_money(F.sum(line_totals), F.count(F.lit(1))).alias("avg_order_value"),
        mean_ratio(F.sum("disc_sum"), F.sum("disc_n")).alias("avg_effective_discount_pct"),
    )


def revenue_performance_monthly(order_cats: DataFrame, new_customers: DataFrame) -> DataFrame:
    """Month x channel x region x category KPIs with MoM, YoY (12 rows back) and
    YTD, from ``order_categories`` and the new customers by ``cohort_month``."""
    base = _kpis(order_cats)
    m = base.join(new_customers, base.order_month == new_customers.cohort_month, "left").drop(
        "cohort_month")
    new = F.coalesce(F.col("new_customers"), F.lit(0))
    series = Window.partitionBy("sales_channel", "region", "category").orderBy("order_month")
    ytd = (Window.partitionBy(F.year("order_month"), "sales_channel", "region", "category")
           .orderBy("order_month").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rev = F.col("net_revenue")
    prev, prior = F.lag(rev, 1).over(series), F.lag(rev, 12).over(series)
    w = m.select("*", new.alias("_new"), prev.alias("_prev"), prior.alias("_prior"))
    return w.select(
        *_GRAIN, "total_orders", "total_customers",
        F.col("_new").alias("new_customers"),
        (F.col("total_customers") - F.col("_new")).alias("returning_customers"),
        "units_sold", "net_revenue", "total_cogs", "gross_profit", "avg_gross_margin_pct",
        "avg_order_value", "avg_effective_discount_pct",
        ratio4(rev - F.col("_prev"), F.col("_prev")).alias("mom_revenue_growth_pct"),
        ratio4(rev - F.col("_prior"), F.col("_prior")).alias("yoy_revenue_growth_pct"),
        F.sum(rev).over(ytd).alias("ytd_revenue"),
    )


def revenue_performance_filled(order_cats: DataFrame) -> DataFrame:
    """The monthly series without holes: every channel x region x category that
    has sold has a row for each month from its first to the last month of all
    data, with zero revenue where nothing was sold. On it one row back is one
    month back, and twelve rows a year.
    """
    keys = ["sales_channel", "region", "category"]
    base = _kpis(order_cats).select(*_GRAIN, "total_orders", "total_customers", "units_sold",
                                    "net_revenue", "total_cogs", "gross_profit")
    # One row a series; the window over all of them finds the last month.
    present = base.groupBy(*keys).agg(F.min("order_month").alias("start_date"),
                                      F.max("order_month").alias("_last"))
    whole = Window.partitionBy(F.lit(0))
    bounds = present.withColumn("end_date", F.add_months(F.max("_last").over(whole), 1))
    spine = calendar.date_spine(bounds, datepart="month", keep=keys).select(
        F.col("date").alias("order_month"), *keys)
    s, b = spine.alias("s"), base.alias("b")
    on = F.col("s.order_month") == F.col("b.order_month")
    for k in keys:  # a null category is a series like any other
        on = on & F.col(f"s.{k}").eqNullSafe(F.col(f"b.{k}"))
    counts = ("total_orders", "total_customers", "units_sold")
    sums = ("net_revenue", "total_cogs", "gross_profit")
    j = s.join(b, on, "left").select(
        *[F.col(f"s.{c}") for c in _GRAIN], F.col("b.total_orders").isNull().alias("is_filled"),
        *[F.coalesce(F.col(f"b.{c}"), F.lit(0)).alias(c) for c in counts],
        *[money(F.coalesce(F.col(f"b.{c}"), F.lit(0))).alias(c) for c in sums])
    series = Window.partitionBy(*keys).orderBy("order_month")
    ytd = (Window.partitionBy(F.year("order_month"), *keys)
           .orderBy("order_month").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rev = F.col("net_revenue")
    w = j.select("*", F.lag(rev, 1).over(series).alias("_prev"),
                 F.lag(rev, 12).over(series).alias("_prior"))
    return w.select(
        *_GRAIN, "is_filled", *counts, *sums,
        ratio4(rev - F.col("_prev"), F.col("_prev")).alias("mom_revenue_growth_pct"),
        ratio4(rev - F.col("_prior"), F.col("_prior")).alias("yoy_revenue_growth_pct"),
        F.sum(rev).over(ytd).alias("ytd_revenue"))


def customer_bitmaps(order_cats: DataFrame, numbers: DataFrame) -> DataFrame:
    """The customers of each month x channel x region x category as bitmaps over
    their stored numbers (``operators/bitmaps.py``)."""
    buyers = order_cats.select(*_GRAIN, "customer_id").distinct()
    return bitmaps.key_bitmaps(buyers.join(numbers, "customer_id"), _GRAIN)


#: Level -> the columns it counts customers by; ``period`` is their first month.
_REACH = {"cell": ("order_month", "sales_channel", "region", "category"),
          "channel_month": ("order_month", "sales_channel"),
          "month": ("order_month",), "quarter": ("quarter",), "channel": ("sales_channel",),
          "all": ()}


def customer_reach(cells: DataFrame) -> DataFrame:
    """Distinct customers by cell, month, quarter and channel, all from one stored
    table of bitmaps: none of these counts is a sum of finer ones."""
    cells = cells.withColumn("quarter", quarter_of("order_month"))
    parts = []
    for level, columns in _REACH.items():
        counted = bitmaps.distinct_counts(cells, columns, "customers")
        period = next((F.col(c) for c in ("order_month", "quarter") if c in columns),
                      F.lit(None).cast("date"))
        parts.append(counted.select(
            F.lit(level).alias("level"), period.alias("period"),
            *[(F.col(c) if c in columns else F.lit(None).cast("string")).alias(c)
              for c in ("sales_channel", "region", "category")], "customers"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def yoy_calendar(monthly: DataFrame) -> DataFrame:
    """Calendar-exact YoY of ``monthly_revenue``: the same series one calendar year earlier, by self-join
    on (series, month - 12 months) instead of 12 rows back."""
    keys = ["sales_channel", "region", "category"]
    cur = monthly.select(*_GRAIN, "net_revenue").alias("c")
    prior = monthly.select(*keys, F.add_months("order_month", 12).alias("order_month"),
                           F.col("net_revenue").alias("prior_year_revenue")).alias("p")
    # Null-safe keys: a null category is one series, as in the 12-row lag.
    cond = None
    for k in keys + ["order_month"]:
        eq = F.col(f"c.{k}").eqNullSafe(F.col(f"p.{k}"))
        cond = eq if cond is None else cond & eq
    j = cur.join(prior, cond, "left").select("c.*", "p.prior_year_revenue")
    return j.select(*_GRAIN, "net_revenue", "prior_year_revenue",
                    ratio4(F.col("net_revenue") - F.col("prior_year_revenue"),
                           F.col("prior_year_revenue")).alias("yoy_calendar_growth_pct"))


def avg_order_value_per_order(facts: DataFrame) -> DataFrame:
    """AOV counting each order once, per month x channel x region."""
    rev = F.col("order_total_revenue")
    return facts.groupBy("order_month", "sales_channel", "region").agg(
        F.count(F.lit(1)).alias("orders"),
        money(F.sum(rev)).alias("net_revenue"),
        mean_money(F.sum(rev), F.count(F.lit(1))).alias("avg_order_value"))


def customer_aov_per_order(facts: DataFrame) -> DataFrame:
    rev = F.col("order_total_revenue")
    return facts.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_completed_orders"),
        mean_money(F.sum(rev), F.count(F.lit(1))).alias("avg_order_value_per_order"))
