"""Finance layer: classified ledger, monthly account activity, P&L, reconciliation.

The ledger side is small next to the order lines: the monthly roll-up is a
partial (map-side) aggregate, and the chart of accounts and budgets are tiny
dimension tables that the planner broadcasts by size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from closebook.config import DEFAULT_CONFIG, MartConfig
from closebook.functions.columns import money, ratio4
from closebook.operators.skew import HotKeys, salted_join


def gl_classified(gl: DataFrame, accounts: DataFrame,
                  cfg: MartConfig = DEFAULT_CONFIG) -> DataFrame:
    """Ledger entries with their account; entries of unknown accounts drop out
    (inner join), which the relationships check reports."""
    g, a = gl.alias("g"), accounts.alias("a")
    j = g.join(a, F.col("g.account_code") == F.col("a.account_code"), "inner")
    return j.select(
        *[F.col(f"g.{c}") for c in ("entry_id", "entry_date", "entry_month", "entry_type",
                                    "amount", "signed_amount", "description", "reference_id",
                                    "currency", "account_code")],
        *[F.col(f"a.{c}") for c in ("account_name", "account_type", "account_subtype",
                                    "is_income_statement", "normal_balance")],
        ((F.col("a.account_subtype") == cfg.revenue_subtype)
         & F.col("g.reference_id").isNotNull()).alias("is_order_revenue"),
    )


# Reconciliation investigation hints.
HINT_NO_GL = "GL has no revenue entries for this month — sync issue?"
HINT_HIGH = "Variance >5% — likely a batch issue or ZenDesk refunds"
HINT_LOW = "Variance between 1-5% — check for timing differences on month-end shipments"

_ACCOUNT_MONTH = ["entry_month", "account_code", "account_name", "account_type",
                  "account_subtype", "normal_balance", "currency"]


def gl_activity_monthly(classified: DataFrame) -> DataFrame:
    """Account x month (x currency) roll-up of P&L accounts with YTD and 12-row lag.

    The windows order by month and then currency, so two currencies in one
    account-month have a fixed order. Both windows share one exchange on
    account_code (the YTD window adds year to the keys, which the same hash
    partitioning satisfies).
    """
    pl = classified.where(F.col("is_income_statement") == F.lit(True))
    etype = F.col("entry_type")
    monthly = pl.groupBy(*_ACCOUNT_MONTH).agg(
        money(F.sum("signed_amount")).alias("net_amount"),
        money(F.sum(F.when(etype == "debit", F.col("amount")).otherwise(F.lit(0)))).alias("total_debits"),
        money(F.sum(F.when(etype == "credit", F.col("amount")).otherwise(F.lit(0)))).alias("total_credits"),
        F.count(F.lit(1)).alias("entry_count"),
    )
    by_account = Window.partitionBy("account_code").orderBy("entry_month", "currency")
    ytd = (Window.partitionBy("account_code", F.year("entry_month"))
           .orderBy("entry_month", "currency")
           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    net = F.col("net_amount")
    w = monthly.select("*", F.lag(net, 12).over(by_account).alias("_prior"),
                       F.sum(net).over(ytd).alias("ytd_net_amount"))
    prior = F.col("_prior")
    return w.select(
        *_ACCOUNT_MONTH, "net_amount", "total_debits", "total_credits", "entry_count",
        F.lit(False).alias("is_anomaly_flagged"),
        "ytd_net_amount",
        prior.alias("prior_year_same_month_amount"),
        ratio4(net - prior, F.abs(prior)).alias("yoy_change_pct"),
    )


def gl_anomalies(activity: DataFrame, cfg: MartConfig = DEFAULT_CONFIG) -> DataFrame:
    """Account-months whose amount is more than ``anomaly_factor`` times that of
    the calendar month before, by size; a month after a gap, or after one of zero,
    has nothing to be compared with. The roll-up's own flag stays false."""
    series = Window.partitionBy("account_code", "currency").orderBy("entry_month")
    net, before = F.col("net_amount"), F.col("prior_month_amount")
    adjacent = F.add_months(F.lag("entry_month").over(series), 1) == F.col("entry_month")
    w = activity.select("account_code", "entry_month", "currency", "net_amount",
                        F.when(adjacent, F.lag(net).over(series)).alias("prior_month_amount"))
    return w.select("*", ratio4(F.abs(net), F.abs(before)).alias("times_prior_month")).where(
        (F.abs(net) > F.abs(before) * cfg.anomaly_factor) & (before != 0))


def ledger_completeness(gl: DataFrame, cfg: MartConfig = DEFAULT_CONFIG) -> DataFrame:
    """How far each ledger month is: entries are dated in the month they belong to
    and posted up to ``posting_lag_days`` later, so a month is open until then, and
    reports on it are incomplete. One pass; entries are combined by month first."""
    closes = F.date_add(F.last_day("entry_month"), cfg.posting_lag_days)
    late = F.col("_loaded_at") >= F.date_add(closes, 1).cast("timestamp_ntz")
    return gl.groupBy("entry_month").agg(
        F.count(F.lit(1)).alias("entries"), F.max("_loaded_at").alias("last_loaded_at"),
        F.count_if(late).alias("entries_after_close")).select(
        "entry_month", "entries", "last_loaded_at", closes.alias("closes_on"),
        (closes >= F.lit(cfg.as_of)).alias("is_open"), "entries_after_close")


def booked_refunds(classified: DataFrame, cfg: MartConfig = DEFAULT_CONFIG) -> DataFrame:
    """One row per order that the ledger has a refund entry for."""
    return classified.where((F.col("account_subtype") == cfg.refund_subtype)
                            & F.col("reference_id").isNotNull()).groupBy(
        F.col("reference_id").alias("order_id")).agg(F.lit(True).alias("_booked"))


def net_revenue_monthly(facts: DataFrame, refunds: DataFrame) -> DataFrame:
    """Completed revenue, refunds and what is left, by order month; and the refunds
    that the ledger does not know of."""
    sales = facts.groupBy("order_month").agg(F.sum("order_total_revenue").alias("r"))
    back = refunds.groupBy("order_month").agg(
        F.sum("revenue").alias("b"), F.sum(F.when(~F.col("is_booked"), F.col("revenue"))).alias("u"))
    zero = F.lit(0)
    j = sales.join(back, "order_month", "full_outer")
    r, b, u = (F.coalesce(F.col(c), zero) for c in "rbu")
    return j.select("order_month", money(r).alias("sales_revenue"), money(b).alias("refunded_revenue"),
                    money(r + b).alias("net_revenue"), money(u).alias("unbooked_refunds"))


def gl_ytd(activity: DataFrame) -> DataFrame:
    return activity.select("account_code", "entry_month", "currency", "net_amount",
                           "ytd_net_amount")


def gl_yoy(activity: DataFrame) -> DataFrame:
    return activity.select("account_code", "entry_month", "currency", "net_amount",
                           "prior_year_same_month_amount", "yoy_change_pct")


# P&L line -> account subtype (revenue is negated, credits being negative).
PNL_LINES = (
    ("revenue", "operating_revenue"),
    ("cogs", "cogs"),
    ("opex", "opex"),
    ("depreciation_amortization", "depreciation"),
    ("interest_expense", "interest_expense"),
    ("income_tax_expense", "income_tax"),
)


def income_statement_monthly(activity: DataFrame, budgets: DataFrame,
                             cfg: MartConfig = DEFAULT_CONFIG) -> DataFrame:
    """One row per month: conditional-sum pivot into the P&L cascade plus the
    total-revenue budget. Its rows are sorted where they leave (query, table)."""
    sub, net = F.col("account_subtype"), F.col("net_amount")
    aggs = []
    for name, subtype in PNL_LINES:
        s = F.sum(F.when(sub == subtype, net).otherwise(F.lit(0)))
        aggs.append(money(-s if name == "revenue" else s).alias(name))
    p = activity.groupBy("entry_month").agg(*aggs)
    rev, cogs, opex = F.col("revenue"), F.col("cogs"), F.col("opex")
    da, interest, tax = F.col("depreciation_amortization"), F.col("interest_expense"), F.col("income_tax_expense")
    gp = rev - cogs
    ebitda = gp - opex
    ebit = ebitda - da
    ebt = ebit - interest
    ni = ebt - tax
    cascade = p.select(
        "entry_month", "revenue", "cogs",
        gp.alias("gross_profit"), ratio4(gp, rev).alias("gross_margin_pct"),
        "opex", ebitda.alias("ebitda"), ratio4(ebitda, rev).alias("ebitda_margin_pct"),
        "depreciation_amortization", ebit.alias("ebit"), ratio4(ebit, rev).alias("ebit_margin_pct"),
        "interest_expense", ebt.alias("ebt"), "income_tax_expense",
        ni.alias("net_income"), ratio4(ni, rev).alias("net_margin_pct"),
    )
    b = budgets.where(F.col("account_code") == cfg.budget_account).select(
        F.col("budget_month"), F.col("budgeted_amount").alias("budgeted_revenue"))
    j = cascade.join(b, cascade.entry_month == b.budget_month, "left").drop("budget_month")
    bud = F.col("budgeted_revenue")
    return j.select(
        "*",
        ratio4(rev - bud, bud).alias("revenue_vs_budget_pct"),
        money(rev - F.coalesce(bud, F.lit(0))).alias("revenue_vs_budget_usd"),
    )


def budget_variance(pnl: DataFrame) -> DataFrame:
    return pnl.select("entry_month", "revenue", "budgeted_revenue",
                      "revenue_vs_budget_pct", "revenue_vs_budget_usd")


def revenue_reconciliation(facts: DataFrame, classified: DataFrame,
                           cfg: MartConfig = DEFAULT_CONFIG) -> DataFrame:
    """Months where sales-fact revenue and ledger order revenue differ by more
    than the tolerance, with an investigation hint.

    Sales side: the order facts (completed orders with their line totals),
    whose revenue by order month equals the line fact's.

    Ledger side: operating-revenue P&L entries that carry an order reference,
    read from the classified ledger (the monthly roll-up has no such flag).
    """
    start = F.lit(cfg.start_date)
    sales = (facts.where(F.col("order_month") >= start)
                  .groupBy(F.col("order_month").alias("month"))
                  .agg(money(F.sum("order_total_revenue")).alias("sales_fact_revenue")))
    gl = (classified.where((F.col("account_subtype") == cfg.revenue_subtype)
                           & (F.col("is_order_revenue") == F.lit(True))
                           & (F.col("is_income_statement") == F.lit(True))
                           & (F.col("entry_month") >= start))
                    .groupBy(F.col("entry_month").alias("month"))
                    .agg(money(-F.sum("signed_amount")).alias("gl_revenue")))
    r = sales.join(gl, "month", "left")
    s, g = F.col("sales_fact_revenue"), F.col("gl_revenue")
    gap = s - F.coalesce(g, F.lit(0))
    r = r.select("month", "sales_fact_revenue", "gl_revenue",
                 money(gap).alias("variance_usd"),
                 ratio4(F.abs(gap), s).alias("variance_pct"))
    pct = F.col("variance_pct")
    hint = (F.when(g.isNull(), HINT_NO_GL)
            .when(pct > cfg.reconciliation_high, HINT_HIGH)
            .otherwise(HINT_LOW))
    return (r.where(pct > cfg.reconciliation_tolerance)
             .select("*", hint.alias("investigation_hint")))


def order_revenue(fact: DataFrame) -> DataFrame:
    """The sales side of the reconciliation from the (stored) line fact."""
    return fact.groupBy("order_month").agg(F.sum("revenue").alias("order_total_revenue"))


def unrecognised_revenue_check(fact: DataFrame, orders: DataFrame,
                               cfg: MartConfig = DEFAULT_CONFIG,
                               hot: HotKeys = ()) -> DataFrame:
    """Fact rows whose order does not have a recognised status now, or is not
    there any more (expected: none).

    The status is read from ``orders`` (the staged orders), not from the fact,
    whose own filter would answer the question by definition; the fact may be
    the stored one. The fact is read once, and where it comes out of the join
    of lines and orders it keeps that partitioning; very large orders (``hot``)
    are divided as there.
    """
    status = F.col("order_status")
    rows = salted_join(fact.select("order_item_id", "order_id", "revenue"),
                       orders.select("order_id", "order_status"), "order_id", hot,
                       "order_item_id", "left")
    return (rows.where(status.isNull() | ~status.isin(*cfg.completed_statuses))
            .select("order_item_id", "order_id", "order_status", "revenue"))
