"""The project's data tests as a registry of ``Check`` objects.

63 declared checks (model tests, finance model tests, source tests) plus two
added by this build: an unmatched-account check on the raw ledger (the
inner join with the chart of accounts would otherwise drop such entries
silently) and a uniqueness check on (budget_month, account_code), which the
budget join relies on. The not_null on ``signed_amount`` runs on the staged
ledger, where that column exists.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closebook.config import DEFAULT_CONFIG, MartConfig
from closebook.operators import quality
from closebook.operators.quality import Check
from closebook.plans import finance

FCT, DIM, MON = "completed_order_items", "customer_360", "revenue_performance_monthly"
GLM, PNL = "gl_activity_monthly", "income_statement_monthly"


def _nn(model: str, *cols: str) -> list[Check]:
    return [Check("not_null", model, c) for c in cols]


def _expr(model: str, column: str | None, text: str) -> Check:
    return Check("expression", model, column, expression=text)


# Accepted-value lists and expressions of the declared tests.
def declared(cfg: MartConfig = DEFAULT_CONFIG) -> tuple[Check, ...]:
    return (
        # completed-items fact
        Check("unique", FCT, "order_item_sk"), *_nn(FCT, "order_item_sk"),
        Check("unique", FCT, "order_item_id"), *_nn(FCT, "order_item_id"),
        *_nn(FCT, "order_id"),
        Check("relationships", FCT, "order_id", to_model="stg_orders", to_field="order_id"),
        *_nn(FCT, "customer_id"),
        Check("relationships", FCT, "customer_id", to_model="stg_customers", to_field="customer_id"),
        *_nn(FCT, "product_id"),
        Check("relationships", FCT, "product_id", to_model="stg_products", to_field="product_id"),
        *_nn(FCT, "order_status"),
        Check("accepted_values", FCT, "order_status", values=("shipped", "delivered")),
        *_nn(FCT, "order_date"),
        _expr(FCT, "order_date", f"order_date >= DATE '{cfg.start_date.isoformat()}'"),
        *_nn(FCT, "revenue"),
        _expr(FCT, "revenue", "revenue >= 0"),
        _expr(FCT, "gross_margin_pct", "gross_margin_pct between -0.5 and 1.5"),
        _expr(FCT, None, "order_status not in ('cancelled', 'refunded', 'pending', 'processing')"),
        Check("unique_combination", FCT, columns=("order_id", "order_item_id")),
        # customer 360
        Check("unique", DIM, "customer_id"), *_nn(DIM, "customer_id"),
        *_nn(DIM, "registration_date"),
        _expr(DIM, "registration_date", f"registration_date <= DATE '{cfg.as_of.isoformat()}'"),
        *_nn(DIM, "customer_tier"),
        Check("accepted_values", DIM, "customer_tier",
              values=("platinum", "gold", "silver", "bronze", "prospect")),
        _expr(DIM, "lifetime_revenue", "lifetime_revenue >= 0 or lifetime_revenue is null"),
        _expr(DIM, "days_since_last_order", "days_since_last_order >= 0 or days_since_last_order is null"),
        # monthly KPIs
        *_nn(MON, "order_month"),
        *_nn(MON, "net_revenue"),
        _expr(MON, "net_revenue", "net_revenue >= 0"),
        _expr(MON, "avg_gross_margin_pct", "avg_gross_margin_pct between -0.5 and 1.5"),
        _expr(MON, "new_customers", "new_customers >= 0"),
        Check("unique_combination", MON, columns=("order_month", "sales_channel", "region", "category")),
        # monthly ledger activity
        *_nn(GLM, "account_code"),
        Check("relationships", GLM, "account_code", to_model="stg_chart_of_accounts",
              to_field="account_code"),
        *_nn(GLM, "entry_month"),
        *_nn(GLM, "net_amount"),
        *_nn("stg_gl_entries", "signed_amount"),
        Check("unique_combination", GLM, columns=("account_code", "entry_month")),
        # income statement
        Check("unique", PNL, "entry_month"), *_nn(PNL, "entry_month"),
        *_nn(PNL, "revenue"),
        _expr(PNL, "revenue", "revenue >= 0"),
        _expr(PNL, "gross_margin_pct", "gross_margin_pct between -0.5 and 1"),
        _expr(PNL, "ebitda_margin_pct", "ebitda_margin_pct between -2 and 1"),
        # sources
        *_nn("raw_orders", "order_id", "customer_id", "order_date"),
        Check("accepted_values", "raw_orders", "status",
              values=("pending", "processing", "shipped", "delivered", "cancelled", "refunded",
                      "Shipped", "SHIPPED")),
        *_nn("raw_order_items", "order_item_id", "order_id"),
        _expr("raw_order_items", "quantity", "quantity > 0"),
        Check("unique", "raw_customers", "customer_id"), *_nn("raw_customers", "customer_id"),
        Check("unique", "raw_products", "product_id"), *_nn("raw_products", "product_id"),
        Check("unique", "raw_gl_entries", "entry_id"), *_nn("raw_gl_entries", "entry_id"),
        Check("accepted_values", "raw_gl_entries", "entry_type", values=("debit", "credit")),
        Check("unique", "raw_chart_of_accounts", "account_code"),
        *_nn("raw_chart_of_accounts", "account_code"),
        Check("unique", "raw_budgets", "budget_id"), *_nn("raw_budgets", "budget_id"),
    )


ADDED: tuple[Check, ...] = (
    Check("relationships", "raw_gl_entries", "account_code", to_model="raw_chart_of_accounts",
          to_field="account_code", origin="added"),
    Check("unique_combination", "stg_budgets", columns=("budget_month", "account_code"),
          origin="added"),
)

def all_checks(cfg: MartConfig = DEFAULT_CONFIG) -> tuple[Check, ...]:
    return declared(cfg) + ADDED


def checks_of_kind(kind: str, cfg: MartConfig = DEFAULT_CONFIG) -> tuple[Check, ...]:
    return tuple(c for c in all_checks(cfg) if c.kind == kind)


def freshness(feeds, as_of: Column, cfg: MartConfig = DEFAULT_CONFIG) -> DataFrame:
    """Age of each source with a freshness rule; stored feeds answer from the
    footers of their files."""
    newest = getattr(feeds, "newest", None) or (lambda name: getattr(feeds, name).agg(
        F.max("_loaded_at").alias("max_loaded_at")))
    return quality.union_all([
        quality.freshness_of(newest(r.source), r.source, as_of, r.warn_after_hours,
                             r.error_after_hours) for r in cfg.freshness])


@dataclass(frozen=True)
class Assertion:
    """A test of several models: it fails by the rows that it returns."""

    name: str
    cadence: str  # how often it is to be run
    rows: Callable[[Callable[[str], DataFrame], MartConfig], DataFrame]


# ``model(name)`` gives the stored fact where there is one.
ASSERTIONS: tuple[Assertion, ...] = (
    Assertion("revenue_reconciliation", "weekly", lambda model, cfg: finance.revenue_reconciliation(
        finance.order_revenue(model(FCT)), model("gl_classified"), cfg)),
    Assertion("unrecognised_revenue", "every build", lambda model, cfg: (
        finance.unrecognised_revenue_check(model(FCT), model("stg_orders"), cfg))),
)
