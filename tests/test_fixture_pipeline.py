"""End-to-end expected values on the hand-made feeds (worked out by hand)."""

import datetime as dt
from decimal import Decimal as D

import pytest

from closebook.config import MartConfig
from closebook.operators import quality
from closebook.plans import checks, finance, sales
from closebook.plans.models import Marts
from fixture_feeds import feeds

d = dt.date


@pytest.fixture(scope="module")
def m(spark):
    return Marts(feeds(spark), MartConfig(as_of=d(2025, 6, 30)))


def by(rows, key):
    return {r[key]: r for r in rows}


def test_stg_orders_dedupe_and_normalise(m):
    rows = by(m.stg_orders.collect(), "order_id")
    assert set(rows) == {"A1", "A2", "A3", "A4", "A5"}
    assert rows["A1"]["order_status"] == "shipped"
    assert rows["A1"]["sales_channel"] == "online" and rows["A1"]["region"] == "east"
    assert rows["A3"]["order_status"] == "cancelled"          # tie -> later status
    assert rows["A5"]["order_status"] == "delivered"
    assert rows["A2"]["total_amount"] == D("0.00")            # null total -> 0


def test_stg_order_items_and_products(m):
    items = by(m.stg_order_items.collect(), "order_item_id")
    assert "I8" not in items                                  # quantity 0 dropped
    assert items["I1"]["net_amount"] == D("18.00")
    assert items["I2"]["net_amount"] == D("50.00")            # null discount -> 0
    assert items["I6"]["net_amount"] == D("76.00")
    prods = by(m.stg_products.collect(), "product_id")
    assert prods["P1"]["category"] == "gadgets" and prods["P1"]["product_name"] == "Desk Lamp"
    assert prods["P1"]["base_margin_pct"] == 0.5
    assert prods["P3"]["base_margin_pct"] is None


def test_stg_customers_names(m):
    c = by(m.stg_customers.collect(), "customer_id")
    assert c["C1"]["first_name"] == "Ana Maria" and c["C1"]["last_name"] == "Lopez"
    assert c["C1"]["full_name"] == "ana maria lopez" and c["C1"]["email"] == "ana@mail.com"
    assert c["C3"]["full_name"] is None                       # null part -> null name


def test_stg_gl_signs(m):
    g = by(m.stg_gl_entries.collect(), "entry_id")
    assert "G10" not in g                                     # amount 0 dropped
    assert g["G1"]["signed_amount"] == D("-68.00")
    assert g["G4"]["signed_amount"] == D("10.00")             # 'Debit' normalised
    assert g["G9"]["signed_amount"] is None                   # unknown type -> null
    assert g["G1"]["entry_month"] == d(2024, 4, 1)


def test_economics_keeps_orphans(m):
    e = by(m.order_line_economics.collect(), "order_item_id")
    assert len(e) == 7
    assert e["I7"]["customer_id"] is None and e["I7"]["is_revenue_recognized"] is None
    assert e["I6"]["has_missing_cost"] is True and e["I6"]["cogs"] == D("0.00")
    assert e["I1"]["effective_discount_pct"] == 0.1667
    assert e["I4"]["is_revenue_recognized"] is False


def test_fact(m):
    f = by(m.completed_order_items.collect(), "order_item_id")
    assert set(f) == {"I1", "I2", "I3", "I6"}
    assert sum(r["revenue"] for r in f.values()) == D("174.00")
    assert f["I1"]["gross_margin_pct"] == 0.3333 and f["I6"]["gross_margin_pct"] == 1.0
    assert f["I1"]["order_total_revenue"] == D("68.00") and f["I2"]["order_line_count"] == 2
    assert f["I1"]["order_total_cogs"] == D("32.00")
    assert f["I1"]["day_of_week"] == 2                        # 2024-04-02 is a Tuesday
    assert f["I1"]["fiscal_quarter"] == 2


def test_customer_360(m):
    c = by(m.customer_360.collect(), "customer_id")
    assert c["C1"]["total_completed_orders"] == 1 and c["C1"]["lifetime_revenue"] == D("68.00")
    assert c["C1"]["avg_order_value"] == 68.0 and c["C1"]["repurchase_rate"] == 0.0
    assert c["C2"]["total_completed_orders"] == 2 and c["C2"]["total_units_purchased"] == 7
    assert c["C2"]["avg_order_value"] == 53.0 and c["C2"]["repurchase_rate"] == 0.5
    assert c["C2"]["days_since_last_order"] == (d(2025, 6, 30) - d(2025, 4, 15)).days
    assert c["C2"]["is_churn_risk"] is False                  # within 90 days
    assert c["C1"]["is_churn_risk"] is False                  # older than 12 months
    assert c["C3"]["customer_tier"] == "prospect" and c["C3"]["is_churn_risk"] is None
    assert c["C2"]["customer_tier"] == "bronze"


def test_monthly_kpis(m):
    rows = m.revenue_performance_monthly.collect()
    g = {(r["order_month"], r["sales_channel"], r["region"], r["category"]): r for r in rows}
    r = g[(d(2024, 4, 1), "online", "east", "gadgets")]
    assert r["net_revenue"] == D("18.00") and r["avg_order_value"] == 68.0
    assert r["new_customers"] == 2 and r["returning_customers"] == -1
    assert r["avg_effective_discount_pct"] == 0.1667
    later = g[(d(2025, 4, 1), "retail", "west", "tools")]
    assert later["new_customers"] == 0 and later["ytd_revenue"] == D("76.00")
    assert later["mom_revenue_growth_pct"] is None


def test_income_statement_and_budget(m):
    p = by(m.income_statement_monthly.collect(), "entry_month")
    apr = p[d(2024, 4, 1)]
    assert apr["revenue"] == D("104.00") and apr["cogs"] == D("50.00")
    assert apr["gross_profit"] == D("54.00") and apr["gross_margin_pct"] == 0.5192
    assert apr["opex"] == D("10.00") and apr["ebitda"] == D("44.00")
    assert apr["budgeted_revenue"] == D("100.00") and apr["revenue_vs_budget_pct"] == 0.04
    may = p[d(2024, 5, 1)]                                    # refund only: zero P&L
    assert may["revenue"] == D("0.00") and may["gross_margin_pct"] is None
    nxt = p[d(2025, 4, 1)]
    assert nxt["budgeted_revenue"] is None and nxt["revenue_vs_budget_usd"] == D("76.00")


def test_gl_activity_excludes_balance_sheet(m):
    rows = m.gl_activity_monthly.collect()
    assert "CASH-7000" not in {r["account_code"] for r in rows}
    rev = [r for r in rows if r["account_code"] == "REV-1000"]
    assert {r["entry_month"]: r["net_amount"] for r in rev} == {
        d(2024, 4, 1): D("-104.00"), d(2025, 4, 1): D("-76.00")}
    opex = [r for r in rows if r["account_code"] == "OPEX-3000"][0]
    assert opex["entry_count"] == 2 and opex["net_amount"] == D("10.00")


def test_reconciliation(m):
    rows = m.revenue_reconciliation.collect()
    assert len(rows) == 1
    r = rows[0]
    assert r["month"] == d(2024, 4, 1) and r["variance_usd"] == D("-1.00")
    assert r["variance_pct"] == 0.0102 and r["investigation_hint"] == finance.HINT_LOW


def test_unrecognised_check_is_empty(m):
    assert finance.unrecognised_revenue_check(m.completed_order_items, m.stg_orders).count() == 0


def test_quality_checks(m):
    def model(name):
        return getattr(m.raw, name[4:]) if name.startswith("raw_") else m.model(name)
    res = {r["check_id"]: r["failures"]
           for r in quality.run_checks(checks.all_checks(), model).collect()}
    assert len(res) == 65
    assert res["not_null__stg_gl_entries__signed_amount"] == 1
    assert res["accepted_values__raw_orders__status"] == 2    # 'Shipped ', 'DELIVERED'
    assert res["relationships__raw_gl_entries__account_code__raw_chart_of_accounts"] == 1
    assert res["not_null__raw_orders__order_id"] == 1
    assert res["unique__completed_order_items__order_item_id"] == 0
    assert res["relationships__completed_order_items__customer_id__stg_customers"] == 0
    assert res["expression__revenue_performance_monthly__new_customers"] == 0
    assert res["unique_combination__stg_budgets__budget_month+account_code"] == 0


def test_orphans(m):
    o = sales.orphan_lines(m.stg_order_items, m.stg_orders, m.hot_orders).collect()
    assert [r["order_item_id"] for r in o] == ["I7"]
