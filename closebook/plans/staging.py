"""Staging models: cast, rename, normalise, deduplicate. No business logic.

Each function maps one raw DataFrame to its staged form. They are lazy, so a
staged model costs nothing until a mart reads it, and column pruning and
filters reach the underlying scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from closebook.config import DEFAULT_CONFIG, MartConfig
from closebook.functions.columns import MONEY, RATE, make_date, money, month_of, ratio4, title_case
from closebook.operators.dedupe import latest_per_key


def _norm(c: str):
    return F.lower(F.trim(F.col(c)))


# Dedupe tiebreak rank of each status when two rows share a
# timestamp; the later lifecycle state wins.
STATUS_RANK = ("pending", "processing", "shipped", "delivered", "cancelled", "refunded")


def _status_rank(c: str):
    s = _norm(c)
    expr = F.when(s == STATUS_RANK[0], F.lit(1))
    for i, name in enumerate(STATUS_RANK[1:], start=2):
        expr = expr.when(s == name, F.lit(i))
    return expr


def _row_fingerprint(raw: DataFrame):
    """Hash of every column; null differs from the empty text, and a decimal
    hashes alike whatever scale the feed declares."""
    def text(f):
        c = F.col(f.name)
        value = c.cast("decimal(38,10)") if isinstance(f.dataType, T.DecimalType) else c
        return F.when(c.isNull(), F.lit("null")).otherwise(
            F.concat(F.lit("="), value.cast("string")))
    # 16 bytes sort as their 32 hex digits do, and are half as long in the shuffle.
    return F.unhex(F.md5(
        F.concat_ws("|", *[text(f) for f in sorted(raw.schema, key=lambda f: f.name)])))


def stg_orders(raw: DataFrame) -> DataFrame:
    """Latest row per order_id by ``_loaded_at``; ties go to the later status
    (see STATUS_RANK), then to the smallest fingerprint of the whole row, so
    the result does not depend on the order of the input."""
    src = raw.where(F.col("order_id").isNotNull()).withColumn(
        "order_id", F.col("order_id").cast("string"))
    latest = latest_per_key(src, "order_id", [
        F.col("_loaded_at").desc_nulls_last(),
        _status_rank("status").desc_nulls_last(),
        _row_fingerprint(src).asc(),
    ])
    return latest.select(
        F.col("order_id"),
        F.col("customer_id").cast("string").alias("customer_id"),
        F.col("order_date").cast("date").alias("order_date"),
        F.col("shipped_date").cast("date").alias("shipped_date"),
        F.col("delivered_date").cast("date").alias("delivered_date"),
        _norm("status").alias("order_status"),
        _norm("channel").alias("sales_channel"),
        _norm("region").alias("region"),
        money(F.col("subtotal_amount").cast(MONEY)).alias("subtotal_amount"),
        money(F.col("discount_amount").cast(MONEY)).alias("discount_amount"),
        money(F.col("tax_amount").cast(MONEY)).alias("tax_amount"),
        money(F.col("shipping_amount").cast(MONEY)).alias("shipping_amount"),
        money(F.coalesce(F.col("total_amount").cast(MONEY), F.lit(0))).alias("total_amount"),
        F.col("_loaded_at"),
    )


def stg_order_items(raw: DataFrame) -> DataFrame:
    """Cast, line net amount from the raw columns, drop null ids and qty <= 0."""
    q, p, d = F.col("quantity"), F.col("unit_price"), F.col("discount_pct")
    return raw.where(F.col("order_item_id").isNotNull() & (q > 0)).select(
        F.col("order_item_id").cast("string").alias("order_item_id"),
        F.col("order_id").cast("string").alias("order_id"),
        F.col("product_id").cast("string").alias("product_id"),
        q.cast("int").alias("quantity"),
        money(p.cast(MONEY)).alias("unit_price"),
        F.round(d.cast(RATE), 4).cast(RATE).alias("discount_pct"),
        money(q * p * (F.lit(1) - F.coalesce(d, F.lit(0)))).alias("net_amount"),
        F.col("_loaded_at"),
    )


def stg_customers(raw: DataFrame, *keep: str) -> DataFrame:
    """``keep`` names further columns that pass as they are."""
    first, last = F.trim(F.col("first_name")), F.trim(F.col("last_name"))
    return raw.where(F.col("customer_id").isNotNull()).select(
        F.col("customer_id").cast("string").alias("customer_id"),
        title_case("first_name").alias("first_name"),
        title_case("last_name").alias("last_name"),
        F.concat(first, F.lit(" "), last).alias("full_name"),
        _norm("email").alias("email"),
        _norm("segment").alias("customer_segment"),
        _norm("country").alias("country"),
        _norm("city").alias("city"),
        F.col("registration_date").cast("date").alias("registration_date"),
        F.col("_loaded_at"), *keep,
    )


def stg_products(raw: DataFrame) -> DataFrame:
    cost, lst = F.col("cost_price"), F.col("list_price")
    return raw.where(F.col("product_id").isNotNull()).select(
        F.col("product_id").cast("string").alias("product_id"),
        F.col("sku").cast("string").alias("sku"),
        F.trim(F.col("product_name")).alias("product_name"),
        _norm("category").alias("category"),
        _norm("subcategory").alias("subcategory"),
        _norm("brand").alias("brand"),
        money(cost.cast(MONEY)).alias("cost_price"),
        money(lst.cast(MONEY)).alias("list_price"),
        ratio4(lst - cost, lst).alias("base_margin_pct"),
        F.col("is_active").cast("boolean").alias("is_active"),
        F.col("_loaded_at"),
    )


def stg_gl_entries(raw: DataFrame) -> DataFrame:
    """Signed amount from the entry type: debit +, credit -, anything else null."""
    etype = _norm("entry_type")
    amount = money(F.col("amount").cast(MONEY))
    signed = F.when(etype == "debit", amount).when(etype == "credit", -amount)
    return raw.where(F.col("entry_id").isNotNull() & (F.col("amount") > 0)).select(
        F.col("entry_id").cast("string").alias("entry_id"),
        F.col("account_code").cast("string").alias("account_code"),
        F.col("entry_date").cast("date").alias("entry_date"),
        month_of(F.col("entry_date").cast("date")).alias("entry_month"),
        etype.alias("entry_type"),
        amount.alias("amount"),
        signed.alias("signed_amount"),
        F.trim(F.col("description")).alias("description"),
        F.col("reference_id").cast("string").alias("reference_id"),
        _norm("currency").alias("currency"),
        F.col("_loaded_at"),
    )


def stg_chart_of_accounts(raw: DataFrame, cfg: MartConfig = DEFAULT_CONFIG) -> DataFrame:
    """P&L flag recomputed from the raw (untrimmed) subtype; the raw flag is unused."""
    return raw.where(F.col("account_code").isNotNull()).select(
        F.col("account_code").cast("string").alias("account_code"),
        F.trim(F.col("account_name")).alias("account_name"),
        _norm("account_type").alias("account_type"),
        _norm("account_subtype").alias("account_subtype"),
        _norm("normal_balance").alias("normal_balance"),
        (~F.col("account_subtype").isin(*cfg.balance_sheet_subtypes)).alias("is_income_statement"),
        F.col("_loaded_at"),
    )


def stg_budgets(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("budget_id").isNotNull()).select(
        F.col("budget_id").cast("string").alias("budget_id"),
        F.col("account_code").cast("string").alias("account_code"),
        F.col("fiscal_year").cast("int").alias("fiscal_year"),
        F.col("month_number").cast("int").alias("month_number"),
        make_date("fiscal_year", "month_number").alias("budget_month"),
        money(F.col("budgeted_amount").cast(MONEY)).alias("budgeted_amount"),
        _norm("currency").alias("currency"),
        F.col("_loaded_at"),
    )
