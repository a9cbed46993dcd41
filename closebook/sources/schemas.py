"""Explicit schemas of the seven raw feeds (no inference on load)."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, TS, B, I = T.StringType(), T.DateType(), T.TimestampNTZType(), T.BooleanType(), T.IntegerType()
# Raw numbers keep the digits of the feed; staging rounds them. Quantity times
# price times (1 - rate) of these types is exact in 38 digits.
MONEY = T.DecimalType(16, 6)
RATE = T.DecimalType(9, 8)


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


RAW_SCHEMAS: dict[str, T.StructType] = {
    "orders": _schema(
        ("order_id", S), ("customer_id", S), ("order_date", D), ("shipped_date", D),
        ("delivered_date", D), ("status", S), ("channel", S), ("region", S),
        ("subtotal_amount", MONEY), ("discount_amount", MONEY), ("tax_amount", MONEY),
        ("shipping_amount", MONEY), ("total_amount", MONEY), ("_loaded_at", TS),
    ),
    "order_items": _schema(
        ("order_item_id", S), ("order_id", S), ("product_id", S), ("quantity", I),
        ("unit_price", MONEY), ("discount_pct", RATE), ("_loaded_at", TS),
    ),
    "customers": _schema(
        ("customer_id", S), ("first_name", S), ("last_name", S), ("email", S),
        ("segment", S), ("country", S), ("city", S), ("registration_date", D),
        ("_loaded_at", TS),
    ),
    "products": _schema(
        ("product_id", S), ("sku", S), ("product_name", S), ("category", S),
        ("subcategory", S), ("brand", S), ("cost_price", MONEY), ("list_price", MONEY),
        ("is_active", B), ("_loaded_at", TS),
    ),
    "gl_entries": _schema(
        ("entry_id", S), ("account_code", S), ("entry_date", D), ("entry_type", S),
        ("amount", MONEY), ("description", S), ("reference_id", S), ("currency", S),
        ("_loaded_at", TS),
    ),
    "chart_of_accounts": _schema(
        ("account_code", S), ("account_name", S), ("account_type", S),
        ("account_subtype", S), ("normal_balance", S), ("is_income_statement", B),
        ("_loaded_at", TS),
    ),
    "budgets": _schema(
        ("budget_id", S), ("account_code", S), ("fiscal_year", I), ("month_number", I),
        ("budgeted_amount", MONEY), ("currency", S), ("_loaded_at", TS),
    ),
}

# Logical source name -> (source group, physical identifier); the group maps to a
# database/schema per environment in SourceCatalog.
SOURCE_IDENTIFIERS: dict[str, tuple[str, str]] = {
    "orders": ("raw_sales", "raw_orders"),
    "order_items": ("raw_sales", "raw_order_items"),
    "customers": ("raw_sales", "raw_customers"),
    "products": ("raw_sales", "raw_products"),
    "gl_entries": ("raw_finance", "raw_gl_entries"),
    "chart_of_accounts": ("raw_finance", "raw_chart_of_accounts"),
    "budgets": ("raw_finance", "raw_budgets"),
}
