"""Full refresh: build staging as views and the marts as stored tables.

Marts are written in dependency order, and a mart that consumes another
mart reads the *stored* table, not its lazy plan (customer 360 reads the
fact, monthly KPIs read the fact and customer 360, the P&L reads the monthly
ledger), also when it is refreshed alone and the other was stored before. That keeps every
job's lineage one mart deep (an executor lost late in the run re-computes
one mart, not the whole chain) and matches the warehouse semantics (marts
read tables).

Staging and intermediate models stay lazy, as views and inlined models do, but
for the staged orders: their dedupe is stored once, so that the fact's filter on
the order status stands over a plain scan. Spark's runtime bloom filter (settings
in ``session.py``) then keeps the lines of all other orders out of the line
shuffle. With ``buckets`` the staged lines and orders are stored bucketed by
order_id, and the fact joins them without any shuffle of lines or orders.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from closebook.config import DEFAULT_CONFIG, MartConfig
from closebook.functions.columns import month_of
from closebook.plans import finance, sales, staging
from closebook.operators.snapshot import snapshot_apply
from closebook.plans.models import Marts
from closebook.session import drop_folder, scratch_folder
from closebook.sources import sinks

SALES = ("completed_order_items", "customer_360", "revenue_performance_monthly")
FINANCE = ("gl_activity_monthly", "income_statement_monthly")
ALL_MARTS = SALES + FINANCE
STAGING = ("stg_orders", "stg_order_items", "stg_customers", "stg_products", "stg_gl_entries",
           "stg_chart_of_accounts", "stg_budgets")
#: The marts that another one is made of.
UPSTREAM = {"customer_360": ("completed_order_items",),
            "revenue_performance_monthly": ("completed_order_items", "customer_360"),
            "income_statement_monthly": ("gl_activity_monthly",)}


def store_staging(m: Marts, out_dir: str, buckets: int | None = None) -> None:
    """Store the staged orders, and with ``buckets`` the staged lines too, both
    bucketed by order_id, and let the model graph read them. Very large orders
    would each fill one bucket; where there are any, lines and orders meet by
    the salted join instead, and the tables are stored plain."""
    if buckets and not m.hot_orders:
        for name in ("stg_orders", "stg_order_items"):
            m.use(name, sinks.write_bucketed(m.model(name), f"{out_dir}/{name}", "order_id",
                                             buckets))
        return
    m.use("stg_orders", sinks.stored(m.stg_orders, f"{out_dir}/stg_orders"))


#: The line fact is made in pieces of so many orders, so that its shuffle files hold a
#: piece's lines and not all; each piece reads the lines again, hence the bound.
ORDERS_PER_PIECE = 8_000_000
MOST_PIECES = 8
#: How the stored fact is clustered: its folders, the order in them, the last key, and
#: bytes a file (of zstd, which take as many rows as twice the bytes of snappy).
FACT_LAYOUT = ("order_month", ("order_date", "sales_channel"), "order_item_id", 64 << 20)


def pieces_of(orders: int) -> int:
    return max(1, min(MOST_PIECES, -(-orders // ORDERS_PER_PIECE)))


def month_cuts(orders: DataFrame, parts: int) -> list[dt.date]:
    """Months that divide the orders into so many parts at most, of like size. One row
    a month is collected."""
    if parts < 2:
        return []
    rows = orders.where(F.col("order_date").isNotNull()).groupBy(
        month_of("order_date").alias("month")).agg(F.count(F.lit(1)).alias("n"))
    with sinks.shuffles_dropped(orders.sparkSession):
        months = sorted(rows.collect())
    cuts, seen, total = [], 0, sum(n for _, n in months)
    for month, n in months:
        if seen * parts >= total * (len(cuts) + 1):
            cuts.append(month)
        seen += n
    return cuts


def store_fact(m: Marts, path: str, pieces: int, parts: int) -> str:
    """Write the line fact as a table under ``path``; returns the folder of the version.
    It is staged in pieces of whole orders and clustered in parts of whole months; what
    follows from other columns of a row is made when the row is written."""
    spark, staged = m.stg_orders.sparkSession, f"{path.rstrip('/')}/_staged"
    drop_folder(spark, staged)
    cuts = month_cuts(m.stg_orders, parts)
    sinks.stage(map(sales.early_columns, m.completed_pieces(pieces)), staged, "order_date", cuts)
    schema = sales.early_columns(m.completed_order_items).schema
    version = sinks.write_parts(
        sinks.staged_parts(spark, staged, schema, len(cuts) + 1), path, *FACT_LAYOUT,
        made=sales.with_late_columns, compression="zstd")
    drop_folder(spark, staged)
    return version


def build(m: Marts, name: str, stored: Callable[[str], DataFrame]) -> DataFrame:
    """A mart from the stored tables of the marts that it reads."""
    if name == "customer_360":
        return sales.customer_360(
            m.stg_customers, sales.order_facts_of(stored("completed_order_items")), m.cfg)
    if name == "revenue_performance_monthly":
        return sales.revenue_performance_monthly(
            sales.order_categories_of(stored("completed_order_items")),
            sales.new_customers_monthly(stored("customer_360")))
    if name == "income_statement_monthly":
        return finance.income_statement_monthly(
            stored("gl_activity_monthly"), m.stg_budgets, m.cfg).orderBy("entry_month")
    return m.model(name)


def refresh(spark: SparkSession, raw, out_dir: str, select: Iterable[str] = ALL_MARTS,
            cfg: MartConfig = DEFAULT_CONFIG, buckets: int | None = None) -> dict[str, str]:
    """Write the selected marts under ``out_dir``; returns name -> folder of the
    version written.

    ``raw`` exposes the seven raw feeds (see ``Marts``). The fact is written
    partitioned by ``order_month`` and range-clustered by order date and
    channel; the other marts are plain tables. ``buckets`` stores staged lines
    and orders in that many buckets by order_id (some 128 MB of lines each).
    """
    m = Marts(raw, cfg)
    chosen = [n for n in ALL_MARTS if n in set(select)]
    out = out_dir.rstrip("/")
    if "completed_order_items" in chosen:
        store_staging(m, out, buckets)
    for name in STAGING:
        sinks.as_view(m.model(name), name)
    paths: dict[str, str] = {}

    def stored(n: str):
        """The stored table of an upstream mart, written just now or before."""
        path = f"{out}/{n}"
        return sinks.read_table(spark, path) if sinks.current(spark, path) else m.model(n)

    for name in chosen:
        if name == "completed_order_items":
            parts = pieces_of(m.stg_orders.count())
            # Bucketed tables meet without a shuffle.
            paths[name] = store_fact(m, f"{out}/{name}", 1 if buckets else parts, parts)
        else:
            paths[name] = sinks.write_table(build(m, name, stored), f"{out}/{name}")
    return paths


#: What reads the ledger feed among the models of the checks.
LEDGER = ("raw_gl_entries", "stg_gl_entries", "gl_activity_monthly")


def stored_models(m: Marts, named: Iterable[str | None],
                  reads: Mapping[str, set[str]]) -> Callable[[str], DataFrame]:
    """A resolver of check models; ``reads`` has the names that are read of each.

    What several models read is written once to a scratch folder: the line fact,
    with the columns that they read and without totals of orders, which are summed
    from it; the staged orders; the postings of orders, if the ledger is derived from
    lines whenever it is read. Lines meet products only where a reader needs a price or
    a product's column, or where a product's key repeats. What one model reads stays in
    that model's plan. Checks of the totals read the whole fact."""
    named = set(named)
    need = named & set(ALL_MARTS)
    for name in reversed(ALL_MARTS):
        need.update(UPSTREAM.get(name, ()) if name in need else ())
    read_again = {u for name in need for u in UPSTREAM.get(name, ())}
    fact, customers, monthly = SALES
    of = {name: reads.get(name, set()) for name in SALES}
    # The columns of the fact that each of its readers takes.
    taken = []
    if fact in named:
        taken.append([c for c in sales.FACT_COLUMNS if c in of[fact]])
    counts_new = monthly in need and of[monthly] & {"new_customers", "returning_customers"}
    if counts_new or (customers in named and of[customers] - set(sales.PARTY_COLUMNS)):
        taken.append(sales.CUSTOMER_READS)
    if monthly in need:
        taken.append(sales.MONTHLY_READS)
    columns = [c for c in sales.FACT_COLUMNS if any(c in t for t in taken)]
    whole = not set(columns).isdisjoint(sales.ORDER_TOTALS)
    priced = not sales.PRICED.isdisjoint(sales.made_of(columns))
    tables: dict[str, DataFrame] = {}

    def get(name: str) -> DataFrame:
        if name == "raw_order_items" and hasattr(m.raw, "unpriced_items") \
                and "unit_price" not in reads.get(name, {"unit_price"}):
            return m.raw.unpriced_items
        if name.startswith("raw_") and name not in tables:
            return getattr(m.raw, name[len("raw_"):])
        if name not in tables:
            tables[name] = build(m, name, get)
        return tables[name]

    if need:
        out = scratch_folder(m.stg_orders.sparkSession, "marts")
        ledgers = (named | need) & set(LEDGER)
        if getattr(m.raw, "ledger_is_derived", False) and (len(ledgers) > 1 or LEDGER[-1] in ledgers):
            ledger = m.raw.ledger_of(
                sinks.stored(m.raw.order_postings, f"{out}/order_postings", "zstd"))
            tables["raw_gl_entries"] = ledger
            m.use("stg_gl_entries", staging.stg_gl_entries(ledger))
        if fact in need:
            if whole or "stg_orders" in named:
                store_staging(m, out)
            if whole:
                tables[fact] = sinks.stored(m.completed_order_items, f"{out}/{fact}", "zstd")
            else:
                lines = m.completed_lines if priced else m.unpriced_lines
                made = [c for c in sales.FACT_COLUMNS if c not in sales.ORDER_TOTALS]
                if len(taken) > 1:
                    made = columns
                    lines = sinks.stored(lines.select(*sales.made_of(columns)), f"{out}/{fact}",
                                         "zstd")
                tables[fact] = sales.fact_columns(lines, made)
        for name in ALL_MARTS:
            if name != fact and name in named & read_again:
                tables[name] = sinks.stored(get(name), f"{out}/{name}", "zstd")
    return get


def snapshot_customers(spark: SparkSession, raw, base_path: str, version: str,
                       as_of, previous: str | None = None,
                       cfg: MartConfig = DEFAULT_CONFIG) -> str:
    """One snapshot run: apply the current staged customers to the previous
    version (``previous`` path, or none for the first run) and write the
    result as a new version under ``base_path``. Returns the new path.

    The previous version is read from storage, so each run's lineage is one
    snapshot step, and a failed run leaves every earlier version intact.
    """
    m = Marts(raw, cfg)
    existing = spark.read.parquet(previous) if previous else None
    snap = snapshot_apply(existing, m.stg_customers, cfg.snapshot_key, cfg.snapshot_check_cols,
                          as_of)
    return sinks.write_versioned(snap, base_path, version)
