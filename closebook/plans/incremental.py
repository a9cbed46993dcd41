"""Incremental refresh of the completed-items fact.

A run reads the rows that were loaded since the last one, and those of a few days
before it, because statuses and lines arrive late; the orders they belong to are
made anew, from all their rows, and replace what the stored fact has of them. Only
the months that such an order leaves or enters are written.

The time up to which the fact was made is stored beside it after each run, so a run
that fails is simply repeated: its window starts where the last complete run's did.
What a run stores on the way is deleted as soon as nothing reads it any more. Orders
are made in pieces and months swapped in by parts (``refresh.store_fact``), so that
neither shuffles nor swapped months hold all lines at once.
Changed products do not touch the lines of unchanged orders; a full refresh does.
"""

from __future__ import annotations

from types import SimpleNamespace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from closebook.config import DEFAULT_CONFIG, MartConfig
from closebook.plans import refresh as full, sales
from closebook.plans.models import Marts
from closebook.session import broadcast_bytes, drop_folder, scratch_folder, table_bytes
from closebook.sources import sinks

FACT = "completed_order_items"
LOOKBACK_DAYS = 3


def _mark(out: str) -> str:
    return f"{out}/_loaded_until"


def loaded_until(raw) -> DataFrame:
    """One row: the newest load time of orders and lines."""
    newest = getattr(raw, "newest", None) or (lambda name: getattr(raw, name).agg(
        F.max("_loaded_at").alias("max_loaded_at")))
    return newest("orders").unionByName(newest("order_items")).agg(
        F.max("max_loaded_at").alias("loaded_until"))


def _since(rows: DataFrame, start) -> DataFrame:
    """Order ids of the rows loaded from ``start`` on; the filter reaches the scan."""
    return rows.where(F.col("_loaded_at") >= F.lit(start).cast("timestamp_ntz")).select(
        F.col("order_id").cast("string").alias("order_id"))


def refresh_fact(spark: SparkSession, raw, out_dir: str, cfg: MartConfig = DEFAULT_CONFIG,
                 lookback_days: int = LOOKBACK_DAYS) -> str:
    """Bring the stored fact under ``out_dir`` up to date; returns its folder. The
    first run, or one without a stored mark, is a full refresh of the fact."""
    out = out_dir.rstrip("/")
    until = loaded_until(raw)
    current = sinks.current(spark, f"{out}/{FACT}")
    if current is None or sinks.current(spark, _mark(out)) is None:
        made_until = sinks.stored(until, f"{scratch_folder(spark, 'until')}/t")
        path = full.refresh(spark, raw, out, [FACT], cfg)[FACT]
        sinks.write_table(made_until, _mark(out))
        return path
    start = sinks.read_table(spark, _mark(out)).select(
        F.expr(f"loaded_until - INTERVAL {int(lookback_days)} DAYS")).first()[0]
    work = scratch_folder(spark, "incremental")
    made_until = sinks.stored(until, f"{work}/until")
    changed = sinks.stored(_since(raw.orders, start).unionByName(_since(raw.order_items, start))
                           .where("order_id IS NOT NULL").distinct(), f"{work}/changed")

    def touched(rows: DataFrame) -> DataFrame:
        # All rows of a changed order count, not only the late ones.
        return rows.where(F.col("order_id").isin(changed))

    # Lines meet none but the changed orders, whose ids they meet before that only if these
    # are few enough to be broadcast: else all lines would be shuffled for it once more.
    few = table_bytes(spark, f"{work}/changed") <= broadcast_bytes(spark)
    part = SimpleNamespace(
        orders=touched(raw.orders), order_items=touched(raw.order_items) if few else raw.order_items,
        customers=raw.customers, products=raw.products,
        # An order has no more lines here than in the whole feed: its hot orders will do.
        order_line_sketch=getattr(raw, "order_line_sketch", None),
        order_line_ids=getattr(raw, "order_line_ids", None))
    m = Marts(part, cfg)
    full.store_staging(m, work)
    pieces = full.pieces_of(changed.count())
    cuts = full.month_cuts(m.stg_orders, pieces)
    staged = f"{work}/months"
    schema = sales.early_columns(m.completed_order_items).schema
    sinks.stage(map(sales.early_columns, m.completed_pieces(pieces)), staged, "order_date", cuts)
    drop_folder(spark, f"{work}/stg_orders")
    new = spark.read.schema(schema).parquet(staged)
    fact = spark.read.schema(m.completed_order_items.schema).parquet(current)
    old_months = touched(fact).select("order_month")
    # One row a month, at most the months there are.
    with sinks.shuffles_dropped(spark):
        months = [r[0] for r in
                  new.select("order_month").unionByName(old_months).distinct().collect()]
    known = [v for v in months if v is not None]
    in_months = F.col("order_month").isin(known) | (F.col("order_month").isNull()
                                                    & F.lit(len(known) < len(months)))
    kept = fact.where(in_months).join(changed, "order_id", "left_anti")
    sinks.stage([sales.early_columns(kept)], staged, "order_date", cuts)
    drop_folder(spark, f"{work}/changed")
    for k, rows in enumerate(sinks.staged_parts(spark, staged, schema, len(cuts) + 1)):
        own = [v for v in months if sinks.part_of(v, cuts) == k]
        if own:
            month, *layout = full.FACT_LAYOUT
            sinks.overwrite_partitions(rows, current, month, own, *layout,
                                       sales.with_late_columns, "zstd")
    sinks.write_table(made_until, _mark(out))
    drop_folder(spark, work)
    return current
