"""Connected components of an edge table, by large-star and small-star steps.

Each step is a grouped minimum (combined before the shuffle) and a salted
join, so a node with very many neighbours is no hot task. No edge, label or
component passes through the driver; the loop reads one row of totals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closebook.llm.common import discard, settle, spread_join


def _relink(edges: DataFrame, lows: DataFrame) -> DataFrame:
    """Edges (a > b) with b replaced by low(b), if b has one."""
    out = spread_join(edges, lows, "b", "a").select(
        "a", F.coalesce("low", "b").alias("b"))
    return out.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame, name: str = "links") -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b), long, in any order and
    direction; root is the smallest node that can be reached. An empty table
    gives no rows."""
    now = settle(edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    mark = None
    while True:
        # Large star: a node's larger neighbours link to its smallest one.
        low = now.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("low"))
        new = settle(_relink(now, low.select(F.col("n").alias("b"), "low")), name)
        # Small star: a node's smaller neighbours and itself link to the smallest.
        low = new.groupBy("a").agg(F.min("b").alias("low"))
        moved = spread_join(new, low, "a", "b").where(F.col("b") != F.col("low")).select(
            F.col("b").alias("a"), F.col("low").alias("b"))
        new2 = settle(moved.union(low.select("a", F.col("low").alias("b"))).distinct(), name)
        discard(now), discard(new)
        now = new2
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select("b", "b").distinct())
