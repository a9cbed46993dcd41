"""Latest row per key for append-only feeds; keys that the planner knows to be unique."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of each key under ``order`` (row_number = 1).

    Catalyst plans ``row_number() ... = 1`` as a WindowGroupLimit: a partial
    top-1 runs before the shuffle, so each map task sends at most one row per
    key. A key that holds a large share of the feed is therefore reduced
    map-side instead of landing whole on one reducer.
    """
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(w))
              .where(F.col("_rn") == 1)
              .drop("_rn"))


def keyed(df: DataFrame, key: str) -> DataFrame:
    """``df`` for the right side of a left join on ``key``, of which a reader may need
    no column. If no key repeats (a count by key finds out), rows are grouped by it, so
    the planner knows that a row has one match at most, and drops the join where nothing
    of it is read. Else ``df`` itself, whose matches multiply rows. Null keys match
    nothing and count for nothing."""
    known = df.where(F.col(key).isNotNull())
    repeated = known.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    return df if not repeated.isEmpty() else known.dropDuplicates([key])
