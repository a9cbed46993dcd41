"""Mixing sources to target weights, with DataFrame operations only.

Method: each document gets a hash-random key; the documents of a source are
range-partitioned by that key and sorted within the ranges; the prefix sums
of their sizes are distributed (totals of the ranges before, plus a running
sum within the range); each source is cut at its exact budget, after as many
whole epochs as the budget needs.

Skew: keys are uniform, so ``ranges`` equal ranges of them hold equal shares
of a source, however large. No sampling is needed to find the ranges, a rerun
or a task retried elsewhere finds the same ones, and a source with a third of
all rows is spread over all its ranges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

KEY_HEX = 15  # hex digits of the random key: 60 bits


def shares(totals: DataFrame, max_epochs: int = 3) -> DataFrame:
    """Targets from (skey, weight, source_size): the sum of all sizes, shared
    by weight; a target stops at ``max_epochs`` times its source's size and
    the excess is shared again by weight until none is above.

    The fixed point is a water level: sources in the order of size by weight
    are capped as long as their cap lies below what the level would give
    them. One row per source takes part, so the windows hold no documents.
    """
    cap = F.col("source_size") * max_epochs
    by_ratio = Window.orderBy("_ratio", "skey")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.col("_total") - F.col("_capped")) / F.col("_weights")
    ranked = (totals.withColumn("_ratio", cap / F.col("weight"))
              .withColumn("_total", F.sum("source_size").over(everything))
              .withColumn("_capped", F.coalesce(F.sum(cap).over(before), F.lit(0)))
              .withColumn("_weights", F.sum("weight").over(everything)
                          - F.coalesce(F.sum("weight").over(before), F.lit(0)))
              .withColumn("_is_capped", level > F.col("_ratio")))
    # The level is that of the first source that is not capped.
    water = F.min(F.when(~F.col("_is_capped"), F.struct(
        "_ratio", "skey", level.alias("level")))).over(everything)["level"]
    return (ranked.withColumn("_level", water)
            .select("skey", "weight", "source_size",
                    F.when(F.col("_is_capped"), cap.cast("double"))
                    .otherwise(F.col("weight") * F.col("_level")).cast("double").alias("target")))


def cyclic_weights(totals: DataFrame, cycle: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Weights dealt in turn to the sources in code-point order, null last."""
    turn = (F.row_number().over(Window.orderBy("skey")) - 1) % len(cycle)
    return totals.withColumn("weight", F.element_at(
        F.array(*[F.lit(w) for w in cycle]), turn + 1))


def source_key(source) -> F.Column:
    """Non-null form of a source: null sorts after every string."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def mix_sources(rows: DataFrame, weights=cyclic_weights, seed: str = "mix", max_epochs: int = 3,
                ranges: int = 2048) -> DataFrame:
    """All columns of ``rows`` (which has doc_id, source, size) and
    source_size, target, taken: the words that the mix takes of the row.

    ``weights`` adds a ``weight`` column to the table of sources (skey,
    source_size). taken is size times the whole epochs of the source, plus
    what of the row lies below the rest of the budget; the document at the
    cut is taken in part, so that a source's taken words are its target,
    rounded to a whole word. copies is the same in whole documents: the one at
    the cut counts once more if at least half of it lies below the cut.

    Defined cases: null doc_id is an id like any other; rows that share an id
    are ordered by size and are interchangeable when that is equal too; null
    or negative sizes are 0; a source without words has target 0; an empty
    table gives no rows; input columns named as the new ones are replaced.
    """
    made = ("source_size", "target", "taken", "copies", "size")
    own = [c for c in rows.columns if c not in made]
    key = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"),
                                                         F.lit(""))))
    base = rows.select(
        F.struct(*own).alias("row"), F.greatest(F.coalesce("size", F.lit(0)), F.lit(0))
        .cast("long").alias("size"), F.col("doc_id").alias("_id"),
        source_key(F.col("source").cast("string")).alias("skey"),
        F.conv(F.substring(key, 1, KEY_HEX), 16, 10).cast("long").alias("key"))
    width = -(-16 ** KEY_HEX // ranges)
    base = base.withColumn("range", F.floor(F.expr(f"key div {width}L")).cast("int"))
    held = base.groupBy("skey", "range").agg(F.sum("size").alias("held"))
    totals = held.groupBy("skey").agg(F.sum("held").alias("source_size"))
    targets = shares(weights(totals), max_epochs)
    budget = F.floor(F.col("target") + 0.5).cast("long")
    in_source = Window.partitionBy("skey").orderBy("range").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = (held.withColumn("offset", F.coalesce(F.sum("held").over(in_source), F.lit(0)))
               .join(targets, "skey")
               .withColumn("epochs", F.when(F.col("source_size") > 0, F.least(
                   F.expr("cast(floor(target + 0.5) as long) div source_size"),
                   F.lit(max_epochs))).otherwise(F.lit(0)))
               .withColumn("rest", budget - F.col("epochs") * F.col("source_size"))
               .select("skey", "range", "offset", "source_size", "target", "epochs", "rest"))
    in_range = Window.partitionBy("skey", "range").orderBy("key", "_id", "size").rowsBetween(
        Window.unboundedPreceding, -1)
    start = F.col("offset") + F.coalesce(F.col("before"), F.lit(0))
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - start))
    # before: running sum within the range; the range of a row and its totals
    # have the same partitioning, so the join moves no row again.
    return (base.withColumn("before", F.sum("size").over(in_range))
            .join(offsets, ["skey", "range"])
            .withColumn("taken", (F.col("epochs") * F.col("size") + part).cast("long"))
            .withColumn("copies", (F.col("epochs") + ((part > 0) & (2 * part >= F.col("size"))).cast("int")).cast("int"))
            .select("row.*", "size", "source_size", "target", "taken", "copies"))
