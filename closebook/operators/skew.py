"""Hot-key split for a many-to-one join (one key may hold a large share of rows).

The hot keys come from a heavy-hitter sketch, not from a count of every key.
``sketch(rows, key)`` makes one frequent-items sketch per part of the keys (by
hash), from the map side up; a map task sends at most ``tracked`` keys a part,
whatever it read. Sketches of several loads merge (``hot_keys`` combines what
it gets), so those of stored loads need not be made again. With 4,096 tracked
keys (a map of 8,192) an estimate errs by 3.5 / 8,192 of the part's rows at
most, and a key is missed only below twice that: for 10^11 rows in 64 parts
below two million rows, so keys of ``rows_per_task`` = 10^7 rows are all listed.
The list has 64 x 4,096 keys at most, some 10 MB; that bound is why it may pass
the driver and be broadcast. A key gets ``ceil(count / rows_per_task)`` join
tasks, however many that is.

``salted_join(big, small, key, hot, spread)`` joins ``big`` (many rows per
key) to ``small`` (one row per key):

* without hot keys on the key alone, so that a side which is already partitioned
  by it is not shuffled again;
* else on ``(key, salt)``: ``big`` rows of a hot key get ``salt =
  pmod(xxhash64(spread), fanout)``, a hash of a column, never a random number,
  so a task re-run after an executor loss produces the same salts; rows of other
  keys get salt 0; ``small`` rows have one copy per salt (``fanout`` copies for
  a hot key, one otherwise);
* rows of ``big`` whose key is null match nothing and need not meet: a hash of
  the row stands in for their key, so they spread over all tasks.

Every ``big`` row has exactly one (key, salt) and a matching ``small`` key has
every salt, so ``inner``, ``left``, ``left_semi`` and ``left_anti`` keep their
meaning, whatever the list holds. Both sides use the same list.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HotKeys = Sequence[tuple[str, int]]


def sketch(rows: DataFrame, key: str, tracked: int = 4096, parts: int = 64) -> DataFrame:
    """(part, sketch): frequent values of ``key``, by part of the values."""
    return (rows.where(F.col(key).isNotNull())
            .groupBy(F.pmod(F.xxhash64(key), F.lit(parts)).alias("part"))
            .agg(F.expr(f"approx_top_k_accumulate(`{key}`, {tracked})").alias("sketch")))


def crowded(rows: DataFrame, key: str, rows_per_task: int, parts: int = 4096) -> DataFrame | None:
    """The rows of those parts of the keys (by hash) that have more than
    ``rows_per_task`` rows, or none if no part has: only there may a key be hot, so
    a plain count by part (4,096 at most) saves most tables their sketches."""
    part = F.pmod(F.xxhash64(key), F.lit(parts))
    rows = rows.where(F.col(key).isNotNull())
    found = [r["part"] for r in rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
             .where(F.col("n") > rows_per_task).collect()]
    return rows.where(part.isin(found)) if found else None


def hot_keys(sketches: DataFrame, rows_per_task: int, tracked: int = 4096) -> HotKeys:
    """(key, fanout) of the keys with more than ``rows_per_task`` rows over all
    ``sketches``: a short list, bounded by what the sketches can hold."""
    merged = sketches.groupBy("part").agg(
        F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("s"))
    found = merged.select(F.expr(f"inline(approx_top_k_estimate(s, {tracked}))"))
    fanout = F.ceil(F.col("count") / F.lit(float(rows_per_task))).cast("int")
    hot = found.where((F.col("count") > rows_per_task) & F.col("item").isNotNull())
    return [(r["item"], r["n"]) for r in
            hot.select("item", fanout.alias("n")).orderBy("item").collect()]


def as_table(like: DataFrame, key: str, hot: HotKeys) -> DataFrame:
    """(_hot_key, _fanout) of a list of hot keys."""
    kind = like.schema[key].dataType.simpleString()
    return like.sparkSession.createDataFrame(list(hot), f"_hot_key {kind}, _fanout int")


def _with_fanout(df: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    return (df.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left")
              .drop("_hot_key")
              .withColumn("_fanout", F.coalesce(F.col("_fanout"), F.lit(1))))


def salted_join(big: DataFrame, small: DataFrame, key: str, hot: HotKeys, spread: str,
                how: str = "inner") -> DataFrame:
    names = [key, *[c for c in big.columns if c != key]]
    if how not in ("left_semi", "left_anti"):
        names += [c for c in small.columns if c != key]
    keep_lost = how not in ("inner", "left_semi")
    if not keep_lost:
        big = big.where(F.col(key).isNotNull())
    if hot:
        listed = as_table(big, key, hot)
        salt = F.pmod(F.xxhash64(spread), F.col("_fanout"))
        big = _with_fanout(big, key, listed).withColumn("_salt", salt.cast("int")).drop("_fanout")
        small = (_with_fanout(small, key, listed)
                 .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_fanout") - 1)))
                 .drop("_fanout"))
    keys = [key, "_salt"] if hot else [key]
    if not keep_lost:
        return big.join(small, keys, how).select(*names)
    # A null key meets nothing: the row's hash spreads it, the condition keeps it alone.
    stand_in = F.concat(F.lit("\0"), F.xxhash64(spread).cast("string"))
    big = big.withColumn("_key", F.coalesce(F.col(key).cast("string"), stand_in))
    small = small.withColumn("_small_key", F.col(key).cast("string")).drop(key)
    on = (F.col("_key") == F.col("_small_key")) & F.col(key).isNotNull()
    if hot:
        small = small.withColumnRenamed("_salt", "_small_salt")
        on = on & F.col("_salt").eqNullSafe(F.col("_small_salt"))
    return big.join(small, on, how).select(*names)
