"""Type-2 slowly changing dimension (check strategy) without MERGE.

``snapshot_apply(existing, incoming, ...)`` returns the next snapshot version:

* a new key opens a version;
* a change in any check column (null-safe) closes the open version and opens
  a new one; changes in other columns do not make a version;
* a key missing from the incoming extract is closed when
  ``invalidate_hard_deletes`` is on; a key that comes back opens a new version.

Closed history rows are passed through untouched. The open rows and the
incoming extract meet in one full outer join on the key (one shuffle), and
each joined row emits its (possibly closed) old version and, if needed, the
new version through a single ``explode``, so the join is computed once.
Write each result to a new location (see ``sinks.write_versioned``); plain
parquet has no MERGE, and a version is never overwritten in place.

``history_of(extracts, loads, ...)`` makes the same history from all dated
extracts at once, as gaps and islands: one shuffle by key, however many loads.
``as_of_merge`` looks facts up in a history, in time linear in both.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from closebook.functions.columns import ntz
from closebook.operators.skew import as_table

SCD_COLUMNS = ("scd_id", "updated_at", "valid_from", "valid_to")


def _scd_id(key: Column, ts: Column) -> Column:
    return F.md5(F.concat_ws("|", key.cast("string"), ts.cast("string")))


def _as_ts(as_of: dt.datetime | Column) -> Column:
    return as_of.cast("timestamp_ntz") if isinstance(as_of, Column) else ntz(as_of)


def snapshot_open(incoming: DataFrame, key: str, as_of: dt.datetime | Column) -> DataFrame:
    """First snapshot: every incoming row opens a version."""
    ts = _as_ts(as_of)
    return incoming.select("*", _scd_id(F.col(key), ts).alias("scd_id"), ts.alias("updated_at"),
                           ts.alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to"))


def snapshot_apply(existing: DataFrame | None, incoming: DataFrame, key: str,
                   check_cols: Sequence[str], as_of: dt.datetime | Column,
                   invalidate_hard_deletes: bool = True) -> DataFrame:
    if existing is None:
        return snapshot_open(incoming, key, as_of)
    ts = _as_ts(as_of)
    data_cols = incoming.columns
    history = existing.where(F.col("valid_to").isNotNull())
    current = existing.where(F.col("valid_to").isNull())

    e, i = current.alias("e"), incoming.alias("i")
    j = e.join(i, F.col(f"e.{key}") == F.col(f"i.{key}"), "full_outer")
    ek, ik = F.col(f"e.{key}"), F.col(f"i.{key}")
    same = F.lit(True)
    for c in check_cols:
        same = same & F.col(f"e.{c}").eqNullSafe(F.col(f"i.{c}"))
    both = ek.isNotNull() & ik.isNotNull()
    changed = both & ~same
    gone = ek.isNotNull() & ik.isNull()
    close = changed | (gone & F.lit(invalidate_hard_deletes))
    opens = (ek.isNull() & ik.isNotNull()) | changed

    old_version = F.when(ek.isNotNull(), F.struct(
        *[F.col(f"e.{c}").alias(c) for c in data_cols],
        F.col("e.scd_id").alias("scd_id"), F.col("e.updated_at").alias("updated_at"),
        F.col("e.valid_from").alias("valid_from"),
        F.when(close, ts).otherwise(F.lit(None).cast("timestamp_ntz")).alias("valid_to")))
    new_version = F.when(opens, F.struct(
        *[F.col(f"i.{c}").alias(c) for c in data_cols],
        _scd_id(ik, ts).alias("scd_id"), ts.alias("updated_at"), ts.alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to")))
    rows = (j.select(F.explode(F.array(old_version, new_version)).alias("v"))
             .where(F.col("v").isNotNull()).select("v.*"))
    return history.unionByName(rows)


def history_of(extracts: DataFrame, loads: DataFrame, key: str, check_cols: Sequence[str],
               invalidate_hard_deletes: bool = True) -> DataFrame:
    """The history that ``snapshot_apply`` reaches over all loads, in one pass.

    ``extracts`` has the rows of every load, with ``load_no``; ``loads`` has
    (load_no, load_ts), one row per load, also for an empty one. A key's rows
    in the order of the loads form islands: one ends where a check column
    changes (null-safe) or, with ``invalidate_hard_deletes``, where the key
    misses a load. An island is a version: its first row, valid from its first
    load to the load that ended it. The windows share one exchange on the key
    and only look one row back or ahead.

    Within a load the key is unique; rows of unlisted loads take no part.
    """
    data = [c for c in extracts.columns if c not in ("load_no", "load_ts")]
    # One row per load: the one window over all of them is over a tiny table.
    in_time = Window.orderBy("load_ts")
    order = loads.select("load_no", "load_ts", F.row_number().over(in_time).alias("_n"),
                         F.lead("load_ts").over(in_time).alias("_next"))
    rows = extracts.select("load_no", *data).join(order, "load_no")
    by_key = Window.partitionBy(key).orderBy("_n")
    before = F.lag("_n").over(by_key)
    same = before.isNotNull()
    if invalidate_hard_deletes:
        same = same & (before == F.col("_n") - 1)
    for c in check_cols:
        same = same & F.lag(c).over(by_key).eqNullSafe(F.col(c))
    marked = rows.withColumn("_first", ~same)
    marked = marked.withColumn("_last", F.coalesce(F.lead("_first").over(by_key), F.lit(True)))
    ends = marked.where(F.col("_first") | F.col("_last"))
    if invalidate_hard_deletes:  # closed by the load after its last row
        closed = F.when(F.col("_last"), F.col("_next")).otherwise(F.lead("_next").over(by_key))
        versions = ends.withColumn("valid_to", closed).where("_first")
    else:  # closed by the next version
        versions = ends.where("_first").withColumn("valid_to", F.lead("load_ts").over(by_key))
    ts = F.col("load_ts").cast("timestamp_ntz")
    return versions.select(*data, _scd_id(F.col(key), ts).alias("scd_id"), ts.alias("updated_at"),
                           ts.alias("valid_from"), F.col("valid_to").cast("timestamp_ntz"))


def as_of_join(facts: DataFrame, history: DataFrame, key: str, at: Column,
               columns: Sequence[str], how: str = "left") -> DataFrame:
    """Attach the version valid at time ``at`` (valid_from <= at < valid_to) by a
    join on the key and a range; ``as_of_merge`` does it without the pairs."""
    h = history.select(F.col(key).alias("_h_key"), "valid_from", "valid_to",
                       *[F.col(c).alias(c) for c in columns])
    at_ts = at.cast("timestamp_ntz")
    cond = ((F.col(key) == F.col("_h_key")) & (F.col("valid_from") <= at_ts)
            & (F.col("valid_to").isNull() | (at_ts < F.col("valid_to"))))
    return facts.join(h, cond, how).drop("_h_key", "valid_from", "valid_to")


_MIX = 1 << 20  # places within a second


def _place(seconds: Column, spread: Column) -> Column:
    """A fact's place in time as a long: its second, then a hash, so that facts
    of one instant can be divided as well."""
    return seconds * F.lit(_MIX) + F.pmod(spread, F.lit(_MIX))


def time_cuts(facts: DataFrame, key: str, at: Column, spread: str,
              hot: Sequence[tuple[str, int]]) -> DataFrame | None:
    """(_cut_key, _cuts): for each hot key the places that divide its facts in
    as many equal parts as ``hot`` says, by a quantile sketch that is merged
    from the map side up. None if nothing is hot."""
    if not hot:
        return None
    parts = as_table(facts, key, hot)
    some = facts.select(F.col(key).alias("_hot_key"), _place(
        F.unix_seconds(at.cast("timestamp")), F.xxhash64(spread)).alias("_p")).join(
        F.broadcast(parts), "_hot_key")
    most = max(n for _, n in hot)
    # One sketch a key; a key of n parts takes every (most / n)-th of the quantiles.
    steps = [i / most for i in range(1, most)]
    cuts = some.groupBy("_hot_key", "_fanout").agg(
        F.percentile_approx("_p", steps, 10_000).alias("_q"))
    at_step = F.transform(F.sequence(F.lit(1), F.col("_fanout") - 1), lambda i: F.get(
        F.col("_q"), F.ceil(i * F.lit(float(most)) / F.col("_fanout")).cast("int") - 1))
    return cuts.select(F.col("_hot_key").alias("_cut_key"), at_step.alias("_cuts"))


def as_of_merge(facts: DataFrame, history: DataFrame, key: str, at: Column,
                columns: Sequence[str], cuts: DataFrame | None = None,
                spread: str | None = None) -> DataFrame:
    """``facts`` with ``columns`` of the version valid at ``at`` (valid_from <=
    at < valid_to), null where there is none.

    Versions and facts are one stream per key, sorted by time; the last version
    is carried forward to the facts after it, so the work is the sum of both,
    where a range join does facts x versions of a key. Keys listed in ``cuts``
    (``time_cuts``, with the same ``spread``) are divided by time: a fact goes
    to the slice of its place, a version to every slice in which it is valid.
    ``cuts`` is broadcast: it has a row per hot key, a bounded list.
    """
    own = facts.columns
    seconds = F.unix_seconds(F.col("_at").cast("timestamp"))
    f = facts.withColumn("_at", at.cast("timestamp_ntz")).select(
        F.col(key).alias("_key"), "_at", F.struct(*own).alias("_fact"),
        *([F.xxhash64(spread).alias("_h")] if cuts is not None else []))
    version = F.struct("valid_to", *columns).alias("_version")
    v = history.where(F.col(key).isNotNull()).select(
        F.col(key).alias("_key"), F.col("valid_from").alias("_at"), version)
    if cuts is not None:
        # A fact without time or key finds no version; it goes where its hash says.
        slot = F.size(F.filter("_cuts", lambda c: c <= _place(seconds, F.col("_h"))))
        f = (f.join(F.broadcast(cuts), F.col("_key") == F.col("_cut_key"), "left")
             .withColumn("_slice", F.coalesce(F.when(F.col("_cuts").isNotNull(), slot), F.lit(0)))
             .drop("_cut_key", "_cuts", "_h"))
        until = F.unix_seconds(F.col("_version.valid_to").cast("timestamp"))
        # Slice i holds the seconds from cut i to cut i + 1, both included.
        first = F.size(F.filter("_cuts", lambda c: F.floor(c / F.lit(float(_MIX))) < seconds))
        last = F.when(until.isNull(), F.size("_cuts")).otherwise(
            F.size(F.filter("_cuts", lambda c: F.floor(c / F.lit(float(_MIX))) <= until)))
        slices = F.when(F.col("_cuts").isNull(), F.array(F.lit(0))).otherwise(
            F.sequence(first, F.greatest(first, last)))
        v = (v.join(F.broadcast(cuts), F.col("_key") == F.col("_cut_key"), "left")
             .withColumn("_slice", F.explode(slices)).drop("_cut_key", "_cuts"))
    else:
        f, v = f.withColumn("_slice", F.lit(0)), v.withColumn("_slice", F.lit(0))
    # Facts without a key are spread; they meet no version.
    lost = F.col("_key").isNull()
    f = f.withColumn("_slice", F.when(lost, F.hash("_fact")).otherwise(
        F.col("_slice")))
    both = v.select("_key", "_slice", "_at", "_version", F.lit(None).cast(
        f.schema["_fact"].dataType).alias("_fact"), F.lit(0).alias("_kind")).unionByName(
        f.select("_key", "_slice", "_at", F.lit(None).cast(v.schema["_version"].dataType)
                 .alias("_version"), "_fact", F.lit(1).alias("_kind")))
    past = (Window.partitionBy("_key", "_slice").orderBy("_at", "_kind")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = both.withColumn("_version", F.last("_version", ignorenulls=True).over(past)).where(
        F.col("_kind") == 1)
    valid = F.col("_at").isNotNull() & (F.col("_version.valid_to").isNull()
                                        | (F.col("_at") < F.col("_version.valid_to")))
    return found.select("_fact.*", *[F.when(valid, F.col("_version")[c]).alias(c)
                                     for c in columns])
