"""Data-quality checks: declarative registry, Spark evaluation, one row per check.

Kinds: ``not_null``, ``unique``, ``accepted_values``, ``relationships``,
``expression`` (column or model level) and ``unique_combination``. A check's
result is the number of failing rows (or failing groups for the uniqueness
kinds). Nulls pass every kind except ``not_null``; inside
``unique_combination`` nulls count as values.

All checks on one model share one pass over it and one grouped exchange (see
``_model_checks``).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROW_KINDS = ("not_null", "accepted_values", "expression")


@dataclass(frozen=True)
class Check:
    kind: str
    model: str
    column: str | None = None
    values: tuple[str, ...] = ()
    expression: str | None = None      # SQL boolean text, valid in Spark SQL and ANSI SQL
    to_model: str | None = None
    to_field: str | None = None
    columns: tuple[str, ...] = ()
    origin: str = "declared"           # "declared" in the project or "added" by this build

    @property
    def check_id(self) -> str:
        target = self.column or "+".join(self.columns) or "model"
        suffix = f"__{self.to_model}" if self.to_model else ""
        if self.kind == "expression" and self.column is None:
            suffix = "__" + hashlib.md5(self.expression.encode()).hexdigest()
        return f"{self.kind}__{self.model}__{target}{suffix}"

    def words(self) -> set[str]:
        """Every name the check may read of its model, and words that are no names."""
        return {w.lower() for w in (self.column, *self.columns,
                                    *re.findall(r"\w+", self.expression or "")) if w}

    def failing_condition(self) -> str:
        """Row-level failure predicate (row kinds only), as SQL text."""
        if self.kind == "not_null":
            return f"`{self.column}` IS NULL"
        if self.kind == "accepted_values":
            return f"NOT (`{self.column}` IN ({', '.join(map(_text, self.values))}))"
        if self.kind == "expression":
            return f"NOT ({self.expression})"
        raise ValueError(f"{self.kind} is not a row-level check")


def _text(value: str | None) -> str:
    if value is None:
        return "CAST(NULL AS STRING)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _result_struct(check: Check, failures: str) -> str:
    """SQL text, as all expressions of the checks: hundreds of Column objects
    would cost the driver more time than the text takes to parse."""
    return (f"struct({_text(check.check_id)} AS check_id, {_text(check.kind)} AS kind, "
            f"{_text(check.model)} AS model, "
            f"{_text(check.column or ','.join(check.columns) or None)} AS column_name, "
            f"CAST({failures} AS BIGINT) AS failures)")


_ROW, _DUP, _REL = 0, 1, 2
#: Row-level flags of an entry, one bit each.
_FLAGS = 30


def _keys(columns: Iterable[str], nulls: bool) -> list[str]:
    """128 hash bits of the columns as text, in two longs; with ``nulls`` a null
    is a value, else it makes both null."""
    values = [f"CAST(`{c}` AS STRING)" for c in columns]
    marked = ", ".join(f"{v} IS NULL, {v}" for v in values)
    known = "TRUE" if nulls else " AND ".join(f"`{c}` IS NOT NULL" for c in columns)
    return [f"CASE WHEN {known} THEN xxhash64({', '.join(filter(None, (str(i), marked)))}) END "
            f"AS {name}" for i, name in enumerate(("_a", "_b"))]


def _model_checks(df: DataFrame, checks: list[Check],
                  model: Callable[[str], DataFrame]) -> DataFrame:
    """All checks on one model in one pass over it and one grouped exchange.

    Each model row emits one entry whose value is its row-level failure flags, as
    bits (one more entry for each 30 further flags), one (check, value) entry per
    uniqueness check and one (check, key) entry per relationship check; each parent
    row of those emits its key. One aggregate by (family, check, value), combined
    before the shuffle, counts the entries; a key that a third of the rows hold is
    one row from there on, and so are rows with the same flags. Then

    * row checks fail by the counts of the values that have their bit;
    * unique / unique_combination fail by the values that occur more than once
      (``unique`` skips nulls; in a combination they count as values);
    * relationships fail by the counts of the keys that no parent row has.

    A last aggregate adds up each check's failures, so the model is read once.
    """
    rows = [c for c in checks if c.kind in ROW_KINDS]
    dups = [c for c in checks if c.kind in ("unique", "unique_combination")]
    rels = [c for c in checks if c.kind == "relationships"]

    def entry(fam: int, i: int, keys: list[str]) -> str:
        return f"struct({fam} AS _f, {i} AS _i, {', '.join(keys)})"

    def bits(checks: list[Check]) -> list[str]:
        terms = [f"CASE WHEN {c.failing_condition()} THEN {1 << i}L ELSE 0L END"
                 for i, c in enumerate(checks)]
        return [f"{' + '.join(terms)} AS _a", "0L AS _b"]

    entries = [entry(_ROW, i, bits(rows[i * _FLAGS:(i + 1) * _FLAGS]))
               for i in range(-(-len(rows) // _FLAGS))]
    entries += [entry(_DUP, i, _keys(c.columns or (c.column,), c.kind == "unique_combination"))
                for i, c in enumerate(dups)]
    entries += [entry(_REL, i, _keys((c.column,), False)) for i, c in enumerate(rels)]
    found = df.selectExpr(f"inline(array({', '.join(entries)}))").where("_a IS NOT NULL")
    counts = ["count(1) AS _n"]
    if rels:
        found = found.withColumn("_child", F.lit(True))
        for i, c in enumerate(rels):
            found = found.unionByName(model(c.to_model).selectExpr(
                f"{_REL} AS _f", f"{i} AS _i", *_keys((c.to_field,), False),
                "FALSE AS _child").where("_a IS NOT NULL"))
        counts = ["count_if(_child) AS _n", "bool_and(_child) AS _lost"]
    grouped = found.groupBy("_f", "_i", "_a", "_b").agg(*[F.expr(x) for x in counts])
    failures = [(c, f"sum(CASE WHEN _f = {_ROW} AND _i = {i // _FLAGS} "
                    f"AND (_a & {1 << i % _FLAGS}L) != 0 THEN _n END)") for i, c in enumerate(rows)]
    failures += [(c, f"count_if(_f = {_DUP} AND _i = {i} AND _n > 1)") for i, c in enumerate(dups)]
    failures += [(c, f"sum(CASE WHEN _f = {_REL} AND _i = {i} AND _lost THEN _n END)")
                 for i, c in enumerate(rels)]
    total = grouped.agg(*[F.expr(f"coalesce({x}, 0) AS _c{i}") for i, (_, x) in enumerate(failures)])
    results = ", ".join(_result_struct(c, f"_c{i}") for i, (c, _) in enumerate(failures))
    return total.selectExpr(f"inline(array({results}))")


def run_checks(checks: Iterable[Check], model: Callable[[str], DataFrame]) -> DataFrame:
    """Evaluate checks; ``model(name)`` returns the DataFrame a check reads.

    Returns one row per check: check_id, kind, model, column_name, failures.
    Checks are grouped by model, and each model is read once.
    """
    by_model: dict[str, list[Check]] = {}
    for c in checks:
        by_model.setdefault(c.model, []).append(c)
    return union_all([_model_checks(model(name), group, model)
                      for name, group in by_model.items()])


def words(checks: Iterable[Check]) -> dict[str, set[str]]:
    """Model -> the names that its checks may read."""
    by_model: dict[str, set[str]] = {}
    for c in checks:
        by_model.setdefault(c.model, set()).update(c.words())
        if c.to_model:
            by_model.setdefault(c.to_model, set()).add(c.to_field.lower())
    return by_model


def union_all(parts: list[DataFrame]) -> DataFrame:
    """Union by name as a balanced tree: each union re-analyses its inputs,
    so pairing halves keeps driver-side analysis O(n log n) in the parts."""
    while len(parts) > 1:
        parts = [parts[i].unionByName(parts[i + 1]) if i + 1 < len(parts) else parts[i]
                 for i in range(0, len(parts), 2)]
    return parts[0]


def summarize(results: DataFrame) -> DataFrame:
    return results.select("*", F.when(F.col("failures") == 0, "pass").otherwise("fail").alias("status"))


def freshness(df: DataFrame, source: str, loaded_at: str, as_of_ts: Column,
              warn_after_hours: int, error_after_hours: int) -> DataFrame:
    """Age of the newest row against warn/error thresholds (one row)."""
    return freshness_of(df.agg(F.max(loaded_at).alias("max_loaded_at")), source, as_of_ts,
                        warn_after_hours, error_after_hours)


def freshness_of(newest: DataFrame, source: str, as_of_ts: Column, warn_after_hours: int,
                 error_after_hours: int) -> DataFrame:
    """The same for one row that holds ``max_loaded_at`` already."""
    age = F.timestamp_diff("SECOND", F.col("max_loaded_at"), as_of_ts).cast("double") / F.lit(3600.0)
    status = (F.when(F.col("age_hours") > error_after_hours, "error")
              .when(F.col("age_hours") > warn_after_hours, "warn").otherwise("pass"))
    return (newest.select(F.lit(source).alias("source"), "max_loaded_at", age.alias("age_hours"),
                          F.lit(warn_after_hours).alias("warn_after_hours"),
                          F.lit(error_after_hours).alias("error_after_hours"))
            .select("*", status.alias("status")))
