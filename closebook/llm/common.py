"""Helpers shared by the operators: text normal forms, row keys, stored steps."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from closebook.session import drop_folder, scratch_folder, settle  # noqa: F401

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
SPACES = " \t\n\x0b\x0c\r"
#: A run of anything but ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, every other character as it is. A text that is ASCII
    throughout takes the faster built-in path; the result is the same."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER))


def n_words(text: Column) -> Column:
    """Number of runs of non-space characters; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def text_key(text: Column) -> Column:
    """Tells apart rows that share an id but not a text."""
    return F.xxhash64(F.coalesce(text, F.lit("")), text.isNull())


def in_parts(batches: Iterator[pa.Array], rows: int = 256) -> Iterator[pa.Array]:
    """The batches of a column function in short slices, which bounds what
    Python holds of long texts at a time."""
    for batch in batches:
        yield from (batch.slice(i, rows) for i in range(0, len(batch), rows))


def short_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Lower the session's rows per Arrow batch to ``rows``, if there are more.
    Spark holds a batch of texts and of results on both sides of each task and
    column function; the setting is read when the job runs, so it stays set."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


#: A new path under the shared checkpoint folder; gone with the caller's scope.
scratch_path = scratch_folder


def discard(df: DataFrame) -> None:
    """Delete the files of a table made by ``settle`` that nothing reads any more."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/closebook-" in folder:
            drop_folder(df.sparkSession, folder)


def spread_join(left: DataFrame, right: DataFrame, key: str, spread_by: str, how: str = "left",
                salts: int = 32) -> DataFrame:
    """Join with ``right``, which has one row per key, where one key may hold
    a third of the left rows: those are spread over ``salts`` tasks by the
    hash of another column, and the right rows are repeated for each."""
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [key, "_salt"], how).drop("_salt")
