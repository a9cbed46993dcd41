"""Exact distinct counts that add up: bitmaps over numbered keys.

A key's number is its bit. Keys are numbered once and the numbers stored, so a
bitmap made today and one made next month mean the same keys. Rows of a group
become bitmaps of 32,768 bits (``bitmap_construct_agg``, from the map side up),
one for each range of numbers that occurs; coarser groups are the union of finer
ones (``bitmap_or_agg``), so a stored table of bitmaps answers distinct counts by
any of its columns without the rows, which plain distinct counts cannot be added
up to.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def numbered(rows: DataFrame, key: str) -> DataFrame:
    """(key, number): the distinct keys, numbered from 1, dense within each
    partition. Store it before use: another run may number anew."""
    keys = rows.where(F.col(key).isNotNull()).select(key).distinct()
    return keys.withColumn("number", F.monotonically_increasing_id() + 1)


def key_bitmaps(rows: DataFrame, groups: Sequence[str], number: str = "number") -> DataFrame:
    """(groups, bucket, bitmap): the numbers present in each group."""
    return rows.groupBy(*groups, F.bitmap_bucket_number(number).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bitmap"))


def distinct_counts(bitmaps: DataFrame, groups: Sequence[str], name: str) -> DataFrame:
    """(groups, name): distinct keys by some of the bitmaps' columns."""
    merged = bitmaps.groupBy(*groups, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return merged.groupBy(*groups).agg(F.sum(F.bitmap_count("bitmap")).alias(name))
