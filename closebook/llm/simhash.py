"""SimHash near-dedup by meet-in-the-middle ball hashing.

A fingerprint is 64 bits; documents link when their fingerprints differ in at
most ``radius`` bits. Every distinct fingerprint emits all variants within
half the radius; fingerprints that emit the same variant meet after one
shuffle on variants, and their distance is verified.

An odd radius has no whole half. Balls of radius 1 meet up to distance 2, and
emitting the 2,081 variants within radius 2 on one side would write some 33
KB for each fingerprint. So an odd radius takes off one bit first: the 64
bits are cut in ``blocks`` blocks, and the variants are made once with each
block left out. Of ``radius`` differing bits one lies in some block; without
that block at most radius - 1 are left, and the balls of half of that meet.

Distinct fingerprints only take part, so a group of exact copies is one row.
Fingerprints that meet are not paired off: a search from one to its unvisited
neighbours yields a tree of verified links, at most one link a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closebook.llm.common import in_parts, settle, spread_join, text_key
from closebook.llm.components import components

BITS = 64
SEED = 42
TO_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(data: bytes, shingle: int = 3) -> int:
    """Unsigned SimHash of the UTF-8 text's word shingles; 0 without words.
    bytes.split() splits at ASCII white space, which is the word rule."""
    words = data.translate(TO_LOWER).split()
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    h = xxhash.xxh64_intdigest
    hashes = np.array([h(b" ".join(s), SEED)
                       for s in zip(*[words[i:] for i in range(shingle)])], dtype="<u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 4096):
        part = hashes[at:at + 4096]
        bits = np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1,
                             bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > len(hashes)).tolist())


def fingerprint_column(text, shingle: int = 3):
    @F.arrow_udf("long")
    def simhash64(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in in_parts(batches):
            prints = [fingerprint(t, shingle) for t in texts.cast(pa.binary()).to_pylist()]
            yield pa.array(np.array(prints, dtype=np.uint64).view(np.int64))

    return simhash64(F.coalesce(text, F.lit("")))


def _bands(radius: int, blocks: int) -> list[tuple[int, int]]:
    """(first bit, length) of the block that each band leaves out."""
    if radius % 2 == 0:
        return [(0, 0)]
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def variants(prints: np.ndarray, radius: int, blocks: int) -> Iterator[np.ndarray]:
    """For each variant of each band the array of keys, one per fingerprint."""
    for band, (at, length) in enumerate(_bands(radius, blocks)):
        width = BITS - length
        low = np.uint64((1 << at) - 1)
        kept = prints if not length else (prints & low) | (
            (prints >> np.uint64(length)) & ~low & np.uint64((1 << width) - 1))
        if length:  # the free high bits name the band
            kept = kept | np.uint64(band << width)
        for k in range(radius // 2 + 1):
            for flips in combinations(range(width), k):
                yield kept ^ np.uint64(sum(1 << i for i in flips))


def linked(prints: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links (distance <= radius) within a group: each
    search step compares one fingerprint with those not reached yet."""
    links: list[tuple[int, int]] = []
    rest = prints
    while len(rest):
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            here = todo.pop()
            near = np.bitwise_count(rest ^ here) <= radius
            found = rest[near]
            rest = rest[~near]
            links += [(int(here), int(x)) for x in found]
            todo += list(found)
    return links


def fingerprint_links(prints: DataFrame, radius: int = 3, blocks: int = 3) -> DataFrame:
    """(a, b): links that connect whatever fingerprints (column fp, distinct)
    are within ``radius`` bits of each other."""

    def emit(batches):
        for batch in batches:
            col = batch.column(0)
            for at in range(0, len(col), 4096):  # bounds the memory of the variants
                part = col.slice(at, 4096).to_numpy(zero_copy_only=False)
                bits = part.view(np.uint64)
                keys = [v.view(np.int64) for v in variants(bits, radius, blocks)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys)), pa.array(np.tile(part, len(keys)))],
                    ["key", "fp"])

    def meet(batches):
        held = [np.zeros(0, np.int64)] * 2  # the last key may go on in the next batch

        def pairs(keys, prints):
            bits = prints.view(np.uint64)
            cuts = np.flatnonzero(np.diff(keys)) + 1
            starts, ends = np.r_[0, cuts], np.r_[cuts, len(keys)]
            size = ends - starts
            two = starts[size == 2]
            ok = np.bitwise_count(bits[two] ^ bits[two + 1]) <= radius
            a, b = prints[two[ok]], prints[two[ok] + 1]
            more = [x for s, e in zip(starts[size > 2], ends[size > 2])
                    for x in linked(bits[s:e], radius)]
            many = np.array(more, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            both = np.concatenate([np.stack([a, b], axis=1), many])
            both = np.unique(np.sort(both, axis=1), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])],
                                              ["a", "b"])

        for batch in batches:
            keys = np.concatenate([held[0], batch.column(0).to_numpy(zero_copy_only=False)])
            prints = np.concatenate([held[1], batch.column(1).to_numpy(zero_copy_only=False)])
            if not len(keys):
                continue
            last = np.searchsorted(keys, keys[-1])
            held = [keys[last:], prints[last:]]
            if last:
                yield pairs(keys[:last], prints[:last])
        if len(held[0]):
            yield pairs(*held)

    met = (prints.select("fp").mapInArrow(emit, "key long, fp long")
           .repartition("key").sortWithinPartitions("key")
           .mapInArrow(meet, "a long, b long"))
    return met.distinct()


def simhash_groups(docs: DataFrame, shingle: int = 3, radius: int = 3,
                   blocks: int = 3) -> DataFrame:
    """(doc_id, text_key, fp, component_id): one row for each row of ``docs``.

    component_id is the smallest doc_id that can be reached over links. Defined
    cases: a null, empty or blank text has fingerprint zero and links like any
    other; a row without doc_id has a fingerprint and takes the component_id of
    those it links to, null if none of them has an id; repeated rows are one
    fingerprint; a text of any length is read whole, its hashes in memory at 8
    bytes a word; an empty table gives no rows; other columns are not read.
    """
    rows = settle(docs.select("doc_id", text_key(F.col("text")).alias("text_key"),
                              fingerprint_column(F.col("text"), shingle).alias("fp")), "prints")
    prints = rows.groupBy("fp").agg(F.min("doc_id").alias("first"),
                                    F.count(F.lit(1)).alias("n"))
    prints = settle(prints, "fps")
    roots = components(fingerprint_links(prints, radius, blocks))
    placed = settle(prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left"), "placed")
    # Groups of one row are their own component: only the others are looked up.
    grouped = placed.where((F.col("n") > 1) | F.col("root").isNotNull()).select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    firsts = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
    known = spread_join(grouped, firsts, "root", "fp").select(
        "fp", F.col("root").alias("group_fp"), "component_id")
    out = spread_join(rows, settle(known, "known"), "fp", "doc_id")
    return out.select("doc_id", "text_key", "fp",
                      F.when(F.col("group_fp").isNull(), F.col("doc_id"))
                      .otherwise(F.col("component_id")).alias("component_id"),
                      F.coalesce("group_fp", "fp").alias("group_fp"))


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """All columns of ``docs``; of each group the row with the smallest doc_id
    stays (rows without an id come last, then the text's hash decides; of
    repeated rows one stays)."""
    groups = simhash_groups(docs, shingle, radius).select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "group_fp",
        "component_id").where(F.col("_id").eqNullSafe(F.col("component_id")))
    order = F.struct(F.col("_id").isNull().alias("no_id"), "_id", "_key")
    chosen = groups.groupBy("group_fp").agg(F.min(order).alias("o")).select("o._id", "o._key")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("_id"),
                       text_key(F.col("text")).alias("_key"))
    kept = rows.join(chosen.select(F.col("_id").alias("c_id"), F.col("_key").alias("c_key")),
                     F.col("_id").eqNullSafe(F.col("c_id"))
                     & (F.col("_key") == F.col("c_key")), "left_semi")
    # What is left holds one row a group, or repeats of it.
    first = kept.withColumn("_n", F.row_number().over(_by_row()))
    return first.where("_n = 1").select("row.*")


def _by_row():
    from pyspark.sql.window import Window
    return Window.partitionBy("_id", "_key").orderBy("_key")
