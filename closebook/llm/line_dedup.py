"""Line dedup: drop long lines that many documents share.

Method: explode the normalised lines with their positions, hash them, count
the distinct documents of each hash, drop the lines over the threshold and
reassemble the text by position.

A line's key is the line without ASCII white space at both ends and with A-Z
in lower case. Keys of at least ``min_chars`` code points found in at least
``min_docs`` documents lose all their lines, except in the largest ``doc_id``
that holds the key. Keys are compared by 128 hash bits.

Skew: the documents of a key are counted in ``buckets`` parts first, and the
verdict travels back along the same parts, so a line that a third of all
documents hold never meets in one task. Only hashes, ids and positions of
lines that are long enough are shuffled, and each text once, by its id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closebook.llm.common import SPACES, lower_ascii, settle, text_key


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def repeated_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5,
                   buckets: int = 256) -> DataFrame:
    """(doc_id, text_key, positions): the lines to drop of each document."""
    key = lower_ascii(F.btrim(F.col("line"), F.lit(SPACES)))
    lines = (docs.where(F.col("doc_id").isNotNull())
             .select("doc_id", text_key(F.col("text")).alias("text_key"),
                     F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
             .withColumn("key", key)
             .where(F.length("key") >= min_chars)
             .select("doc_id", "text_key", "pos", F.xxhash64("key").alias("h1"),
                     F.xxhash64(F.lit(1), "key").alias("h2"),
                     F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("int").alias("part")))
    lines = settle(lines, "lines")
    parts = lines.groupBy("h1", "h2", "part").agg(F.count_distinct("doc_id").alias("n"),
                                                 F.max("doc_id").alias("last"))
    shared = (parts.groupBy("h1", "h2")
              .agg(F.sum("n").alias("n_docs"), F.max("last").alias("keeper"))
              .where(F.col("n_docs") >= min_docs))
    verdict = parts.select("h1", "h2", "part").join(shared, ["h1", "h2"])
    return (lines.join(verdict, ["h1", "h2", "part"])
            .where(F.col("doc_id") < F.col("keeper"))
            .groupBy("doc_id", "text_key")
            .agg(F.sort_array(F.collect_set("pos")).alias("positions")))


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5,
                buckets: int = 256) -> DataFrame:
    """All columns of ``docs`` with ``text`` reassembled from the lines that
    stay, and n_lines (before dropping), n_dropped.

    Defined cases: a null or empty text is one empty line and comes back
    empty; rows without doc_id keep all their lines and are not counted; rows
    that repeat a doc_id count as one document, and each row loses the lines
    of its own text; an empty table gives no rows; input columns named
    n_lines or n_dropped are replaced, all others pass.
    """
    drops = repeated_lines(docs, min_chars, min_docs, buckets).select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "positions")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("_id"),
                       text_key(F.col("text")).alias("_key"))
    lines = _lines(F.col("row.text"))
    # The kept text is what lies between two dropped positions.
    starts = F.concat(F.array(F.lit(-1)), F.col("positions"))
    ends = F.concat(F.col("positions"), F.array(F.size("lines")))
    kept = F.array_join(F.flatten(F.zip_with(
        starts, ends, lambda s, e: F.slice(F.col("lines"), s + 2, e - s - 1))), "\n")
    joined = (rows.join(drops, ["_id", "_key"], "left")
              .withColumn("n_lines", F.size(lines).cast("long"))
              .withColumn("n_dropped", F.coalesce(F.size("positions"), F.lit(0)).cast("long"))
              .withColumn("lines", F.when(F.col("positions").isNotNull(), lines)))
    text = F.when(F.col("positions").isNull(), F.coalesce(F.col("row.text"), F.lit(""))) \
        .otherwise(kept)
    out = joined.select("row", F.struct(text.alias("text"), "n_lines", "n_dropped").alias("out"))
    own = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return out.select(*[F.col("out.text") if c == "text" else F.col("row")[c].alias(c)
                        for c in own], "out.n_lines", "out.n_dropped")
