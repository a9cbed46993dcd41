"""From raw documents to token ids in five stages, each one operator.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor
kept and returns a DataFrame; all but the last return the columns of
``documents``. ``run`` writes each stage as Parquet to the shared checkpoint
folder and reads it back, so a lost executor costs no finished stage.

Defined cases: texts that are null, empty or without a letter are rejected by the
first stage; a null source is a source, null ids stay rows of their own but for near
duplicates, of which one without an id comes last; equal rows are near duplicates, one
stays; texts of any length pass whole; an empty table goes through empty; further
columns, whatever their names, pass all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from closebook.llm import line_dedup, mixing, queries, simhash
from closebook.llm.common import discard, n_words, settle, table


def _with(docs: DataFrame, *columns: str) -> DataFrame:
    """The whole row in one column, which no operator's own columns touch."""
    return docs.select(F.struct(*docs.columns).alias("doc"), "doc_id", "text", *columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that language ID rejects."""
    return queries.identified(_with(docs, "lang")).where(~F.col("rejected")).select("doc.*")


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes lines that many documents share out of the texts."""
    out = line_dedup.dedup_lines(_with(docs))
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return out.select(*[new.get(c, F.col("doc")[c]).alias(c) for c in docs.columns])


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates."""
    return simhash.drop_near_duplicates(docs, shingle=3, radius=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out whole documents until each source is at its target."""
    rows = _with(docs, "source").withColumn("size", n_words(F.col("text"))).drop("text")
    mixed = mixing.mix_sources(rows).where(F.col("copies") > 0)
    return mixed.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc.*")


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with the digests of ids and decoded text."""
    rows = queries.encoded_and_decoded(docs.select("doc_id", "source", "lang", "text"))
    return queries.digests(rows, "source", "lang", "ids")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("simhash_dedup", simhash_dedup),
    ("mix_sources", mix_sources),
    ("bpe_tokens", bpe_tokens),
]

# Fingerprints, compression and BPE are beyond SQL; tests/llm runs plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
        if before is not None:
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
