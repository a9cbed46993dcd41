"""The registered queries: each applies one operator to its whole table with
production parameters and derives the columns of its contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from closebook.llm import ann, bpe, exact_topk, langid, line_dedup, license_scan, mixing
from closebook.llm import secrets as secret_scan
from closebook.llm import prefix_trie, simhash, subspace_join, token_rollup, turn_repair
from closebook.llm.common import n_words, scratch_path, settle, table


def tokenizer_file() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = exact_topk.quantized(table(spark, sf_dir, "embeddings"))
    return exact_topk.exact_top_k(vectors, F.col("vec_id") % 50 == 0, k=5)


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(table(spark, sf_dir, "documents"), shingle=3, radius=3)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                         "component_id")


def op3_vp_tree_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = ann.directions(table(spark, sf_dir, "embeddings"))
    return ann.nearest(vectors, F.col("vec_id") % 20 == 0, k=20)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(encoded_and_decoded(docs))


def encoded_and_decoded(docs: DataFrame) -> DataFrame:
    path = tokenizer_file()
    return bpe.decode_documents(bpe.encode_documents(docs, path), path)


def digests(rows: DataFrame, *more: str) -> DataFrame:
    ids = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return rows.select("doc_id", *more, "n_tokens", F.sha2(ids, 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    words = secret_scan.vocabulary(tokenizer_file())
    found = secret_scan.scan_secrets(docs, more_words=words).select("doc_id", "found")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("found", lambda s: s["kind"] != "guess")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in secret_scan.KINDS],
                        F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("found")).alias("spans"))


def op6_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token totals of the corpus after four batches of changes: all documents
    come in under tokenizer ``words-1``; exact copies go again (all but the
    smallest doc_id of a text); the counts of documents with surplus blanks
    are revised to the counts without; and what is left is counted under
    ``pieces-2``. Each batch is committed twice, as after a retry;
    the first two are compacted."""
    docs = settle(table(spark, sf_dir, "documents").select(
        "doc_id", "source", "lang", n_words(F.col("text")).alias("words"),
        F.coalesce(F.regexp_count("text", F.lit(PIECES)), F.lit(0)).cast("long").alias("pieces"),
        F.coalesce(F.regexp_count("text", F.lit(LONG_WORDS)), F.lit(0)).cast("long").alias("long"),
        F.md5(F.coalesce("text", F.lit(""))).alias("digest")), "counts")
    firsts = docs.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    copied = firsts.where("n > 1").select(F.col("digest").alias("of"), "first")
    # Copies of one text may be a third of all rows: spread by doc_id.
    return _replayed(spark, docs, copied)


# Runs of letters, runs of digits, and any other character but white space.
PIECES = r"[A-Za-z\x{80}-\x{10FFFF}]+|[0-9]+|[^A-Za-z0-9\x{80}-\x{10FFFF}\x20\x09-\x0D]"
LONG_WORDS = r"[^\x20\x09-\x0D]{25,}"


def _replayed(spark: SparkSession, docs: DataFrame, copied: DataFrame) -> DataFrame:
    from closebook.llm.common import spread_join
    marked = settle(spread_join(docs, copied.withColumnRenamed("of", "digest"), "digest",
                                "doc_id").withColumn(
        "gone", F.coalesce(F.col("doc_id") != F.col("first"), F.lit(False))).select(
        "source", "lang", "words", "pieces", "long", "gone"), "marked")
    left = marked.where(~F.col("gone"))
    rollup = token_rollup.TokenRollup(spark, scratch_path(spark, "rollup"))
    batches = {
        "0001-ingest": token_rollup.inserted(marked, "words", "words-1"),
        "0002-copies": token_rollup.deleted(marked.where("gone"), "words", "words-1"),
        # words-1 had counted over-long words, which are no tokens, as well
        "0003-revise": token_rollup.revised(left.where("long > 0"), "words",
                                            F.col("words") - F.col("long"), "words-1"),
        "0004-pieces": token_rollup.inserted(left, "pieces", "pieces-2"),
    }
    for batch_id, changes in batches.items():
        rollup.commit(batch_id, changes)
        rollup.commit(batch_id, changes)  # a retry adds nothing
        if batch_id == "0002-copies":
            rollup.compact()
    return rollup.totals().select("source", "lang", "tokenizer", "n_docs", "n_tokens")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    at = F.transform("places", lambda p: p["at"].cast("long"))
    base = F.array_join(F.array_sort(F.array_distinct(F.transform(
        "places", lambda p: p["label"]))), ",")
    share = F.array_max(F.transform("matches", lambda m: m["share"]))
    return license_scan.scan_licenses(docs).select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(at).alias("first_word"), F.array_max(at).alias("last_word"),
        base.alias("base_labels"), F.array_join("labels", ",").alias("labels"),
        F.coalesce(share, F.lit(0.0)).alias("score"))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = table(spark, sf_dir, "documents").select(
        "doc_id", "source", n_words(F.col("text")).alias("size"))
    return mixing.mix_sources(settle(sized, "sizes")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identified(docs).select(
        "doc_id", F.coalesce(langid.fold(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"),
        "lang_pred", "score", "margin", "rejected")


def identified(docs: DataFrame) -> DataFrame:
    """Dictionaries of the documents that are not held out, applied to all."""
    learned = docs.where(langid.fold(F.col("doc_id")) != 1)
    return langid.identify_language(docs, langid.fit_dictionaries(learned))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subspace_join.near_duplicates(table(spark, sf_dir, "embeddings"), min_cosine=0.93)


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = damaged(table(spark, sf_dir, "conversations"))
    return turn_repair.repair_conversations(rows, F.col("damage") != 0)


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with one of five damages each, or none: 0 dropped (the row
    stays to name its conversation), 1 emptied, 2 without ``.!?``, 3 twice, 4
    from the user."""
    def spaced(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    damage = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % 20
    text = spaced("text")
    rows = conversations.select(
        "conv_id", "turn", damage.alias("damage"),
        F.when(damage == 4, "user").otherwise(spaced("role")).alias("role"),
        F.when(damage == 1, "").when(damage == 2, F.translate(text, ".!?", ""))
        .otherwise(text).alias("text"))
    return rows.select("*", F.explode(F.when(F.col("damage") == 3, F.array(F.lit(1), F.lit(2)))
                                      .otherwise(F.array(F.lit(1)))).alias("copy")).drop("copy")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(rebuilt(table(spark, sf_dir, "conversations")))


HEAD = 6  # conversations take over fewer turns than this


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Turns of the rebuilt conversations: h turns of the first conversation of
    its hundred, then its own after the first h. pos 0 names every
    conversation. Each joins five rows of its hundred's first at most."""
    turns = settle(prefix_trie.hashed_turns(conversations), "turns")
    h = F.crc32(F.col("conv_id").cast("string")) % HEAD
    base = F.col("conv_id") - F.col("conv_id") % 100
    heads = turns.where((base == F.col("conv_id")) & (F.col("pos") < HEAD)).select(
        F.col("conv_id").alias("base"), "pos", "a", "b", "chars")
    each = turns.where("pos = 1").select("conv_id", base.alias("base"), h.alias("h"))
    taken = each.join(heads, "base").where(F.col("pos") <= F.col("h")).select(turns.columns)
    names = turns.where("pos = 1").withColumn("pos", F.lit(0).cast("long"))
    return turns.where(F.col("pos") > h).union(taken).union(names)


QUERIES = {f.__name__: f for f in (
    op1_exact_topk, op2_simhash_dedup, op3_vp_tree_ann, op4_bpe, op5_secret_scan,
    op6_token_rollup, op7_license_scan, op8_mix_sources, op9_language_id, op10_line_dedup,
    op11_embedding_dedup, op12_turn_repair, op13_prefix_trie)}
