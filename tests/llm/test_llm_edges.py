"""Odd tables: nulls everywhere, empty and very long texts, repeated rows, ties,
empty tables, and extra columns named like the operators' own."""

import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from closebook.llm import (ann, bpe, exact_topk, langid, license_scan, line_dedup, mixing,
                           secrets, simhash, token_rollup)
from closebook.llm.common import n_words, scratch_path
from closebook.llm.queries import tokenizer_file

LONG_LINE = "This line is shared by a good many documents of the table"
CLASHES = ("row", "rank", "score", "key", "size", "label", "words", "line", "pos", "part", "n",
           "found", "taken", "target", "ids", "margin", "component_id", "fp", "positions", "lines",
           "n_lines", "_id", "_key", "skey", "range", "places", "decoded")
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          + ", ".join(f"`{c}` string" for c in CLASHES))
BODY = [
    (1, None, None, None), (2, "", "en", "a"), (3, "   \n\t ", None, "a"), (None, "x y z", "en", "b"),
    (4, f"{LONG_LINE}\nown words of four stand here", "en", "a"),
    (5, f"  {LONG_LINE.upper()}\t\nsomething else stands in five", "en", None),
    (6, f"{LONG_LINE}\n{LONG_LINE}\nsix has it twice, and more", "de", "b"),
    (7, f"seven\n{LONG_LINE}", "de", "b"), (8, f"{LONG_LINE}\n", "fr", "c"),
    (8, f"{LONG_LINE}\n", "fr", "c"), (9, "one two three", "en", "a"),
    (9, "another text under the same id", "en", "a"), (10, "one two three", "en", "d"),
    (11, "licensed under cc by nc 4 0 " + "word " * 150_000, "en", "a"),
    (12, "a" * 200_000, "en", "c"), (13, "MIT License; password = 'aB3dE5fG7hJ9kLmN'", "en", "c"),
    (None, None, None, None), (14, "😀 日本 \x00 é", None, ""),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(d, t, x, s, len(t or "")) + tuple("clash" for _ in CLASHES) for d, t, x, s in BODY]
    return spark.createDataFrame(rows, SCHEMA)


def same_columns(got, docs, *made):
    """Own columns pass with their values; the new ones are there once."""
    assert len(set(got.columns)) == len(got.columns) and set(made) <= set(got.columns)
    assert set(docs.columns) - set(made) <= set(got.columns)
    rows = got.collect()
    for c in set(CLASHES) - set(made):
        assert {r[c] for r in rows} == {"clash"}
    return rows


def test_line_dedup(docs):
    rows = same_columns(line_dedup.dedup_lines(docs), docs, "n_lines", "n_dropped", "text")
    assert len(rows) == len(BODY)
    got = {(r["doc_id"], r["n_lines"]): r for r in rows}
    assert got[4, 2]["text"] == "own words of four stand here" and got[4, 2]["n_dropped"] == 1
    assert got[5, 2]["text"] == "something else stands in five"
    assert got[6, 3]["text"] == "six has it twice, and more" and got[6, 3]["n_dropped"] == 2
    assert got[7, 2]["text"] == "seven"
    assert got[8, 2]["text"] == f"{LONG_LINE}\n" and got[8, 2]["n_dropped"] == 0
    assert got[1, 1]["text"] == "" and got[2, 1]["text"] == ""


def test_line_dedup_bounds(spark):
    line = "x" * 40
    rows = [(i, line) for i in range(5)] + [(i, "y" * 39) for i in range(10, 20)] + [
        (i, "z" * 41) for i in range(30, 34)] + [(33, "z" * 41)]
    got = {r["doc_id"]: r["n_dropped"] for r in
           line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {d for d, n in got.items() if n} == {0, 1, 2, 3}


def test_simhash(docs):
    rows = simhash.simhash_groups(docs).collect()
    assert len(rows) == len(BODY)
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert {r["fp"] for i in (1, 2, 3) for r in by[i]} == {0}
    assert {r["component_id"] for i in (1, 2, 3) for r in by[i]} == {1}
    assert {r["component_id"] for r in by[None]} == {None, 1}
    assert by[10][0]["component_id"] == 9 and {r["component_id"] for r in by[8]} == {8}
    kept = simhash.drop_near_duplicates(docs)
    left = same_columns(kept, docs)
    ids = sorted((r["doc_id"] or 0, r["text"] or "") for r in left)
    assert len([i for i, _ in ids if i == 8]) == 1 and len([i for i, _ in ids if i == 9]) == 2
    assert not {2, 3, 10} & {i for i, _ in ids}
    assert (0, "x y z") in ids  # a group without any id keeps one row


def test_mixing(docs):
    sized = docs.withColumn("size", n_words(F.col("text")))
    rows = same_columns(mixing.mix_sources(sized), docs, "size", "source_size", "target", "taken",
                        "copies")
    assert len(rows) == len(BODY)
    total = sum(r["size"] for r in rows)
    assert sum(r["taken"] for r in rows) == pytest.approx(total, abs=len(BODY))
    held, taken = {}, {}
    for r in rows:
        held[r["source"]] = held.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"] and 0 <= r["copies"] <= 3
    for r in rows:
        assert r["source_size"] == held[r["source"]]
        assert abs(taken[r["source"]] - r["target"]) <= 0.5


def test_mixing_without_words(spark):
    df = spark.createDataFrame([(1, "a", 0), (2, None, None), (3, "b", -4)],
                               "doc_id long, source string, size long")
    assert {(r["taken"], r["target"]) for r in mixing.mix_sources(df).collect()} == {(0, 0.0)}


def test_row_operators(docs, spark):
    path = tokenizer_file()
    rows = same_columns(bpe.encode_documents(docs, path), docs, "ids", "n_tokens")
    assert all(r["ids"] == [] for r in rows if not r["text"]) and len(rows) == len(BODY)
    back = bpe.decode_documents(bpe.encode_documents(docs.drop("decoded"), path), path)
    assert all(r["decoded"] == (r["text"] or "") for r in back.collect())
    rows = same_columns(secrets.scan_secrets(docs), docs, "found")
    assert {r["doc_id"] for r in rows if r["found"]} == {12, 13}
    rows = same_columns(license_scan.scan_licenses(docs), docs, "n_words", "places", "matches",
                        "labels")
    assert {r["doc_id"]: r["labels"] for r in rows if r["labels"]} == {11: ["cc-by-nc"], 13: ["mit"]}
    labelled = docs.where(F.col("lang").isNotNull())
    model = langid.fit_dictionaries(labelled, 3, 300)
    assert set(model) == {"en", "de", "fr"} and all(len(v) <= 300 for v in model.values())
    rows = same_columns(langid.identify_language(docs, model), docs, "lang_pred", "score", "margin",
                        "rejected")
    assert {r["lang_pred"] for r in rows if not (r["text"] or "").strip()} == {"und"}
    assert {r["lang_pred"] for r in rows if (r["text"] or "").strip()} <= {"en", "de", "fr"}


def test_no_labelled_rows(docs):
    assert langid.fit_dictionaries(docs.where("lang = 'none'")) == {}


NAN = float("nan")
VECTORS = [(0, [1.0, 0.5]), (0, [1.0, 0.5]), (1, None), (2, [1.0, None]), (3, [NAN, 1.0]),
           (4, [float("inf"), 1.0]), (5, [0.0, 0.0]), (6, []), (None, [1.0, 1.0]), (7, [1.0, 1.0]),
           (8, [1.0, 1.0]), (9, [1.0, 1.0, 1.0]), (50, [-0.5, 0.25]), (100, [1.0, 1.0, 2.0])]


def test_vector_searches(spark):
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in VECTORS],
                               "vec_id long, embedding array<float>, rank string, score string")
    got = sorted(map(tuple, exact_topk.exact_top_k(
        exact_topk.quantized(df), F.col("vec_id") % 50 == 0, 2).collect()))
    full, half = 256 * 256, 128 * 256
    assert got == [(0, 1, 7, full + half), (0, 2, 8, full + half),
                   (50, 1, 5, 0), (50, 2, 7, -128 * 256 + 64 * 256), (100, 1, 9, 4 * full)]
    got = sorted(map(tuple, ann.nearest(ann.directions(df), F.col("vec_id") % 50 == 0, 3).collect()))
    assert got == [(0, 1, 7, 1.5), (0, 2, 8, 1.5), (0, 3, 50, -0.375), (50, 1, 7, -0.25),
                   (50, 2, 8, -0.25), (50, 3, 0, -0.375), (100, 1, 9, 4.0)]


def test_rollup(spark, docs):
    rollup = token_rollup.TokenRollup(spark, scratch_path(spark, "test"))
    assert rollup.totals().collect() == [] and rollup.batches() == []
    counted = docs.withColumn("tokens", n_words(F.col("text")))
    assert rollup.commit("a", token_rollup.inserted(counted, "tokens", "v1"))
    before = sorted(map(repr, rollup.totals().collect()))
    assert not rollup.commit("a", token_rollup.inserted(counted, "tokens", "v1"))
    assert sorted(map(repr, rollup.totals().collect())) == before
    # A failed attempt has no name: it is not read, and the next one counts.
    part = token_rollup.inserted(counted, "tokens", "v1")
    with pytest.raises(Exception):
        rollup.commit("b", part.withColumn("tokens", F.raise_error(F.lit("lost")).cast("long")))
    assert rollup.batches() == ["a"] and sorted(map(repr, rollup.totals().collect())) == before
    assert rollup.commit("b", token_rollup.deleted(counted.where("source = 'a'"), "tokens", "v1"))
    assert rollup.commit("empty", part.limit(0))
    left = {(r["source"], r["lang"]): r for r in rollup.totals().collect()}
    assert not [k for k in left if k[0] == "a"] and left[None, None]["n_docs"] == 2
    assert rollup.commit("c", token_rollup.revised(counted.where("source = 'c'"), "tokens",
                                                   F.col("tokens") + 1, "v1"))
    after = {(r["source"], r["lang"]): r for r in rollup.totals().collect()}
    for k, r in after.items():
        grown = r["n_docs"] if k[0] == "c" else 0
        assert r["n_tokens"] == left[k]["n_tokens"] + grown and r["n_docs"] == left[k]["n_docs"]
    with pytest.raises(ValueError):
        rollup.commit("../x", part)
    # Compacted, the batches are one base; their ids still count as committed.
    told = sorted(map(repr, rollup.totals().collect()))
    assert rollup.compact() and not rollup.compact()
    assert rollup._names("batch=*") == [] and rollup.batches() == ["a", "b", "c", "empty"]
    assert sorted(map(repr, rollup.totals().collect())) == told
    assert not rollup.commit("c", part) and rollup.commit("d", part) and rollup.compact()
    assert rollup.batches() == ["a", "b", "c", "d", "empty"]
    assert rollup.commit("e", token_rollup.deleted(counted, "tokens", "v1"))
    assert sorted(map(repr, rollup.totals().drop("n_changes").collect())) == sorted(
        repr(r) for r in spark.createDataFrame([t for t in after.values()], rollup.totals().schema)
        .where("n_docs <> 0 OR n_tokens <> 0").drop("n_changes").collect())


def test_one_of_two_writers_of_a_batch_counts(spark, docs):
    from concurrent.futures import ThreadPoolExecutor
    rollup = token_rollup.TokenRollup(spark, scratch_path(spark, "test"))
    changes = token_rollup.inserted(docs.withColumn("tokens", F.lit(1)), "tokens", "v1")

    class Late(token_rollup.TokenRollup):
        def batches(self):  # neither sees the other's batch before both have written
            return []

    with ThreadPoolExecutor(4) as pool:
        won = list(pool.map(lambda _: Late(spark, rollup.path).commit("x", changes), range(4)))
    assert sorted(won) == [False, False, False, True]
    assert sum(r["n_docs"] for r in rollup.totals().collect()) == len(BODY)
    assert rollup.batches() == ["x"]


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    path = tokenizer_file()
    for out in (line_dedup.dedup_lines(none), simhash.simhash_groups(none),
                simhash.drop_near_duplicates(none),
                mixing.mix_sources(none.withColumn("size", F.lit(1))),
                bpe.decode_documents(bpe.encode_documents(none, path), path),
                secrets.scan_secrets(none), license_scan.scan_licenses(none),
                langid.identify_language(none, langid.fit_dictionaries(none))):
        assert out.collect() == []
    v = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert exact_topk.exact_top_k(exact_topk.quantized(v), F.col("vec_id") % 50 == 0).collect() == []
    assert ann.nearest(ann.directions(v), F.col("vec_id") % 50 == 0).collect() == []


def test_pipeline_stages_on_odd_rows(spark, docs):
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        for given in (now, now.limit(0)):
            out = stage(spark, given, "")
            if name != "bpe_tokens":
                assert out.schema.simpleString() == docs.schema.simpleString()
            out.collect()
        now = stage(spark, now, "")


def test_pipeline_runs(spark, small_sf):
    rows = corpus_pipeline.run(spark, small_sf).collect()
    assert rows and all(len(r["ids"]) == r["n_tokens"] for r in rows)
    for r in rows[:20]:
        text = ",".join(map(str, r["ids"]))
        assert r["ids_sha256"] == hashlib.sha256(text.encode()).hexdigest()
