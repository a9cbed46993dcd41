"""Queries and the pipeline against plain versions that share no job with them."""

import collections
import hashlib

import duckdb
import pytest
import zstandard
from tokenizers import Tokenizer

import corpus_pipeline
from closebook.llm import langid
from closebook.llm.queries import QUERIES, tokenizer_file
from test_llm_brute import plain_components, plain_licenses, plain_print, rows_of

BLANKS = " \t\n\x0b\x0c\r"


@pytest.fixture(scope="module")
def docs(small_sf):
    return duckdb.sql("SELECT doc_id, text, lang, source FROM "
                      f"'{small_sf}/documents.parquet'").fetchall()


@pytest.fixture(scope="module")
def model(spark, small_sf):
    rows = spark.read.parquet(f"{small_sf}/documents.parquet")
    return langid.fit_dictionaries(rows.where(langid.fold(rows["doc_id"]) != 1))


def plain_letters(text):
    """Lower-case letters, one blank for whatever stands between them."""
    out = []
    for c in text.lower():
        if c.isalnum() and not c.isdecimal():  # a word character, no digit
            out.append(c)
        elif not out or out[-1] != " ":
            out.append(" ")
    return "".join(out).encode()


def plain_language(text, model):
    """(language, margin, rejected): a compressor for each language and block."""
    if not text or not any(c.isalpha() for c in text):
        return "und", 0.0, True
    data, sizes = plain_letters(text), {}
    for lang, raw in model.items():
        d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=6)
        c = zstandard.ZstdCompressor(dict_data=d, write_checksum=False, write_content_size=False,
                                     write_dict_id=False)
        sizes[lang] = sum(len(c.compress(data[i:i + 2048])) for i in range(0, len(data), 2048))
    (best, lang), (second, _) = sorted((n, k) for k, n in sizes.items())[:2]
    return lang, (second - best) / second, (second - best) / second < 0.005


def test_every_language_row(spark, small_sf, docs, model):
    got = rows_of(QUERIES["op9_language_id"](spark, small_sf), "doc_id")
    assert len(got) == len(docs) and len(model) > 2
    for d, text, _, _ in docs:
        lang, margin, rejected = plain_language(text, model)
        r = got[d]
        assert (r["lang_pred"], r["rejected"]) == (lang, rejected), d
        assert r["margin"] == pytest.approx(margin, abs=1e-12)
        assert r["score"] == pytest.approx(margin / (margin + 0.05) if margin else 0.0, abs=1e-12)


def test_every_license_row(spark, small_sf, docs):
    got = rows_of(QUERIES["op7_license_scan"](spark, small_sf), "doc_id")
    for d, text, _, _ in docs:
        assert got[d]["labels"] == ",".join(plain_licenses(text)), d


# ------------------------------------------------------------------- pipeline
def plain_dedup(docs):
    """{doc_id: text} without long lines that five documents share."""
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))
    held = collections.defaultdict(set)
    for d, text, *_ in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 40:
                held[key(line)].add(d)
    gone = {k: max(v) for k, v in held.items() if len(v) >= 5}
    return {d: "\n".join(x for x in (text or "").split("\n")
                         if key(x) not in gone or d == gone[key(x)]) for d, text, *_ in docs}


def plain_mix(docs):
    """{doc_id: copies}: whole documents up to each source's budget."""
    sizes = {d: len([w for w in _words(text)]) for d, text, _ in docs}
    source = {d: s for d, _, s in docs}
    names = sorted(set(source.values()), key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    held = {s: sum(n for d, n in sizes.items() if source[d] == s) for s in names}
    target, free, total = {}, set(names), float(sum(held.values()))
    while True:
        level = (total - sum(target.values())) / (sum(weight[s] for s in free) or 1)
        over = {s for s in free if weight[s] * level > 3 * held[s]}
        if not over:
            break
        target.update({s: 3.0 * held[s] for s in over})
        free -= over
    target.update({s: weight[s] * level for s in free})
    copies = {}
    for s in names:
        budget = int(target[s] + 0.5)
        epochs = min(3, budget // held[s]) if held[s] else 0
        rest, start = budget - epochs * held[s], 0
        for d in sorted((d for d in sizes if source[d] == s),
                        key=lambda d: (hashlib.md5(f"mix:{d}".encode()).hexdigest()[:15], d)):
            part = max(0, min(sizes[d], rest - start))
            copies[d] = epochs + (part > 0 and 2 * part >= sizes[d])
            start += sizes[d]
    return copies


def _words(text):
    word = ""
    for c in (text or "") + " ":
        if c not in BLANKS:
            word += c
        elif word:
            yield word
            word = ""


def test_pipeline_equals_five_plain_stages(spark, small_sf, docs, model):
    kept = [r for r in docs if not plain_language(r[1], model)[2]]
    texts = plain_dedup(kept)
    groups = plain_components({d: plain_print(t) for d, t in texts.items()})
    mixed = plain_mix([(d, texts[d], s) for d, _, _, s in kept if groups[d] == d])
    lib = Tokenizer.from_file(tokenizer_file())
    want = collections.Counter()
    for d, n in mixed.items():
        ids = lib.encode(texts[d], add_special_tokens=False).ids
        want[d, hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
             hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()] = n
    want = +want
    rows = corpus_pipeline.run(spark, small_sf).collect()
    got = collections.Counter((r["doc_id"], r["ids_sha256"], r["decoded_sha256"]) for r in rows)
    assert got == want
    assert len(kept) < len(docs) and sum(n != 1 for n in mixed.values()) > 5
    assert sum(groups[d] != d for d in groups) > 5
    assert any(texts[d] != (t or "") for d, t, _, _ in kept)


# ------------------------------------------------------------ very long texts
def test_texts_of_ten_megabytes(spark):
    """One document of 10 MB beside short ones, whole through four operators."""
    import random

    from closebook.llm import bpe, line_dedup, secrets, simhash
    rng = random.Random(10)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(5000)]
    line = " ".join(rng.choices(words, k=12))  # over 40 characters
    text = "\n".join(" ".join(rng.choices(words, k=14)) for _ in range(115_000))
    text += f"\n{line}\npassword = kX93mQ7vZp2LtR8w"
    assert len(text) > 10_000_000
    rows = [(1, text)] + [(i, line) for i in range(2, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    prints = rows_of(docs.select("doc_id", simhash.fingerprint_column(docs["text"]).alias("fp")), "doc_id")
    assert prints[1]["fp"] % 2 ** 64 == simhash.fingerprint(text.encode())
    assert prints[2]["fp"] % 2 ** 64 == plain_print(line)
    found = rows_of(secrets.scan_secrets(docs), "doc_id")[1]["found"]
    assert [(s["kind"], text[s["start"]:s["end"]]) for s in found] == [
        ("assign", "password = kX93mQ7vZp2LtR8w"), ("guess", "kX93mQ7vZp2LtR8w")]
    kept = rows_of(line_dedup.dedup_lines(docs), "doc_id")
    assert kept[1]["n_lines"] == 115_002 and kept[1]["n_dropped"] == 1
    assert kept[1]["text"] == text.replace(f"\n{line}\n", "\n") and kept[6]["text"] == line
    model = {"a": " ".join(words[:2000]).encode(), "b": b"qrst uvwx yz " * 500}
    assert rows_of(langid.identify_language(docs, model), "doc_id")[1]["lang_pred"] == "a"
    path, part = tokenizer_file(), text[:1_000_000]  # whole too, but a tenth is quicker
    docs = spark.createDataFrame([(1, part)], "doc_id long, text string")
    coded = rows_of(bpe.decode_documents(bpe.encode_documents(docs, path), path), "doc_id")[1]
    assert coded["decoded"] == part
    assert list(coded["ids"]) == Tokenizer.from_file(path).encode(part, add_special_tokens=False).ids
