"""Language ID by compression: the language whose dictionary compresses best.

Method: each language has a raw-content zstandard dictionary made of labelled
text; a text is compressed in blocks with every dictionary, and the language
with the smallest total is chosen. Where the runner-up is nearly as small the
document is rejected. What is compressed, in dictionaries and texts alike, are
the letters in lower case with one blank for whatever stands between them, so
capitals, digits and punctuation do not count as language.

The fitted model is bounded by two documented parameters: at most
``sample_docs`` labelled documents a language, and ``dict_bytes`` of
dictionary. Sampled are the documents with the smallest random keys; the keys'
cut is found from the count of labelled documents of each language, so picking
them shuffles a few rows only. Classification reads every whole text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from closebook.llm.common import in_parts

UNKNOWN = "und"
NO_LETTERS = re.compile(r"[\W\d_]+")


def letters(text: str) -> bytes:
    return NO_LETTERS.sub(" ", text.lower()).encode()


def fit_dictionaries(labelled: DataFrame, sample_docs: int = 800,
                     dict_bytes: int = 262144, seed: int = 9) -> dict[str, bytes]:
    """{lang: raw dictionary} from rows (text, lang) with lang set; a text that
    is there many times is one.

    Bound: dict_bytes for each distinct lang; what reaches the driver is one
    count, sample_docs lengths and four times dict_bytes a language. Each
    sampled document gives an equal share of its language's dictionary (more,
    where others are shorter), from a place in its text that the hash chooses.
    """
    spark = labelled.sparkSession
    rows = labelled.where(F.col("lang").isNotNull() & (F.length("text") > 0)).select("lang", "text")
    counts = {r["lang"]: r["n"] for r in
              rows.groupBy("lang").agg(F.approx_count_distinct("text").alias("n")).collect()}
    if not counts:
        return {}

    def hashed(number: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(number), "text"), F.lit(1 << 30)) / (1 << 30)

    def smallest(cut: dict[str, tuple], columns: dict[str, Column]) -> DataFrame:
        """``columns`` of the sample_docs smallest keys of each language, where
        ``cut`` has the largest key and the length of a piece."""
        bounds = spark.createDataFrame([(k, *v) for k, v in cut.items()],
                                       "lang string, top double, size int")
        first = Window.partitionBy("lang").orderBy("key", *columns)
        # distinct() combines copies before the shuffle: a hot text is one row a task.
        return (rows.join(F.broadcast(bounds), "lang").withColumn("key", hashed(seed))
                .where(F.col("key") <= F.col("top"))
                .select("lang", "key", *[c.alias(name) for name, c in columns.items()]).distinct()
                .withColumn("n", F.row_number().over(first)).where(F.col("n") <= sample_docs))

    # Twice the expected number of keys, so that fewer than sample_docs is out
    # of the question for a common language; a rare one is taken whole.
    lengths: dict[str, list[tuple[float, int]]] = {}
    for r in smallest({k: (min(1.0, 2 * sample_docs / max(n, 1)), 0) for k, n in counts.items()},
                      {"length": F.length("text")}).toLocalIterator():
        lengths.setdefault(r["lang"], []).append((r["key"], r["length"]))
    cut = {k: (max(v)[0], _level([n for _, n in v], 4 * dict_bytes)) for k, v in lengths.items()}
    size, place = F.col("size"), hashed(seed + 1)
    start = F.floor(place * (F.greatest(F.length("text") - size, F.lit(0)) + 1)).cast("int") + 1
    picked = smallest(cut, {"piece": F.substring(F.col("text"), start, size), "place": place})
    pieces: dict[str, list[tuple[bytes, float]]] = {}
    for r in picked.orderBy("lang", "n").toLocalIterator():
        pieces.setdefault(r["lang"], []).append((letters(r["piece"]), r["place"]))
    return {k: _fill(v, dict_bytes) for k, v in sorted(pieces.items())}


def _level(lengths: list[int], size: int) -> int:
    """The largest length at which pieces of all texts fit in ``size`` together."""
    for i, n in enumerate(sorted(lengths)):
        if n > (share := size // (len(lengths) - i)):
            return max(share, 1)
        size -= n
    return max(lengths)


def _fill(pieces: list[tuple[bytes, float]], size: int) -> bytes:
    """Shares of the pieces, longest possible, that fit in ``size`` together,
    each from its place (0 to 1) in the piece."""
    left, out = size, []
    for i, (p, place) in enumerate(sorted(pieces, key=lambda p: (len(p[0]), p))):
        take = min(len(p), left // (len(pieces) - i))
        at = int(place * (len(p) - take + 1))
        out.append(p[at:at + take])
        left -= take
    return b" ".join(out)[:size]


def classifier(model: dict[str, bytes], block_bytes: int = 2048, level: int = 6,
               min_margin: float = 0.005):
    """Column function text -> struct(lang, score, margin, rejected).

    margin is the runner-up's excess over the smallest size, as a share of the
    runner-up; score is margin / (margin + 0.05), or 1 with one language only.
    """
    langs = sorted(model)
    schema = "struct<lang:string,score:double,margin:double,rejected:boolean>"

    @F.arrow_udf(schema)
    def classify(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        packers = []
        for lang in langs:
            d = zstandard.ZstdCompressionDict(model[lang],
                                              dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            packers.append(zstandard.ZstdCompressor(dict_data=d, write_checksum=False,
                                                    write_content_size=False, write_dict_id=False))

        def sizes(text: str) -> list[int]:
            data = letters(text)
            blocks = [data[i:i + block_bytes] for i in range(0, len(data), block_bytes)]
            return [sum(len(p.compress(b)) for b in blocks) for p in packers]

        for texts in in_parts(batches):
            out_lang, out_score, out_margin, out_reject = [], [], [], []
            for text in texts.to_pylist():
                if not text or not any(map(str.isalpha, text)):
                    lang, score, margin, reject = UNKNOWN, 0.0, 0.0, True
                elif not packers:
                    lang, score, margin, reject = UNKNOWN, 0.0, 0.0, False
                elif len(packers) == 1:
                    lang, score, margin, reject = langs[0], 1.0, 1.0, False
                else:
                    found = sizes(text)
                    order = np.argsort(found, kind="stable")
                    best, second = found[order[0]], found[order[1]]
                    lang, margin = langs[order[0]], (second - best) / second
                    score, reject = margin / (margin + 0.05), margin < min_margin
                out_lang.append(lang)
                out_score.append(float(score))
                out_margin.append(float(margin))
                out_reject.append(bool(reject))
            yield pa.StructArray.from_arrays(
                [pa.array(out_lang, pa.string()), pa.array(out_score, pa.float64()),
                 pa.array(out_margin, pa.float64()), pa.array(out_reject, pa.bool_())],
                ["lang", "score", "margin", "rejected"])

    return classify


def fold(doc_id: Column, folds: int = 3) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def identify_language(docs: DataFrame, model: dict[str, bytes], **params) -> DataFrame:
    """All columns of ``docs`` and lang_pred, score (0 to 1), margin, rejected.

    Defined cases: a text that is null or has no letter is ``und`` with score
    0, rejected; when the model is empty, because no row is labelled, every
    other text is ``und`` with score 0 and not rejected; equal sizes go
    to the first language by name with margin 0, rejected; repeated rows are
    classified alike; a text of any length is compressed whole, in blocks; an
    empty table gives no rows; input columns named as the new ones are replaced.
    """
    made = ("lang_pred", "score", "margin", "rejected")
    own = [c for c in docs.columns if c not in made]
    found = docs.select(F.struct(*own).alias("row"),
                        classifier(model, **params)(F.col("text")).alias("found"))
    return found.select("row.*", F.col("found.lang").alias("lang_pred"), "found.score",
                        "found.margin", "found.rejected")
