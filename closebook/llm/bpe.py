"""Byte-level BPE encoding and decoding with a given vocabulary file.

Method: a piece of text is a doubly linked list of symbols; a priority queue
holds the merge rank of each adjacent pair; the lowest rank merges first, the
leftmost of equal ones; entries whose pair has changed meanwhile are stale and
skipped. Decoding joins the vocabulary's byte strings.

The vocabulary file is read on the driver, by a path that the caller names,
and broadcast: its size does not depend on the data. A worker keeps the ids of
up to ``CACHE`` pieces that it has met.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from closebook.llm.common import in_parts, short_batches

# The pattern that cuts text for byte-level BPE.
PIECES = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
          r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
CACHE = 300_000
PAIR, PLACE = 24, 40  # bits of a symbol id, of a place in a text
LAST_PLACE = (1 << PLACE) - 1


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in the vocabulary:
    itself where printable, else the next code point from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = iter(range(256, 512))
    return {b: chr(b if b in plain else next(other)) for b in range(256)}


@dataclass
class Vocabulary:
    tokens: list[bytes]  # by id
    byte_ids: list[int]  # id of each single byte
    ranks: dict[int, int]  # pair (a << PAIR | b) -> rank
    merged: list[int]  # id by rank
    added: dict[str, int]  # strings that are tokens wherever they stand


def load_vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    ids, alphabet = spec["model"]["vocab"], byte_alphabet()
    back = {c: b for b, c in alphabet.items()}
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    tokens = [b""] * (1 + max([*ids.values(), *added.values()]))
    for text, i in ids.items():
        tokens[i] = bytes(back[c] for c in text)
    for text, i in added.items():
        tokens[i] = text.encode()
    pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
    ranks = {ids[a] << PAIR | ids[b]: rank for rank, (a, b) in enumerate(pairs)}
    return Vocabulary(tokens, [ids[alphabet[b]] for b in range(256)], ranks,
                      [ids[a + b] for a, b in pairs], added)


def merge_symbols(symbols: list[int], ranks: dict[int, int], merged: list[int]) -> list[int]:
    """Apply the merges in the order of rank, then of place. ``ranks`` has the
    rank of a pair (a << PAIR | b), ``merged`` the id that each rank makes."""
    n, rank = len(symbols), ranks.get
    here = [rank(a << PAIR | b, -1) for a, b in zip(symbols, symbols[1:])]
    queue = [r << PLACE | i for i, r in enumerate(here) if r >= 0]
    if not queue:
        return symbols
    heapify(queue)
    here.append(-1)  # here[i]: rank of the pair that starts at i now
    sym, after, before = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1))
    while queue:
        entry = heappop(queue)
        i = entry & LAST_PLACE
        if here[i] != entry >> PLACE:
            continue  # stale: one of the two symbols has merged elsewhere
        j = after[i]
        new = sym[i] = merged[here[i]]
        sym[j] = here[j] = here[i] = -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            r = here[i] = rank(new << PAIR | sym[k], -1)
            if r >= 0:
                heappush(queue, r << PLACE | i)
        h = before[i]
        if h >= 0:
            r = here[h] = rank(sym[h] << PAIR | new, -1)
            if r >= 0:
                heappush(queue, r << PLACE | h)
    return [s for s in sym if s >= 0]


class Encoder(dict):
    """Text to ids as int32 bytes; maps a piece to its ids."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary
        self.split = regex.compile(PIECES).findall
        names = sorted(vocabulary.added, key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, names))) if names else None

    def __missing__(self, piece: str) -> bytes:
        v = self.vocabulary
        ids = merge_symbols(list(map(v.byte_ids.__getitem__, piece.encode())), v.ranks, v.merged)
        if len(self) >= CACHE:
            self.clear()
        self[piece] = out = array("i", ids).tobytes()
        return out

    def encode(self, text: str) -> bytes:
        out, at = [], 0
        for m in self.added.finditer(text) if self.added else ():
            out += map(self.__getitem__, self.split(text, at, m.start()))
            out.append(np.int32(self.vocabulary.added[m[0]]).tobytes())
            at = m.end()
        out += map(self.__getitem__, self.split(text, at))
        return b"".join(out)


def encoder_column(spark: SparkSession, vocabulary: Vocabulary):
    short_batches(spark)
    shared = spark.sparkContext.broadcast(vocabulary.__dict__)

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(Vocabulary(**shared.value))
        for texts in in_parts(batches):
            ids = [encoder.encode(t or "") for t in texts.to_pylist()]
            ends = np.cumsum([0, *map(len, ids)]) // 4
            flat = np.frombuffer(b"".join(ids), dtype=np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))

    return encode


def decoder_column(spark: SparkSession, vocabulary: Vocabulary):
    short_batches(spark)
    shared = spark.sparkContext.broadcast(vocabulary.tokens)

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        token = shared.value.__getitem__
        for lists in in_parts(batches):
            yield pa.array([b"".join(map(token, ids or ())).decode("utf-8", "replace")
                            for ids in (x.values.to_numpy().tolist() if x.is_valid else ()
                                        for x in lists)], pa.string())

    return decode


def encode_documents(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """All columns of ``docs`` and ids (array of int), n_tokens.

    Defined cases: a null text is encoded as the empty text, to no ids; texts
    of any length are encoded whole; the string of an added token is that
    token; repeated rows are encoded alike; an empty table gives no rows;
    input columns named ids or n_tokens are replaced.
    """
    vocabulary = load_vocabulary(tokenizer_path)
    own = [c for c in docs.columns if c not in ("ids", "n_tokens")]
    ids = encoder_column(docs.sparkSession, vocabulary)(F.coalesce("text", F.lit("")))
    rows = docs.select(F.struct(*own).alias("row"), ids.alias("ids"))
    return rows.select("row.*", "ids", F.size("ids").cast("long").alias("n_tokens"))


def decode_documents(rows: DataFrame, tokenizer_path: str, column: str = "decoded") -> DataFrame:
    """``rows`` and the text of their ids; null or no ids give the empty text,
    bytes that are no UTF-8 the replacement character."""
    decode = decoder_column(rows.sparkSession, load_vocabulary(tokenizer_path))
    return rows.withColumn(column, decode(F.col("ids")))
