"""Secret scans: patterns, and guess costs of values in credential contexts.

Base spans are found by three patterns, each leftmost and without overlap:
``assign`` (a credential word, an operator, a value of 6+ characters),
``access`` (a cloud access key id of 20+ characters) and ``hex`` (24+ digits).

The method adds ``guess`` spans: the values that stand in a wider credential
context (a base assignment's value, further credential words, the password
part of a URL, a bearer header) and that are dear to guess. The cost is the
cheapest segmentation of the value into dictionary words, dates, repeats of a
character or a block, keyboard walks and brute-force spans, found by dynamic
programming in bits; a value that is one block repeated costs the block and the
number. A variable's name in place of a value is no secret.
"""

from __future__ import annotations

import json
import math
import re
from array import array
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closebook.llm.common import in_parts

# The base patterns. Letters of group 1 in either case (A-Z only).
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"""([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "guess")
# Contexts of the method beside the base assignments; group 1 is the value.
CONTEXTS = (
    re.compile(r"""(?:passphrase|passcode|pwd|credentials?|private_?key|access_?key|auth)["']?"""
               r"""\x20*[:=]\x20*["']?([^\s"'<>,;]{6,})""", re.I | re.A),
    re.compile(r"://[^\s/:@]+:([^\s/@]{6,})@"),
    re.compile(r"\bbearer\x20+([A-Za-z0-9+/_.=~-]{6,})", re.I | re.A),
)
# One of these stands in every text that a context or ASSIGN matches.
HINTS = ("password", "passwd", "secret", "token", "api", "passphrase", "passcode", "pwd",
         "credential", "private", "access", "auth", "://", "bearer")

# Common words of passwords and placeholders, by how early a
# guesser tries them.
WORDS = ("password", "secret", "admin", "changeme", "letmein", "welcome", "token", "login",
         "default", "example", "test", "user", "root", "master", "dragon", "monkey", "shadow",
         "sunshine", "princess", "football", "baseball", "superman", "batman", "iloveyou",
         "trustno", "hello", "freedom", "whatever", "ninja", "michael", "jordan", "hunter",
         "killer", "summer", "winter", "spring", "autumn", "monday", "friday", "january",
         "love", "pass", "word", "guest", "public", "private", "sample", "demo", "dummy",
         "placeholder", "your", "my", "key", "api", "null", "none", "true", "false", "the",
         "and", "for", "with", "house", "horse", "correct", "battery", "staple", "orange",
         "apple", "banana", "coffee", "cheese", "pepper", "silver", "golden", "purple",
         "yellow", "green", "black", "white", "red", "blue", "computer", "internet", "server",
         "database", "system", "manager", "office", "company", "service", "access", "account")
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "abcdefghijklmnopqrstuvwxyz")
LEET = str.maketrans("013457@$!", "oleastasi")
DATE = re.compile(r"(?:19|20)\d\d(?:[-/._]?(?:0[1-9]|1[0-2])(?:[-/._]?(?:0[1-9]|[12]\d|3[01]))?)?"
                  r"|(?:0[1-9]|[12]\d|3[01])[-/._](?:0[1-9]|1[0-2])[-/._](?:19|20)\d\d")

STEP = 1.0  # bits for the choice of the next kind of segment
BLOCK = 32  # longest block whose repeats within a value are found
SHORT = 2   # parts of a name up to this length need not be words

# A name that stands for a value: ${A}, $A, %A%, {{ a }}, <a>, or a.b, a::b, a->b of words.
MARKED = re.compile(r"\$\{[^{}]*\}|\$\([^()]*\)|\$[A-Z_][A-Z0-9_]*|%[A-Za-z_]\w*%|\{\{[^{}]*\}\}"
                    r"|<[^<>]*>", re.A)
DOTTED = re.compile(r"[A-Za-z_]\w*(?:(?:\.|::|->)[A-Za-z_]\w*)+(?:\(\)?)?", re.A)
PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[A-Z]")


class Words:
    """A guesser's dictionary: words by how early they are tried. ``more`` follow
    the fixed list, in their order. Found by one pass of an automaton, however
    many they are."""

    def __init__(self, more: Iterable[str] = ()):
        ranked = dict.fromkeys([*WORDS, *more])
        self.bits = {w: math.log2(i + 2) for i, w in enumerate(ranked)}
        self._finder = None

    def __reduce__(self):
        return Words, (list(self.bits)[len(WORDS):],)

    def find(self, text: str) -> Iterator[tuple[int, int, float]]:
        """(end, length, bits) of every word in the text, by their end."""
        if self._finder is None:
            self._finder = ahocorasick.Automaton()
            for w, bits in self.bits.items():
                self._finder.add_word(w, (len(w), bits))
            self._finder.make_automaton()
        for end, (size, bits) in self._finder.iter(text):
            yield end + 1, size, bits

    def covers(self, name: str) -> bool:
        """Whether the letters are words only, one after the other."""
        ends = {0}
        for end, size, _ in self.find(name):
            if end - size in ends:
                ends.add(end)
        return len(name) in ends


def vocabulary(path: str, least: int = 3) -> list[str]:
    """Words of a tokenizer's vocabulary file, frequent ones first: a byte-pair
    vocabulary is in the order of its merges, which is that of frequency."""
    with open(path, encoding="utf-8") as f:
        tokens = json.load(f)["model"]["vocab"]
    words = (t.lstrip("\u0120").lower() for t in sorted(tokens, key=tokens.get))
    return list(dict.fromkeys(w for w in words if len(w) >= least and w.isascii() and w.isalpha()))


PLAIN = Words()


def _walks() -> dict[str, set[str]]:
    """Keys next to each other in a row, in either direction."""
    near: dict[str, set[str]] = {}
    for row in ROWS:
        for a, b in zip(row, row[1:]):
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    return near


NEAR = _walks()


def char_bits(value: str) -> float:
    """Bits of one brute-forced character: by the classes that occur."""
    if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", value):
        return math.log2(10 if value.isdigit() else 16)
    size = sum(n for n, p in ((26, "[a-z]"), (26, "[A-Z]"), (10, "[0-9]"), (33, "[^a-zA-Z0-9]"))
               if re.search(p, value))
    return math.log2(max(size, 2))


def is_reference(value: str, words: Words = PLAIN) -> bool:
    """Whether the value names a secret that stands elsewhere: a marked variable,
    or a dotted name all of whose parts are words."""
    if MARKED.fullmatch(value):
        return True
    parts = PART.findall(value) if DOTTED.fullmatch(value) else []
    return bool(parts) and not re.search("[0-9]", value) and all(
        len(p) <= SHORT or words.covers(p.lower()) for p in parts)


def guess_bits(value: str, words: Words = PLAIN) -> float:
    """log2 of the guesses for ``value``: the cheapest segmentation.

    cost[i] is that of value[:i]. Repeats of one character, walks, and copies of
    the block of up to ``BLOCK`` characters before may start and end anywhere
    within their run; a longer block counts where it fills the value. Time and
    memory (some 20 bytes a character) are proportional to the length.
    """
    n, low = len(value), value.lower()
    plain = low if len(low) == n else value
    leet = plain.translate(LEET)
    brute, near, copied = char_bits(value), math.log2(2 * len(NEAR)), math.log2(BLOCK)
    known = words.find(plain)
    spelled = words.find(leet) if leet != plain else iter(())
    word, other = next(known, None), next(spelled, None)
    ahead: dict[int, list[tuple[int, float]]] = {}  # dates by their end
    runs, run_at = _copies(plain), 0
    active: list[tuple[int, int, list]] = []  # (block, end of the run, starts) of copies
    cost = array("d", [0.0])
    open_brute, same, walk = math.inf, 0, 0  # the cheapest with a brute-force span that ends here
    alike: list[tuple[int, float]] = []
    keys: list[tuple[int, float]] = []
    for i in range(1, n + 1):
        c, before = plain[i - 1], plain[i - 2] if i > 1 else ""
        same = same + 1 if c == before else 1
        walk = walk + 1 if c in NEAR.get(before, ()) else 1
        open_brute = min(open_brute, cost[-1] + STEP) + brute
        best = open_brute
        while word is not None and word[0] == i:
            _, size, bits = word
            best = min(best, cost[i - size] + STEP + bits
                       + (value[i - size:i] != plain[i - size:i]))
            word = next(known, None)
        while other is not None and other[0] == i:
            _, size, bits = other
            if leet[i - size:i] != plain[i - size:i]:
                best = min(best, cost[i - size] + STEP + bits + 2
                           + (value[i - size:i] != plain[i - size:i]))
            other = next(spelled, None)
        if c.isdigit() and DATE.match(plain, i - 1):
            for end in range(i + 3, min(i + 9, n) + 1):
                if DATE.fullmatch(plain, i - 1, end):
                    ahead.setdefault(end, []).append(
                        (i - 1, math.log2(200 * (366 if end - i >= 4 else 1))))
        for j, bits in ahead.pop(i, ()):
            best = min(best, cost[j] + STEP + bits)
        if same >= 3:
            alike = alike if same > 3 else []
            best = min(best, _stretch(alike, i - 3, cost[-3], i) + STEP + brute)
        if walk >= 3:
            keys = keys if walk > 3 else []
            best = min(best, _stretch(keys, i - 3, cost[-3], i) + STEP + near)
        while run_at < len(runs) and runs[run_at][0] + runs[run_at][2] == i:
            _, end, block = runs[run_at]
            active, run_at = [*active, (block, end, [])], run_at + 1
        if active:
            for block, _, starts in active:
                best = min(best, _stretch(starts, i - block, cost[i - block], i) + STEP + copied)
            active = [a for a in active if a[1] > i]
        cost.append(best)
    # A value that repeats itself costs one period and the number of repeats.
    period = _period(plain)
    return min(cost[n], cost[period] + STEP + math.log2(n / period)) if period < n else cost[n]


def _copies(text: str) -> list[tuple[int, int, int]]:
    """(start, end, block): stretches in which every character is the one
    ``block`` places before, of a block or more, by where the first block ends.
    Blocks of one character are left to the repeats, and blocks that are made of
    shorter ones to those, which allow the same copies and more."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if text.isascii():
        points = np.frombuffer(text.encode(), np.uint8)
    found, first = [], {}
    for block in range(2, min(BLOCK, len(points) // 2) + 1):
        cuts = np.flatnonzero(np.diff(np.r_[False, points[block:] == points[:-block], False]))
        starts, ends = cuts[::2] + block, cuts[1::2] + block
        long = ends - starts >= block
        for a, b in zip(starts[long].tolist(), ends[long].tolist()):
            if first.get(b, a + 1) > a and (points[a - block:a] != points[a]).any():
                first[b] = min(a, first.get(b, a))
                found.append((a, b, block))
    return sorted(found, key=lambda r: (r[0] + r[2], r))


def _stretch(live: list[tuple[int, float]], start: int, cost: float, i: int) -> float:
    """The least cost + log2(i - start) over the starts of ``live`` and this
    one, which may be used from ``i`` on. Kept are starts that can still win: an
    earlier one that is no cheaper never does, nor does a later one from the
    moment it loses, as the logarithms of the lengths draw near."""
    while live and live[-1][1] >= cost:
        live.pop()
    best, kept = math.inf, []
    for j, c in live:
        if (bits := c + math.log2(i - j)) < best:
            best = bits
            kept.append((j, c))
    live[:] = kept
    if (bits := cost + math.log2(i - start)) < best:
        live.append((start, cost))
        best = bits
    return best


def _period(text: str) -> int:
    """The shortest period that divides the length, by the prefix function."""
    n, fail = len(text), array("i", bytes(4 * len(text)))
    for i in range(1, n):
        k = fail[i - 1]
        while k and text[i] != text[k]:
            k = fail[k - 1]
        fail[i] = k + (text[i] == text[k])
    p = n - fail[-1] if n else 0
    return p if n and n % p == 0 else n


def scan(text: str, min_bits: float = 40.0,
         words: Words = PLAIN) -> list[tuple[int, int, str, float | None]]:
    """(start, end, kind, guess bits) of every span, in order; code points, end
    exclusive. Base spans carry no cost."""
    spans: list[tuple[int, int, str, float | None]] = []
    values: set[tuple[int, int]] = set()
    low = text.lower()
    if any(h in low for h in HINTS):
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= 6:
                spans.append((m.start(), m.end(), "assign", None))
                values.add(m.span(2))
        for context in CONTEXTS:
            values.update(m.span(1) for m in context.finditer(text))
    spans += [(*m.span(), "access", None) for m in ACCESS.finditer(text)]
    spans += [(*m.span(), "hex", None) for m in HEX.finditer(text)]
    for start, end in values:
        value = text[start:end]
        if not is_reference(value, words) and (bits := guess_bits(value, words)) >= min_bits:
            spans.append((start, end, "guess", bits))
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def scan_secrets(docs: DataFrame, min_bits: float = 40.0,
                 more_words: Iterable[str] = ()) -> DataFrame:
    """All columns of ``docs`` and found: array of (start, end, kind, bits).

    ``min_bits``: a value that takes at least 2^min_bits guesses is a secret.
    ``more_words``: a guesser's further words, frequent ones first, such as a
    ``vocabulary``; their number is what a dictionary has, whatever the data.
    Defined cases: a null or empty text has no spans; a text of any length is
    scanned whole; the same value in two contexts is one span; spans of
    different kinds may overlap; repeated rows are scanned alike; an empty
    table gives no rows; an input column named found is replaced.
    """
    kind = "array<struct<start:long,end:long,kind:string,bits:double>>"
    words = Words(more_words)

    @F.arrow_udf(kind)
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()),
                                    ("kind", pa.string()), ("bits", pa.float64())]))
        for texts in in_parts(batches):
            yield pa.array([[dict(zip(("start", "end", "kind", "bits"), s))
                             for s in scan(t or "", min_bits, words)] for t in texts.to_pylist()], spans)

    own = [c for c in docs.columns if c != "found"]
    rows = docs.select(F.struct(*own).alias("row"), find(F.col("text")).alias("found"))
    return rows.select("row.*", "found")
