"""Embedding dedup, conversation repair and the prefix trie against plain computations."""

import collections
import functools
import hashlib
import re
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from closebook.llm import prefix_trie, queries, subspace_join, turn_repair
from closebook.llm.common import scratch_path
from closebook.llm.queries import QUERIES

EMPTY = hashlib.sha256().hexdigest()


# ------------------------------------------------------------ embedding dedup
def plain_links(rows, least=0.93):
    """{vec_id: (links, smallest reachable)} of (vec_id, label, vector), all pairs."""
    fit = [(i, l, np.array(v, float)) for i, l, v in rows
           if i is not None and l is not None and v and all(
               x is not None and np.isfinite(x) for x in v) and any(v)]
    near = {i: set() for i, _, _ in rows if i is not None}
    for i, l, v in fit:
        for j, m, w in fit:
            if i != j and l == m and len(v) == len(w) and \
                    v @ w / (np.linalg.norm(v) * np.linalg.norm(w)) >= least:
                near[i].add(j)
    out = {}
    for i in near:
        seen, todo = {i}, [i]
        while todo:
            new = near[todo.pop()] - seen
            seen |= new
            todo += new
        out[i] = (len(near[i]), min(seen))
    return out


def found_links(df):
    rows = df.collect()
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in rows)
    return {r["vec_id"]: (r["n_links"], r["component_id"]) for r in rows}


def cloud(rng, dim, n):
    """Clusters tight and loose, chains of links, copies, and strangers."""
    rows = list(rng.normal(size=(n, dim)))
    for spread, size in ((0.05, n // 2), (0.2, n // 2), (0.27, n // 2)):
        rows += list(rng.normal(size=dim) + spread * rng.normal(size=(size, dim)))
    step = rng.normal(size=dim)
    rows += [rows[0] + step * k / 6 for k in range(12)]
    rows += [rows[1] * 2, rows[1], rows[1], rows[n], rows[n] * 1e-3]
    return [v.tolist() for v in rows]


@pytest.mark.parametrize("dim,block_dims,slab_rows,least",
                         [(64, 16, 16384, 0.93), (24, 4, 7, 0.93), (3, 16, 5, 0.99), (1, 2, 4, 0.5),
                          (16, 1, 20, 0.8), (40, 16, 10, 0.3)])
def test_subspace_join_loses_no_link(spark, dim, block_dims, slab_rows, least):
    rng = np.random.default_rng(dim)
    rows = [(7 * i + 3, i % 3 and 1, v) for i, v in enumerate(cloud(rng, dim, 30))]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = found_links(subspace_join.near_duplicates(df, least, block_dims, slab_rows))
    want = plain_links(rows, least)
    assert got == want
    assert dim == 1 or len({c for _, c in want.values()}) < len(want)


def test_blocks_find_few_candidates():
    """The pigeonhole prunes: of random vectors hardly any pair is a candidate,
    and each pair within the radius is one in some block."""
    rng = np.random.default_rng(5)
    v = rng.normal(size=(600, 64))
    v[300:] = v[:300] + 0.25 * rng.normal(size=(300, 64))
    y = subspace_join.rotated(v, np.sqrt((v ** 2).sum(axis=1)))
    assert np.allclose(y @ y.T, (v @ v.T) / np.linalg.norm(v, axis=1)[:, None]
                       / np.linalg.norm(v, axis=1))
    starts, budgets = subspace_join.blocks_of(64, 16, 0.93)
    pairs = set()
    for at, budget in zip(starts, budgets):
        z = y[:, at:at + 16]
        for i, j in subspace_join.candidates(z, np.arange(600), np.arange(0), True, budget):
            pairs |= set(map(tuple, np.sort(np.stack([i, j], 1), axis=1).tolist()))
    want = {(i, j) for i, j in zip(*np.nonzero(np.triu(y @ y.T >= 0.93, 1)))}
    assert want <= pairs and len(pairs) < 600 * 599 / 2 * 0.01 and len(want) > 100


def test_embedding_edges(spark):
    one, big = [1.0, 0.0], [1e200, 1e200]
    rows = [(1, 1, one), (2, 1, [2.0, 0.0]), (3, None, one), (4, 2, one), (5, 1, None),
            (6, 1, []), (7, 1, [0.0, 0.0]), (8, 1, [float("nan"), 1.0]), (9, 1, [None, 1.0]),
            (10, 1, [float("inf"), 0.0]), (11, 1, [1.0]), (12, 1, [1.0, 0.0, 0.0]),
            (13, 1, big), (14, 1, [1.0, 1.0]), (15, 1, [1e-200, 1e-200]), (1, 1, one),
            (16, 1, one), (None, 1, one)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows],
                               "vec_id long, label int, embedding array<double>, node string, w string")
    out = subspace_join.near_duplicates(df).collect()
    assert len(out) == len(rows)
    got = {(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in out}
    assert got == {(1, 2, 1, True), (2, 2, 1, False), (16, 2, 1, False), (3, 0, 3, True),
                   (4, 0, 4, True), *[(i, 0, i, True) for i in range(5, 13)],
                   (13, 2, 13, True), (14, 2, 13, False), (15, 2, 13, False),
                   (None, 0, None, False)}
    assert subspace_join.near_duplicates(df.limit(0)).collect() == []


# -------------------------------------------------------- conversation repair
def plain_repair(rows):
    """(audit, cost, lines) by a search over suffixes; rows (role, text, fault)."""
    legal = {"": "us", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}

    @functools.lru_cache(None)
    def best(n, last, inserts):
        options = [(0, "")] if n == len(rows) and last in ("", "a") else []
        if inserts < 2:
            to = legal[last][0]
            cost, rest = best(n, to, inserts + 1)
            options.append((cost + 5, "I" + rest))
        if n < len(rows):
            role, _, fault = rows[n]
            cost, rest = best(n + 1, last, 0)
            options.append((cost + 2, "D" + rest))
            if fault not in ("blank", "duplicate"):
                extra = 5 * (fault == "truncated")
                if role[:1] and role[:1] in legal[last]:
                    cost, rest = best(n + 1, role[:1], 0)
                    options.append((cost + extra, "K" + rest))
                cost, rest = best(n + 1, legal[last][0], 0)
                options.append((cost + extra + 1, "R" + rest))
        return min(options, default=(10 ** 9, ""))

    for n in range(len(rows), 0, -50):  # bounds the depth of the recursion
        for last in legal:
            best(n, last, 0)
    cost, audit = best(0, "", 0)
    lines, last, n = [], "", 0
    for edit in audit:
        if edit == "I":
            last = legal[last][0]
            lines.append(f"{name[last]}:")
            continue
        role, text, _ = rows[n]
        n += 1
        if edit == "K":
            last = role[:1]
            lines.append(f"{role}:{text}")
        elif edit == "R":
            last = legal[last][0]
            lines.append(f"{name[last]}:{text}")
    return audit, cost, lines


def plain_repairs(rows):
    """{conv_id: the columns of the contract} of (conv_id, turn, role, text)."""
    spaced = lambda x: " " if x is None else x
    convs = collections.defaultdict(list)
    for c, t, r, x in rows:
        kept = convs[c]
        kind = zlib.crc32(f"{spaced(c)}:{spaced(t)}".encode()) % 20
        r, x = spaced(r), spaced(x)
        r = "user" if kind == 4 else r
        x = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
        kept += [(t is not None, t or 0, r, x)] * {0: 0, 3: 2}.get(kind, 1)
    return {c: plain_columns(sorted(v)) for c, v in convs.items()}


def plain_columns(kept):
    turns = {t for known, t, _, _ in kept if known}
    faults, seen = [], set()
    for _, _, r, x in kept:
        solid = x.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not solid else "duplicate" if (r, x) in seen
                      else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((r, x))
    audit, cost, lines = plain_repair(tuple((r, x, f) for (_, _, r, x), f in zip(kept, faults)))
    initials = [r[:1] for _, _, r, _ in kept]
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("blank"),
            faults.count("duplicate"), faults.count("truncated"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost,
            audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


REPAIR = [*turn_repair.COUNTS, "audit", "repaired_sha256"]


def repairs(df):
    return {r["conv_id"]: tuple(r[c] for c in REPAIR) for r in df.collect()}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_repair_query(spark, sf):
    rows = duckdb.sql("SELECT conv_id, turn, role, text FROM "
                      f"'/root/testdata/{sf}/conversations.parquet'").fetchall()
    got = repairs(QUERIES["op12_turn_repair"](spark, f"/root/testdata/{sf}"))
    assert got == plain_repairs(rows)
    assert {"D", "I", "K", "R"} >= set("".join(v[-2] for v in got.values())) > {"D", "K"}


ROWS = st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "ua"]),
                          st.sampled_from(["a.", "b?", "c", " ", "d! "])), max_size=9)


@settings(max_examples=300, deadline=None)
@given(ROWS)
def test_stream_finds_the_cheapest_edits(rows):
    kept = [(True, n, r, x) for n, (r, x) in enumerate(rows)]
    faults, seen = [], set()
    for r, x in rows:
        solid = x.strip()
        faults.append(turn_repair.BLANK if not solid else turn_repair.DUPLICATE if (r, x) in seen
                      else turn_repair.CUT if solid[-1] not in ".!?" else turn_repair.NO_FAULT)
        seen.add((r, x))
    stream = turn_repair.Stream(10 ** 6)
    stream.open(1)
    for n, ((r, x), fault) in enumerate(zip(rows, faults)):
        stream.add(n, r, x, r[:1], fault)
    out = stream.close()[-1]
    assert tuple(out[c] for c in REPAIR) == plain_columns(kept)


def odd_conversations():
    rng = np.random.default_rng(3)
    roles = ["user", "assistant", "system", "tool", None, ""]
    texts = ["One.", "Two?", "three", None, "", "  \n", "One.", "été!", "x" * 300_000 + ".", "\x00."]
    rows = [(c, None if rng.random() < 0.1 else int(rng.integers(-2, 30)),
             roles[rng.integers(6)], texts[rng.integers(10)])
            for c in [1, 2, 3, None, 5, -7] for _ in range(30)]
    return rows + rows[:10] + [(8, 0, "user", None), (9, None, None, None)]


def test_repair_edges(spark):
    """Nulls, ties, repeats, long texts, clashing columns, spilled backpointers
    at any chunk size, and texts that agree with the digests."""
    rows = odd_conversations()
    df = spark.createDataFrame([(*r, "p", "q", 1) for r in rows],
                               "conv_id long, turn long, role string, text string, chunk string, "
                               "present string, fault int")
    kept = collections.defaultdict(list)
    for c, t, r, x in rows:
        kept[c].append((t is not None, t or 0, " " if r is None else r, " " if x is None else x))
    want = {c: plain_columns(sorted(v)) for c, v in kept.items()}
    for held in (turn_repair.HELD_ROWS, 7, 1):
        out = turn_repair.repair_conversations(df, held_rows=held)
        assert repairs(out) == want
    turns = turn_repair.repaired_turns(df, out).collect()
    lines = collections.defaultdict(list)
    for r in sorted(turns, key=lambda r: r["position"]):
        lines[r["conv_id"]].append(f"{r['role']}:{r['text']}")
    assert {c: hashlib.sha256("\n".join(lines[c]).encode()).hexdigest() for c in want} == {
        c: v[-1] for c, v in want.items()}
    assert turn_repair.repair_conversations(df.limit(0)).collect() == []


def test_repair_of_dropped_conversations(spark):
    df = spark.createDataFrame([(1, 0, "user", "a."), (2, 0, "user", "b.")],
                               "conv_id long, turn long, role string, text string")
    got = repairs(turn_repair.repair_conversations(df, df["conv_id"] == 2))
    assert got == {1: (0, 0, 0, 0, 0, 0, "", EMPTY), 2: (0, 0, 0, 0, 0, 2, "D", EMPTY)}


def test_giant_conversation_is_streamed(spark):
    """100,000 turns, spilled in chunks of 4,096."""
    df = spark.range(100_000).selectExpr(
        "7 AS conv_id", "id AS turn", "IF(id % 2 = 0, 'user', 'assistant') AS role",
        "concat('turn ', id, IF(id % 1000 = 17, '', '.')) AS text")
    row, = turn_repair.repair_conversations(df, held_rows=4096).collect()
    assert (row["truncated"], row["gaps"], row["illegal"]) == (100, 0, 0)
    kept = [(True, n, "user" if n % 2 == 0 else "assistant",
             f"turn {n}" + ("" if n % 1000 == 17 else ".")) for n in range(2000)]
    part = plain_columns(kept)  # two of the hundred faults, at the same distance
    assert row["cost"] == 50 * part[5] and row["audit"][:1900] == part[6][:1900]
    assert len(row["audit"].replace("I", "")) == 100_000


# ---------------------------------------------------------------- prefix trie
def plain_trie(rebuilt):
    """{(conv_id, depth): the other columns} of {conv_id: turns}."""
    members, kids, out = collections.defaultdict(list), collections.defaultdict(list), {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    for path in members:
        if path:
            kids[path[:-1]].append(path)
    totals = {}
    for path in sorted(members, key=len, reverse=True):
        leaves = sum(totals[k][0] for k in kids[path]) or 1
        saved = sum(totals[k][1] for k in kids[path])
        saved += (len(members[path]) - 1) * len(path[-1][1]) if path else 0
        totals[path] = leaves, saved
        ends = ",".join(str(c) for c in sorted(members[path]) if len(rebuilt[c]) == len(path))
        out[min(members[path]), len(path)] = (
            min(members[path[:-1]]) if path else None, len(members[path]), len(kids[path]), leaves,
            saved, hashlib.sha256(ends.encode()).hexdigest())
    return out


def plain_rebuilt(rows):
    convs = collections.defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            convs[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in convs.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def nodes(df):
    names = ["parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    rows = df.collect()
    got = {(r["conv_id"], r["depth"]): tuple(r[c] for c in names) for r in rows}
    assert len(got) == len(rows)
    return got


@pytest.fixture(scope="module")
def talks():
    """Conversations that share first turns, whole copies, long chains, nulls."""
    rng = np.random.default_rng(11)
    rows = []
    for c in range(0, 900, 3):
        size = int(rng.integers(1, 9))
        common = 4 if c % 2 else int(rng.integers(0, 3))  # a third and more begin alike
        rows += [(c, t, ["user", "assistant"][t % 2],
                  f"common {t}" if t < common else str(rng.integers(0, 4)) * (t + 1))
                 for t in range(size)]
    rows += [(c, t, "user", "copy") for c in range(1000, 1060) for t in range(6)]
    rows += [(2001, t, "user", f"deep {t}") for t in range(500)]
    return rows + [(3000, None, None, None), (None, 0, "user", "no id"), (3001, 1, "user", "x"),
                   (3001, None, "user", "first"), (12345, 0, None, "orphan")]


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("limit,held", [(None, prefix_trie.HELD_MESSAGES), (1, 3), (10 ** 6, 5),
                                        (3, 1), (40, 10)])
def test_trie_of_shared_prefixes(spark, talks, limit, held):
    """At any size of shards, and with queues that spill nearly every message."""
    turns = queries.rebuilt(spark.createDataFrame(talks, SCHEMA))
    got = nodes(prefix_trie.prefix_trie(turns, limit, held))
    assert got == plain_trie(plain_rebuilt(talks))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_trie_query(spark, sf):
    rows = duckdb.sql("SELECT conv_id, turn, role, text FROM "
                      f"'/root/testdata/{sf}/conversations.parquet'").fetchall()
    got = nodes(QUERIES["op13_prefix_trie"](spark, f"/root/testdata/{sf}"))
    assert got == plain_trie(plain_rebuilt(rows))


def test_trie_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert nodes(prefix_trie.prefix_trie(queries.rebuilt(empty))) == {}
    # A conversation that is left without a turn, repeats of a row, clashing columns.
    lone = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 > 2)
    rows = [(lone, 0, "user", "a"), (lone, 0, "user", "a"), (700, 0, "user", "y" * 200_000)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", path string, pos int")
    assert nodes(prefix_trie.prefix_trie(queries.rebuilt(df))) == plain_trie(plain_rebuilt(rows))
    assert plain_rebuilt(rows)[lone] == []


def test_spilling_queue(spark):
    """Items come out by key whatever is spilled, and files go with the queue."""
    from pyarrow import fs
    folder = prefix_trie.uri(scratch_path(spark, "queue-test"))
    for limit in (1, 7, 1000):
        queue = prefix_trie.SpillingQueue(folder, limit)
        rng = np.random.default_rng(limit)
        keys = rng.integers(0, 40, 500).tolist()
        for n, key in enumerate(keys):
            queue.push(key, (key, n))
        for key in range(40):
            assert sorted(queue.take(key)) == [(k, n) for n, k in enumerate(keys) if k == key]
        assert bool(queue.files) == (limit < 500)
        queue.close()
        store, path = fs.FileSystem.from_uri(folder)
        assert not [f for f in store.get_file_info(fs.FileSelector(path, allow_not_found=True))]
