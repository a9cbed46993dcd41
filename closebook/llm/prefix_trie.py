"""Conversation prefix trie by time-forward processing.

A node is a distinct sequence of first turns. Each conversation streams its
turns in order and writes one row for each of its nodes, named by a chained
128-bit hash; texts stay behind, turns travel as hashes. What a subtree holds
(leaves, tokens that shared prefixes save) flows from the deepest level up:

* a *heavy* node has more than ``limit`` member conversations; ``limit`` is an
  eighth of the square root of the number of rows, so there are at most eight
  times that root of heavy nodes, which bounds the list that is broadcast;
* every other node belongs to the shard of its topmost ancestor that is not
  heavy. A shard's rows are sorted by reverse level order (deepest first, then
  path). A node sends its totals to its parent through a priority queue on the
  parent's place in that order, and the parent, when its turn comes, takes all
  that were sent to it;
* the totals of shard roots are added up by parent, and the heavy nodes pass
  them on in the same way, across shards, up to the root.

The queue holds ``held_messages`` messages; beyond that it writes sorted runs
to the shared checkpoint folder and merges them as they come due.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import uuid
from collections.abc import Iterator
from math import isqrt

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from closebook.llm.common import drop_folder, scratch_path, settle

HELD_MESSAGES = 200_000
ENDS_PART = 1024  # ids of a part of a list of members
ROOT = b"\0" * 16
EMPTY = hashlib.sha256().hexdigest()
STEP = ("conv_id long, depth long, path binary, parent binary, chars long, ends boolean")
NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
        "n_leaves long, saved_tokens long, ends_sha256 string, parent binary")
NODE_ARROW = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()),
                        ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
                        ("n_children", pa.int64()), ("n_leaves", pa.int64()),
                        ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()),
                        ("parent", pa.binary())])
NODE_NAMES = NODE_ARROW.names


def hashed_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, a, b, chars): the turns of each conversation from 1, by
    two hashes of role and text (null: empty), with the text's code points.
    Null turns come first; equal turns are ordered by these hashes."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.xxhash64(role, text).alias("a"), F.xxhash64(F.lit(1), role, text).alias("b"),
        F.length(text).cast("long").alias("chars"))
    order = Window.partitionBy("conv_id").orderBy("turn", "a", "b")
    return rows.select("conv_id", F.row_number().over(order).cast("long").alias("pos"),
                       "a", "b", "chars")


def _steps(batches):
    """One row for each node of each conversation; a row is held back until the
    next one tells whether its conversation ends."""
    conv, path, held, depth = None, ROOT, None, 0
    names = ["conv_id", "depth", "path", "parent", "chars", "ends"]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.bool_()]

    def rows(out):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(list(zip(*out)) or [()] * 6, kinds)], names)

    for batch in batches:
        out = []
        for c, pos, a, b, chars in zip(*(x.to_pylist() for x in batch.columns)):
            if held is not None:
                out.append((*held, c != conv))
            if pos == 0:
                conv, path, depth, held = c, ROOT, 0, (c, 0, ROOT, None, 0)
                continue
            parent, depth = path, depth + 1
            turn = a.to_bytes(8, "little", signed=True) + b.to_bytes(8, "little", signed=True)
            path = hashlib.blake2b(parent + turn, digest_size=16).digest()
            held = (c, depth, path, parent, chars)
        yield rows(out)
    if held is not None:
        yield rows([(*held, True)])


class SpillingQueue:
    """A priority queue that holds ``limit`` items; beyond that, sorted runs go
    to ``folder`` and are merged as they come due. Items are tuples that begin
    with their key; a number keeps equal keys from comparing further."""

    def __init__(self, folder: str, limit: int):
        self.folder, self.limit = folder, limit
        self.heap: list = []
        self.heads: list = []
        self.files: list = []
        self.n = 0

    def push(self, key, item) -> None:
        self.n += 1
        heapq.heappush(self.heap, (key, self.n, item))
        if len(self.heap) > self.limit:
            self._spill()

    def _spill(self) -> None:
        store, root = fs.FileSystem.from_uri(uri(self.folder))
        name = f"{root}/{uuid.uuid4().hex}"
        store.create_dir(root, recursive=True)
        self.heap.sort()
        with store.open_output_stream(name) as out:
            for item in self.heap:
                out.write(pickle.dumps(item))
        self.heap = []
        self.files.append((store, name))
        self._next(self._read(store, name))

    def _read(self, store, name):
        with pa.PythonFile(store.open_input_stream(name), mode="r") as f:
            reader = pickle.Unpickler(f)
            while True:
                try:
                    yield reader.load()
                except EOFError:
                    return

    def _next(self, run) -> None:
        item = next(run, None)
        if item is not None:
            heapq.heappush(self.heads, (*item, run))

    def take(self, key) -> Iterator:
        """The items of a key, which must be the least there is."""
        while True:
            if self.heap and self.heap[0][0] == key:
                yield heapq.heappop(self.heap)[2]
            elif self.heads and self.heads[0][0] == key:
                _, _, item, run = heapq.heappop(self.heads)
                self._next(run)
                yield item
            else:
                return

    def close(self) -> None:
        self.heads = []
        for store, name in self.files:
            store.delete_file(name)
        self.files = []


def uri(path: str) -> str:
    """file:/a as file:///a, a plain path as it is."""
    return path.replace("file:/", "file:///", 1) if path.startswith("file:/") \
        and not path.startswith("file://") else path


def time_forward(nodes, queue: SpillingQueue):
    """Rows of NODE. ``nodes`` come in reverse level order within each shard:
    (depth, path, parent, conv_id, n_convs, chars, ends_sha256, top, and what
    other shards sent: children, leaves, saved). A node's row is complete when
    its parent, which knows its own conv_id, takes it; a shard's top leaves
    with parent instead."""
    for depth, path, parent, conv, n, chars, ends, top, children, leaves, saved in nodes:
        for child in queue.take((-depth, path)):
            children, leaves, saved = children + 1, leaves + child[5], saved + child[6]
            yield (*child[:2], conv, *child[3:], None)
        row = (conv, depth, None, n, children, leaves or 1, saved + (n - 1) * chars, ends)
        if top:
            yield (*row, parent)
        else:
            queue.push((1 - depth, parent), row)


def _grouped(batches):
    """Nodes of the member rows of light nodes, sorted by shard, reverse level
    order and conv_id."""
    node = sha = None
    n = 0
    for batch in batches:
        for shard, depth, path, parent, conv, chars, ends in zip(
                *(c.to_pylist() for c in batch.columns)):
            if node is None or (node[0], node[2]) != (shard, path):
                if node:
                    yield _node(node, n, sha)
                node, n, sha = (shard, depth, path, parent, conv, chars), 0, None
            n += 1
            if ends:
                first, sha = sha is None, sha or hashlib.sha256()
                sha.update(str(conv).encode() if first else f",{conv}".encode())
    if node:
        yield _node(node, n, sha)


def _node(node, n, sha):
    shard, depth, path, parent, conv, chars = node
    return (depth, path, parent, conv, n, chars, sha.hexdigest() if sha else EMPTY,
            shard == path, 0, 0, 0)


def _prepared(batches):
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _forward(read, folder: str, held: int):
    def run(batches):
        queue, out = SpillingQueue(folder, held), []
        try:
            for row in time_forward(read(batches), queue):
                out.append(row)
                if len(out) == 10_000:
                    yield _node_rows(out)
                    out = []
            yield _node_rows(out)
        finally:
            queue.close()

    return run


def _node_rows(rows: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(NODE_NAMES)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, NODE_ARROW)], schema=NODE_ARROW)


def _ends(batches):
    """SHA-256 of the joined parts of each node's list of members."""
    path, sha = None, None
    for batch in batches:
        out = []
        for p, part in zip(batch.column("path").to_pylist(), batch.column("ids").to_pylist()):
            if p != path:
                if sha:
                    out.append((path, sha.hexdigest()))
                path, sha = p, hashlib.sha256(part.encode())
            else:
                sha.update(b"," + part.encode())
        yield _end_rows(out)
    if sha:
        yield _end_rows([(path, sha.hexdigest())])


def _end_rows(rows):
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()),
                                       pa.array([r[1] for r in rows], pa.string())],
                                      ["path", "ends_sha256"])


def prefix_trie(turns: DataFrame, limit: int | None = None,
                held_messages: int = HELD_MESSAGES) -> DataFrame:
    """One row a node of the trie of ``turns`` (conv_id, pos, a, b, chars):
    conversations in order of pos, each turn by two hashes and its size; a row
    with pos 0 for every conversation, which may have no others.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256 (of the members that end there, in
    numerical order).

    Defined cases: null conversation ids take no part; a conversation without
    turns is a member of the root, where it ends; turns of equal role and text
    are equal, empty ones too; rows repeated as a whole are turns of their own;
    texts of any length are hashed where they are read; an empty table has no
    node, not even a root.
    """
    spark = turns.sparkSession
    folder = scratch_path(spark, "queues")
    steps = settle(turns.select("conv_id", "pos", "a", "b", "chars").repartition("conv_id")
                   .sortWithinPartitions("conv_id", "pos").mapInArrow(_steps, STEP), "steps")
    limit = limit or max(8, isqrt(steps.count()) // 8)
    heavy = settle(steps.groupBy("path").agg(F.count(F.lit(1)).alias("n"))
                   .where(F.col("n") > limit).select("path", F.lit(True).alias("heavy")), "heavy")
    # At most rows / limit nodes, eight times the square root of the rows.
    down = Window.partitionBy("conv_id").orderBy("depth").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    marked = steps.join(F.broadcast(heavy), "path", "left")
    light = marked.withColumn("shard", F.first(
        F.when(F.col("heavy").isNull(), F.col("path")), ignorenulls=True).over(down)).where(
        F.col("heavy").isNull())
    inside = settle(
        light.select("shard", "depth", "path", "parent", "conv_id", "chars", "ends")
        .repartition("shard").sortWithinPartitions("shard", F.desc("depth"), "path", "conv_id")
        .mapInArrow(_forward(_grouped, folder, held_messages), NODE), "shards")
    # Shard roots still lack their parent's conv_id; all others have it.
    roots = inside.where(F.col("parent_conv_id").isNull())
    members = marked.where("heavy")
    sent = roots.groupBy("parent").agg(
        F.count(F.lit(1)).alias("children"), F.sum("n_leaves").alias("leaves"),
        F.sum("saved_tokens").alias("saved")).withColumnRenamed("parent", "path")
    # Members that end in one heavy node may be a third of all: joined in parts first.
    parts = members.where("ends").groupBy(
        "path", F.floor(F.col("conv_id") / F.lit(ENDS_PART)).alias("part")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")),
                                 lambda i: i.cast("string")), ",").alias("ids"))
    ends = (parts.repartition("path").sortWithinPartitions("path", "part")
            .select("path", "ids").mapInArrow(_ends, "path binary, ends_sha256 string"))
    tops = members.groupBy("path").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n"),
        F.min("depth").alias("depth"), F.min("parent").alias("parent"),
        F.min("chars").alias("chars"))
    tops = settle(tops.join(sent, "path", "left").join(ends, "path", "left"), "tops")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("children", "leaves", "saved")]
    above = (tops.select("depth", "path", "parent", "conv_id", "n", "chars",
                         F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends"),
                         F.col("parent").isNull().alias("top"), *zero)
             .repartition(1).sortWithinPartitions(F.desc("depth"), "path")
             .mapInArrow(_forward(_prepared, folder, held_messages), NODE))
    parents = tops.select(F.col("path").alias("parent"), F.col("conv_id").alias("above"))
    joined = roots.drop("parent_conv_id").join(F.broadcast(parents), "parent", "left") \
        .withColumnRenamed("above", "parent_conv_id")
    names = [c for c in NODE_NAMES if c != "parent"]
    out = settle(inside.where(F.col("parent_conv_id").isNotNull()).select(names)
                 .union(joined.select(names)).union(above.select(names)), "trie")
    drop_folder(spark, folder)
    return out
