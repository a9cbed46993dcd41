"""Embedding near-dedup by a subspace pigeonhole join.

Unit vectors whose cosine is c are sqrt(2 - 2c) apart. The vectors are rotated
(random signs and Walsh-Hadamard transforms, which spread each vector over all
coordinates and are sums only, hence the same on every machine) and cut in
blocks of ``block_dims`` coordinates. A block's share of the squared distance
is proportional to its size, and a pair within the whole budget is within the
share of one block at least. So the blocks are range-joined one by one:

* a block's vectors are cut in slabs along its first coordinate, as wide as the
  block's radius, so partners stand in the same or in neighbouring slabs;
* a slab of more than ``slab_rows`` vectors is cut in parts by the hash of the
  vector's node, and every two parts that may hold partners meet in a task of
  their own, so no task holds more than two parts, whatever the group's size;
* within a task the vectors are cut in boxes, box pairs farther apart than the
  radius are skipped, and block distances are computed for the others.

A candidate is verified by the cosine of the original vectors, in double
precision, in component order. It counts in the first block that finds it, so
no pair is written to be made distinct: a task writes how many links each
vector has, and a spanning forest of its links, at most one a vector.

Exact copies are one node that carries the number of its ids.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from closebook.llm.common import settle, spread_join
from closebook.llm.components import components

SEED = 20
BOX = 128           # vectors of a box
PAIRS = 1 << 15     # candidates verified at a time
SLACK = 1e-9        # rounding of a rotated distance; the cosine decides
KEY = ["label", "dim", "block", "slab", "kind", "lo", "hi"]


def unit_rows(rows: np.ndarray) -> np.ndarray:
    """Rows scaled by a power of two, which changes no cosine, so that squares
    neither overflow nor vanish."""
    top = np.abs(rows).max(axis=1)
    return np.ldexp(rows, -np.frexp(top)[1][:, None])


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, summed in component order."""
    total = np.zeros(len(a))
    for j in range(a.shape[1]):
        total += a[:, j] * b[:, j]
    return total


def rotated(rows: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """Unit vectors, padded to a power of two, after two rounds of signs and
    transforms."""
    width = 1 << max(rows.shape[1] - 1, 0).bit_length()
    signs = np.random.default_rng(SEED).integers(0, 2, (2, width)) * 2.0 - 1
    z = np.zeros((len(rows), width))
    z[:, :rows.shape[1]] = rows / norms[:, None]
    for flip in signs:
        z *= flip
        step = 1
        while step < width:
            pairs = z.reshape(len(z), -1, 2, step)
            z = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]],
                         axis=2).reshape(len(z), width)
            step *= 2
        z /= np.sqrt(width)
    return z


def blocks_of(dim: int, block_dims: int, min_cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """First coordinates of the blocks of rotated vectors, and their budgets."""
    width = 1 << max(dim - 1, 0).bit_length()
    starts = np.arange(0, width, block_dims)
    sizes = np.diff(np.r_[starts, width])
    return starts, (2 - 2 * min_cosine) * sizes / width


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dim)


def place(block_dims: int, min_cosine: float):
    """Each vector once a block, with its slab."""

    def run(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                own = batch.filter(pa.array(dims == dim))
                rows = unit_rows(_matrix(own.column("v"), dim))
                z = rotated(rows, np.sqrt(inner(rows, rows)))
                for block, (at, budget) in enumerate(zip(*blocks_of(dim, block_dims, min_cosine))):
                    slab = np.floor(z[:, at] / np.sqrt(budget + 10 * SLACK)).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [*own.columns, pa.array(np.full(len(z), block, np.int32)), pa.array(slab)],
                        [*own.schema.names, "block", "slab"])

    return run


def boxes(z: np.ndarray, points: np.ndarray) -> list[np.ndarray]:
    """Points in boxes of at most BOX, halved along the widest coordinate."""
    done, todo = [], [points]
    while todo:
        part = todo.pop()
        spread = np.ptp(z[part], axis=0) if len(part) > BOX else None
        if spread is None or not spread.max():
            done += [part[i:i + BOX] for i in range(0, len(part), BOX)]
            continue
        half = len(part) // 2
        order = part[np.argpartition(z[part, spread.argmax()], half)]
        todo += [order[:half], order[half:]]
    return done


def candidates(z: np.ndarray, left: np.ndarray, right: np.ndarray, within: bool, budget: float):
    """(i, j) arrays of the pairs within the block's budget: of ``left`` with
    ``right``, and of ``left`` with itself if ``within``."""
    budget += 1e-7
    squares = (z ** 2).sum(axis=1)
    mine, theirs = boxes(z, left), boxes(z, right)
    every = (mine if within else []) + theirs
    if not mine or not every:
        return
    low = np.stack([z[b].min(axis=0) for b in every])
    high = np.stack([z[b].max(axis=0) for b in every])
    for n, box in enumerate(mine):
        a, b = z[box].min(axis=0), z[box].max(axis=0)
        gaps = np.maximum(0, np.maximum(low - b, a - high))
        near = (gaps ** 2).sum(axis=1) <= budget
        if within:
            near[:n] = False  # an earlier box has met this one
        some = [every[i] for i in np.flatnonzero(near)]
        if not some:
            continue
        other = np.concatenate(some)
        gap = squares[box][:, None] + squares[other][None, :] - 2 * (z[box] @ z[other].T)
        hit = gap <= budget
        if within:  # its own box comes first: each pair of it once
            hit[:, :len(box)] &= ~np.tri(len(box), dtype=bool)
        i, j = np.nonzero(hit)
        for at in range(0, len(i), PAIRS):
            yield box[i[at:at + PAIRS]], other[j[at:at + PAIRS]]


class Forest:
    """The links that connect what no earlier link has connected."""

    def __init__(self, n: int):
        self.root, self.links = np.arange(n), []

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        a, b = self.root[i], self.root[j]
        new = np.flatnonzero(a != b)
        if not len(new):
            return
        _, first = np.unique(np.stack([a[new], b[new]]), axis=1, return_index=True)
        up: dict[int, int] = {}

        def find(x):
            while x in up:
                x = up[x]
            return x

        for n in new[first].tolist():
            x, y = find(int(a[n])), find(int(b[n]))
            if x != y:
                up[max(x, y)] = min(x, y)
                self.links.append((int(i[n]), int(j[n])))
        final = np.arange(len(self.root))
        for x in sorted(up):  # parents are smaller, hence done
            final[x] = final[up[x]]
        self.root = final[self.root]


def meet(block_dims: int, min_cosine: float):
    """Links of one task: numbers of links and a spanning forest."""

    def run(table: pa.Table) -> pa.Table:
        dim, block = table.column("dim")[0].as_py(), table.column("block")[0].as_py()
        nodes = table.column("node").to_numpy()
        weight = table.column("w").to_numpy()
        right = table.column("side").to_numpy() == 1
        raw = _matrix(table.column("v"), dim)
        if len(np.unique(nodes)) < len(nodes):  # repeated rows of one id and vector
            _, first = np.unique(np.c_[nodes, raw.view(np.int64)], axis=0, return_index=True)
            nodes, weight, right, raw = nodes[first], weight[first], right[first], raw[first]
        rows = unit_rows(raw)
        norms = np.sqrt(inner(rows, rows))
        y = rotated(rows, norms)
        starts, budgets = blocks_of(dim, block_dims, min_cosine)
        end = starts[block] + block_dims
        z = np.ascontiguousarray(y[:, starts[block]:end])
        within = table.column("kind")[0].as_py() == 1 and table.column("hi")[0].as_py() == 0
        links, forest = np.zeros(len(nodes), np.int64), Forest(len(nodes))
        for i, j in candidates(z, np.flatnonzero(~right), np.flatnonzero(right), within,
                               budgets[block]):
            gap = np.add.reduceat((y[i] - y[j]) ** 2, starts, axis=1)
            own = (gap <= budgets + SLACK)
            ok = own[:, block] & ~own[:, :block].any(axis=1) & (nodes[i] != nodes[j])
            i, j = i[ok], j[ok]
            ok = inner(rows[i], rows[j]) / (norms[i] * norms[j]) >= min_cosine
            i, j = i[ok], j[ok]
            np.add.at(links, i, weight[j])
            np.add.at(links, j, weight[i])
            forest.add(i, j)
        found = np.flatnonzero(links)
        tree = nodes[np.array(forest.links, np.int64).reshape(-1, 2)]
        return pa.table({
            "node": pa.array(np.r_[nodes[found], tree[:, 0]], pa.int64()),
            "other": pa.array([None] * len(found) + tree[:, 1].tolist(), pa.int64()),
            "n": pa.array(np.r_[links[found], np.zeros(len(tree), np.int64)], pa.int64())})

    return run


def _tasks(placed: DataFrame, slab_rows: int) -> DataFrame:
    """Each vector once for every task in which it may meet a partner."""
    cell = ["label", "dim", "block", "slab"]
    parts = F.greatest(F.lit(1), F.ceil(F.col("rows") / F.lit(float(slab_rows)))).cast("int")
    along = Window.partitionBy("label", "dim", "block").orderBy("slab")

    def at(step, what):  # of the neighbouring slab, 0 if it is empty
        there = what("slab", 1).over(along) == F.col("slab") + step
        return F.when(there, what("own", 1).over(along)).otherwise(0)

    sizes = (placed.groupBy(*cell).agg(F.count(F.lit(1)).alias("rows"))
             .select(*cell, parts.alias("own")))
    # Few slabs a block: at most 2 / radius.
    sizes = settle(sizes.select("*", at(1, F.lead).alias("up"), at(-1, F.lag).alias("down")),
                   "slabs")
    met = placed.join(sizes.select(*[F.col(c).alias(f"s_{c}") for c in cell], "own", "up", "down"),
                      [F.col(c) == F.col(f"s_{c}") for c in cell], "left")
    met = met.withColumn("p", F.pmod(F.xxhash64("node"), F.col("own")).cast("int"))

    def task(slab, kind, lo, hi, side):
        return F.struct(slab.alias("slab"), F.lit(kind).alias("kind"), lo.alias("lo"),
                        hi.alias("hi"), side.cast("int").alias("side"))

    p, slab = F.col("p"), F.col("slab")
    beside = F.transform(F.filter(F.sequence(F.lit(0), F.col("own") - 1), lambda q: q != p),
                         lambda q: task(slab, 0, F.least(p, q), F.greatest(p, q), q < p))
    above = F.transform(F.sequence(F.lit(0), F.greatest(F.col("up"), F.lit(1)) - 1),
                        lambda q: task(slab, 1, p, q, F.lit(0)))
    below = F.when(F.col("down") > 0, F.transform(
        F.sequence(F.lit(0), F.greatest(F.col("down"), F.lit(1)) - 1),
        lambda q: task(slab - 1, 1, q, p, F.lit(1))))
    spots = F.concat(beside, above, F.coalesce(below, F.slice(above, 1, 0)))
    return met.select("label", "dim", "block", "node", "w", "v",
                      F.explode(spots).alias("t")).select(
        "label", "dim", "block", "node", "w", "v", "t.*")


def near_duplicates(vectors: DataFrame, min_cosine: float = 0.93, block_dims: int = 16,
                    slab_rows: int = 16384) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row for each row of
    ``vectors`` (vec_id, label, embedding).

    Vectors of equal, non-null labels link when their cosine is ``min_cosine``
    (above 0) or more. n_links counts the other ids linked directly, exact
    copies included; component_id is the smallest vec_id reachable; kept tells
    whether that is the row's own.

    Defined cases: vectors that are null, empty or zero, or hold null or
    non-finite components, and rows with a null label link with nothing and
    keep their own id; a row without vec_id takes no part (component_id null,
    kept false); rows that repeat id, label and vector are one vector, each
    with its result; an id with several vectors has the links of all; vectors of
    different lengths do not link; very long vectors only widen the blocks'
    number; an empty table gives no rows; other columns are not read.
    """
    x = F.col("embedding")
    fit = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull()
           & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
           & F.exists(x, lambda c: c != 0))
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), "label", x.alias("v"),
        F.size(x).alias("dim"), F.when(F.coalesce(fit, F.lit(False)), F.struct(
            F.xxhash64("label", x).alias("a"), F.xxhash64(F.lit(1), "label", x).alias("b"))
        ).alias("h"))
    fitting = rows.where(F.col("h").isNotNull())
    copies = settle(fitting.select("vec_id", "h").distinct().groupBy("h").agg(
        F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("w")).where("w > 1"), "copies")
    units = (spread_join(fitting, copies, "h", "vec_id")
             .where(F.col("node").isNull() | (F.col("node") == F.col("vec_id")))
             .select(F.col("vec_id").alias("node"), F.coalesce("w", F.lit(1)).cast("long").alias("w"),
                     "label", "dim", "v"))
    placed = units.mapInArrow(place(block_dims, min_cosine), T.StructType(
        [*units.schema, T.StructField("block", T.IntegerType()),
         T.StructField("slab", T.IntegerType())]))
    found = settle(_tasks(placed, slab_rows).groupBy(*KEY).applyInArrow(
        meet(block_dims, min_cosine), "node long, other long, n long"), "found")
    counts = found.where(F.col("other").isNull()).groupBy("node").agg(F.sum("n").alias("links"))
    roots = components(found.where(F.col("other").isNotNull()).select(
        F.col("node").alias("a"), F.col("other").alias("b")))
    linked = settle(counts.join(roots, "node", "left"), "linked")
    groups = copies.join(linked, "node", "left").select(
        "h", F.coalesce("root", "node").alias("g_root"),
        (F.col("w") - 1 + F.coalesce("links", F.lit(0))).alias("g_links"))
    out = spread_join(rows.select("vec_id", "h"), groups, "h", "vec_id")
    single = linked.select(F.col("node").alias("at"), "links", F.col("root").alias("s_root"))
    out = out.withColumn("at", F.when(F.col("h").isNotNull(), F.col("vec_id"))).join(
        single, "at", "left")
    component = F.coalesce("g_root", "s_root", "vec_id")
    return out.select(
        "vec_id", F.coalesce("g_links", "links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
