"""What the two vector searches share: usable rows, shards, first bounds, merging.

Vectors are dealt to cells around pivots, which are means of a bounded sample
(``SAMPLE`` rows in expectation, by the hash of the id); every row is assigned.
A cell of more than ``shard_rows`` vectors is cut in parts by hash. No inner
product of a query with a vector of a cell exceeds that with the pivot by more
than the query's norm times the cell's radius, and the query's k-th best score
within the sample is a floor of its k-th best of all. So a query visits only the
shards whose bound reaches its floor; where the vectors have structure these are
few, where they have none it is all of them.

Each shard is one group of a sorted stream: its vectors come first and are
indexed once, then its queries pass by, a batch at a time. A grouped top-k joins
the shards.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from closebook.llm.common import settle

#: Index of a shard: build(ids, rows) gives ask(query ids, queries, floors), which
#: gives (query ids, vec ids, scores).
Build = Callable[[np.ndarray, np.ndarray], Callable[..., tuple]]
#: {length: (ids, rows as doubles)}
Sample = dict[int, tuple[np.ndarray, np.ndarray]]

SAMPLE = 4096
PIVOTS = 256
ROUNDS = 4
SLACK = 1e-9  # of floats against exact scores


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): rows with an id and a vector without null or non-finite
    components. Rows that repeat an id and a vector are one row."""
    x = F.col("embedding")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & x.isNotNull() & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"), x.alias("v"))


def one_row_an_id(vectors: DataFrame) -> DataFrame:
    """Of rows that share an id the one with the smallest vector. Only ids are
    counted; vectors are shuffled for ids that repeat, and for no others."""
    again = settle(vectors.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                   .select("vec_id"), "repeated-ids")
    if again.isEmpty():
        return vectors
    twice = vectors.join(again, "vec_id", "left_semi").groupBy("vec_id").agg(F.min("v").alias("v"))
    return vectors.join(again, "vec_id", "left_anti").unionByName(twice)


def matrix(table: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors (all of one length)."""
    flat = table.column("v")
    if isinstance(flat, pa.ChunkedArray):
        flat = pa.concat_arrays(flat.chunks)
    ids = table.column("vec_id").to_numpy()
    return ids, flat.flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)


def sample(vectors: DataFrame) -> tuple[Sample, int]:
    """Some ``SAMPLE`` vectors (all, if fewer), chosen by the hash of their id, by
    length; and how many rows each stands for."""
    each = max(1, vectors.count() // SAMPLE)
    rows = vectors.where(F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(each)) == 0).select(
        "vec_id", F.col("v").cast("array<double>").alias("v")).orderBy("vec_id").toArrow()
    dims = np.array([len(v) for v in rows.column("v")], dtype=int)
    return {int(d): matrix(rows.filter(pa.array(dims == d))) for d in np.unique(dims)}, each


def pivots(rows: np.ndarray, n: int) -> np.ndarray:
    """At most ``n`` means of the rows, by rounds of assignment and averaging."""
    centers = np.unique(rows, axis=0)
    centers = centers[np.linspace(0, len(centers) - 1, min(n, len(centers))).astype(int)]
    for _ in range(ROUNDS):
        of = nearest_center(rows, centers)
        used = np.unique(of)
        centers = np.stack([rows[of == c].mean(axis=0) for c in used])
    return centers


def nearest_center(rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
    out = np.empty(len(rows), np.int64)
    for at in range(0, len(rows), 4096):
        part = rows[at:at + 4096]
        out[at:at + 4096] = ((centers ** 2).sum(axis=1) - 2 * part @ centers.T).argmin(axis=1)
    return out


def _lengths(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    dims = batch.column("dim").to_numpy()
    for dim in np.unique(dims).tolist():
        yield dim, batch.filter(pa.array(dims == dim))


def _assign(centers: dict[int, np.ndarray]):
    """Cell of each vector, and its distance from the cell's pivot."""

    def run(batches):
        for batch in batches:
            for dim, own in _lengths(batch):
                rows = matrix(own)[1].astype(float)
                middle = centers.get(dim, np.zeros((1, dim)))
                of = nearest_center(rows, middle) if dim else np.zeros(len(rows), np.int64)
                gap = np.sqrt(((rows - middle[of]) ** 2).sum(axis=1))
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, pa.array(of.astype(np.int32)), pa.array(gap)],
                    [*own.schema.names, "cell", "gap"])

    return run


def floors(ids: np.ndarray, queries: np.ndarray, some: tuple[np.ndarray, np.ndarray] | None,
           k: int) -> np.ndarray:
    """A floor of each query's k-th best score over other rows, from the sample."""
    if some is None or len(some[0]) <= k:
        return np.full(len(ids), -np.inf)
    out = np.empty(len(ids))
    for at in range(0, len(ids), 1024):
        s = queries[at:at + 1024] @ some[1].T
        s[ids[at:at + 1024, None] == some[0][None, :]] = -np.inf
        out[at:at + 1024] = np.partition(s, -k, axis=1)[:, -k]
    return out - SLACK * (np.abs(out) + 1)


def _route(centers, cells, some: Sample, k: int):
    """Each query once for every shard that may hold one of its k best."""

    def run(batches):
        for batch in batches:
            for dim, own in _lengths(batch):
                ids, rows = matrix(own)
                q = rows.astype(float)
                known = [(c, *cells[dim, c]) for c in range(len(centers.get(dim, [0])))
                         if (dim, c) in cells]
                if not known:
                    continue
                number, parts, radius = (np.array(x) for x in zip(*known))
                middle = centers.get(dim, np.zeros((1, dim)))[number]
                bound = q @ middle.T + np.linalg.norm(q, axis=1)[:, None] * radius[None, :]
                low = floors(ids, q, some.get(dim), k)
                at, cell = np.nonzero(bound + SLACK * (np.abs(bound) + 1) >= low[:, None])
                times = parts[cell]
                at, cell = np.repeat(at, times), np.repeat(cell, times)
                part = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
                for s in range(0, len(at), 8192):
                    rows_of = own.take(pa.array(at[s:s + 8192]))
                    yield pa.RecordBatch.from_arrays(
                        [rows_of.column("vec_id"), rows_of.column("v"), rows_of.column("dim"),
                         pa.array(number[cell[s:s + 8192]].astype(np.int32)),
                         pa.array(part[s:s + 8192].astype(np.int32)),
                         pa.array(low[at[s:s + 8192]])],
                        ["vec_id", "v", "dim", "cell", "part", "floor"])

    return run


def _meet(build: Build, score: pa.DataType, block_rows: int):
    """Indexes each shard's vectors and answers the queries that follow them."""

    def run(batches):
        shard, data, ask = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in ("dim", "cell", "part", "role")], 1)
            cuts = np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1)) + 1
            for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
                if shard != tuple(keys[s, :3]):
                    shard, data, ask = tuple(keys[s, :3]), [], None
                rows = batch.slice(s, e - s)
                if keys[s, 3] == 0:
                    data.append(rows)
                    continue
                if ask is None and data:
                    ask, data = build(*matrix(pa.Table.from_batches(data))), []
                for at in range(0, rows.num_rows if ask else 0, block_rows):
                    block = rows.slice(at, block_rows)
                    qids, vec_ids, scores = ask(*matrix(block), block.column("floor").to_numpy())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(qids, pa.int64()), pa.array(vec_ids, pa.int64()),
                         pa.array(scores, score)], ["query_id", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int, build: Build, score_type: str,
          shard_rows: int, block_rows: int, some: Sample, each: int) -> DataFrame:
    """(query_id, rank, vec_id, score) of ``vectors`` (vec_id, v; one row an id),
    with what ``sample`` gave. Vectors meet those of their own length only.

    One row a cell reaches the driver: at most ``PIVOTS`` for each length.
    """
    centers = {dim: pivots(rows, min(PIVOTS, max(1, -(-len(rows) * each // shard_rows))))
               for dim, (_, rows) in some.items() if dim}
    kind = vectors.schema["v"].dataType.simpleString()
    rows = vectors.select("vec_id", "v", F.size("v").alias("dim"),
                          F.coalesce(is_query, F.lit(False)).alias("asked"))
    placed = settle(rows.mapInArrow(
        _assign(centers), f"vec_id long, v {kind}, dim int, asked boolean, cell int, gap double"),
        "placed")
    found = placed.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("n"),
                                              F.max("gap").alias("radius")).collect()
    cells = {(r["dim"], r["cell"]): (-(-r["n"] // shard_rows), r["radius"] * (1 + SLACK))
             for r in found}
    spark = vectors.sparkSession
    parts = spark.createDataFrame([(d, c, p) for (d, c), (p, _) in cells.items()],
                                  "dim int, cell int, parts int")
    data = placed.join(F.broadcast(parts), ["dim", "cell"]).select(
        "vec_id", "v", "dim", "cell",
        F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("parts")).cast("int").alias("part"),
        F.lit(None).cast("double").alias("floor"), F.lit(0).alias("role"))
    asked = placed.where("asked").select("vec_id", "v", "dim").mapInArrow(
        _route(centers, cells, some, k),
        f"vec_id long, v {kind}, dim int, cell int, part int, floor double")
    met = data.unionByName(asked.withColumn("role", F.lit(1))).repartition(
        "dim", "cell", "part").sortWithinPartitions("dim", "cell", "part", "role", "vec_id")
    score = pa.int64() if score_type == "long" else pa.float64()
    answers = met.mapInArrow(_meet(build, score, block_rows),
                             f"query_id long, vec_id long, score {score_type}")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (answers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def first_copies(ids: np.ndarray, rows: np.ndarray, keep: int) -> np.ndarray:
    """Indices without the copies that cannot rank: of equal vectors only the
    ``keep`` smallest ids can be among a query's best keep - 1 other rows."""
    if not len(ids) or not rows.shape[1]:
        return np.argsort(ids, kind="stable")[:keep]
    _, group = np.unique(rows, axis=0, return_inverse=True)
    order = np.lexsort((ids, group.ravel()))
    g = group.ravel()[order]
    place = np.arange(len(g)) - np.searchsorted(g, g)
    return np.sort(order[place < keep])


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best columns of each row: highest score, then smallest id."""
    order = np.lexsort((ids, -scores), axis=1)[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def flat_results(qids: np.ndarray, scores: np.ndarray, ids: np.ndarray, none) -> tuple:
    """Rows of the filled places of a (queries x k) result."""
    filled = scores != none
    return np.repeat(qids, filled.sum(1)), ids[filled], scores[filled]
