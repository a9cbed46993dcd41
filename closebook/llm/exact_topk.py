"""Exact top-k search by inner product with two cover trees.

Method: the data of a shard and each block of its queries are indexed in a cover
tree each, and both are descended together. No inner product between the points
of two nodes exceeds that of their centres by more than the covering radii
allow; a pair of nodes is pruned when that bound is below the worst k-th score
among the query node's points, or the floors that they bring from the sample.
Scores of integer vectors are computed exactly.

A node's children are a net: ``ARITY`` centres, each the point farthest from
those before, and every point belongs to its nearest centre. So at every level
the centres are at least the covering radius apart, and no child is wider than
that radius, down to leaves of ``LEAF`` points or of equal ones.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closebook.llm import vectors as V

LEAF = 64
ARITY = 16
EMPTY = -np.iinfo(np.int64).max


class Node:
    """points: indices in the subtree, its centre first; center, radius cover
    them all."""

    __slots__ = ("points", "center", "radius", "norm", "children", "centers", "radii", "norms")

    def __init__(self, rows: np.ndarray, points: np.ndarray, gaps: np.ndarray | None = None):
        self.points, self.center = points, rows[points[0]]
        gaps = distances(rows[points], self.center) if gaps is None else gaps
        self.radius, self.norm = float(gaps.max()), float(np.linalg.norm(self.center))
        self.children = self._split(rows, gaps) if len(points) > LEAF and self.radius else []
        if self.children:
            self.centers = np.stack([c.center for c in self.children])
            self.radii = np.array([c.radius for c in self.children])
            self.norms = np.array([c.norm for c in self.children])

    def _split(self, rows: np.ndarray, gaps: np.ndarray) -> list[Node]:
        """A farthest-first net, the node's own centre first."""
        mine, near, of, first = rows[self.points], gaps, np.zeros(len(gaps), int), [0]
        while len(first) < ARITY and near.max() > 0:
            first.append(int(near.argmax()))
            gap = distances(mine, mine[first[-1]])
            of[gap < near] = len(first) - 1
            near = np.minimum(near, gap)
        children = []
        for c, center in enumerate(first):
            own = np.flatnonzero(of == c)
            own = np.r_[center, own[own != center]]
            children.append(Node(rows, self.points[own], near[own]))
        return children


def distances(rows: np.ndarray, point: np.ndarray) -> np.ndarray:
    return np.sqrt(((rows - point) ** 2).sum(axis=1))


def search(k: int):
    """Index and queries in one call."""
    return lambda qids, queries, ids, rows: index(k)(ids, rows)(qids, queries)


def index(k: int) -> V.Build:
    """Of the rows of one shard, the k highest inner products of each query with
    rows of other ids, ties to the smaller id."""

    def build(ids, rows):
        # Levels may peel off a few far points each, so trees may be deep.
        sys.setrecursionlimit(max(sys.getrecursionlimit(), 50_000))
        keep = V.first_copies(ids, rows, k + 1)
        ids, rows = ids[keep], rows[keep]
        tree = Node(rows.astype(float), np.arange(len(rows))) if rows.size else None
        return lambda qids, queries, floors=None: ask(ids, rows, tree, qids, queries, floors)

    def ask(ids, rows, tree, qids, queries, floors):
        # Integers below 2^53 are exact as doubles, and so are their sums.
        peak = max(np.abs(queries).max(initial=0), np.abs(rows).max(initial=0))
        exact = float(peak) ** 2 * max(rows.shape[1], 1) < 2 ** 53
        q, r = queries.astype(float), rows.astype(float)
        floors = np.full(len(q), -np.inf) if floors is None else floors
        best = np.full((len(q), k), EMPTY, np.int64)
        found = np.full((len(q), k), np.iinfo(np.int64).max, np.int64)

        def score(a, b):
            if exact:
                return (q[a] @ r[b].T).astype(np.int64)
            return queries[a] @ rows[b].T

        def least(a):  # the scores that queries still need
            return np.maximum(best[a, -1], floors[a])

        def base(a, b):
            s = score(a, b)
            s[qids[a][:, None] == ids[b][None, :]] = EMPTY
            hit = s >= least(a)[:, None]
            some = hit.any(axis=1) if len(b) else np.zeros(len(a), bool)
            if not some.any():
                return
            cols = hit.any(axis=0)
            a, s, b = a[some], s[some][:, cols], b[cols]
            best[a], found[a] = V.best_of(
                np.concatenate([best[a], s], axis=1),
                np.concatenate([found[a], np.broadcast_to(ids[b], s.shape)], axis=1), k)

        def bound(qc, qr, qn, rc, rr, rn):
            top = rc @ qc + qr * rn + rr * qn + qr * rr
            return top + 1e-9 * (np.abs(top) + 1)

        def descend(a: Node, b: Node):
            if not a.children and not b.children:
                base(a.points, b.points)
            elif b.children and (not a.children or b.radius >= a.radius):
                tops = bound(a.center, a.radius, a.norm, b.centers, b.radii, b.norms)
                for i in np.argsort(-tops, kind="stable"):
                    if tops[i] < least(a.points).min():
                        break
                    descend(a, b.children[i])
            else:
                tops = bound(b.center, b.radius, b.norm, a.centers, a.radii, a.norms)
                for i, child in enumerate(a.children):
                    if tops[i] >= least(child.points).min():
                        descend(child, b)

        if len(q) and len(r):
            if rows.shape[1]:
                descend(Node(q, np.arange(len(q))), tree)
            else:
                base(np.arange(len(q)), np.arange(len(r)))
        return V.flat_results(qids, best, found, EMPTY)

    return build


def exact_top_k(vectors: DataFrame, is_query: Column, k: int = 5, shard_rows: int = 8192,
                block_rows: int = 4096) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest inner products
    with other rows of ``vectors`` (vec_id, v: array of long), all if fewer.

    Defined cases: rows without an id, and null vectors, take no part; equal
    scores go to the smaller vec_id; rows that share an id are one row, with the
    smallest vector; vectors of different lengths do not meet, empty ones score
    0 with each other; an empty table gives no rows; other columns are not read.
    """
    rows = V.one_row_an_id(vectors.select("vec_id", "v").where("vec_id IS NOT NULL AND v IS NOT NULL"))
    return V.top_k(rows, is_query, k, index(k), "long", shard_rows, block_rows, *V.sample(rows))


def quantized(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """Usable vectors as integers: floor(scale * x), x as double."""
    whole = F.transform("v", lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))
    return V.usable(vectors).select("vec_id", whole.alias("v"))
