"""Approximate nearest neighbours by cosine: a vantage-point tree per shard.

Method: each shard's unit vectors form a vantage-point tree; a query (all
queries of a block at once) visits the nearer side of a node first and the
other side only if the triangle inequality leaves room, where the room is
the distance of the query's k-th best so far times ``relax``. ``relax`` = 1
is exact search; below it, more is pruned.

Equal vectors are one point of the tree. The score is the cosine of the
original vectors in double precision; products of unit vectors only tell
which points may be among the best, so collinear vectors rank by their
scores, and by id where these are equal.

Defined cases: vectors that are null, empty, zero, or hold null or
non-finite components take no part, nor do null ids; rows that share an id
are rows of their own, each a query and each a candidate of the others,
equal ones included; vectors of different lengths are never compared; ties
go to the smaller id; with fewer candidates than k all are returned; empty
tables give an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sylvan.llm.vectors import Best, Points, search, usable

LEAF = 128
#: Rounding of a distance that comes from a product of unit vectors, at its worst near zero.
NEAR_ZERO = 2e-6


@dataclass
class Node:
    point: int = -1  # the vantage point
    radius: float = 0.0  # median distance from it
    inside: "Node | None" = None
    outside: "Node | None" = None
    members: np.ndarray | None = None  # of a leaf


def build(x: np.ndarray, members: np.ndarray, rng: np.random.Generator) -> Node:
    """Vantage points are drawn at random; each splits the rest at the median distance."""
    if len(members) <= LEAF:
        return Node(members=members)
    at = int(rng.integers(len(members)))
    point, rest = members[at], np.delete(members, at)
    d = np.linalg.norm(x[rest] - x[point], axis=1)
    order = np.argsort(d, kind="stable")
    half = len(rest) // 2
    return Node(int(point), float(d[order[half]]), build(x, rest[order[:half]], rng), build(x, rest[order[half:]], rng))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def tree_search(points: np.ndarray, least: np.ndarray, queries: np.ndarray, k: int, relax: float, seed: int = 11) -> Best:
    """The k best of ``points`` (by cosine) for each query."""
    x, unit = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (points, queries))
    slack = 1e-15 * max(1000, x.shape[1])  # of products of unit vectors against cosines
    best = Best(len(queries), k, slack, lambda q, w: cosines(queries[q], points[w]))
    root = build(x, np.arange(len(x)), np.random.default_rng(seed))

    def room(q: np.ndarray) -> np.ndarray:
        worst = best.bound(q)
        far = np.sqrt(np.maximum(0, 2 - 2 * np.where(np.isfinite(worst), worst, -1.0)))
        return np.where(np.isfinite(worst), far * relax + NEAR_ZERO, np.inf)

    def visit(node: Node, q: np.ndarray) -> None:
        if not len(q):
            return
        if node.members is not None:
            if len(node.members):
                best.add(q, node.members, least[node.members], unit[q] @ x[node.members].T)
            return
        cos = unit[q] @ x[node.point]
        best.add(q, np.array([node.point]), least[[node.point]], cos[:, None])
        d = np.sqrt(np.maximum(0, 2 - 2 * cos))
        near = d < node.radius
        visit(node.inside, q[near])
        visit(node.outside, q[~near])
        gap = np.abs(d - node.radius)
        open_ = gap <= room(q)
        visit(node.outside, q[near & open_])
        visit(node.inside, q[~near & open_])

    visit(root, np.arange(len(queries)))
    return best


def cosine_neighbours(table: DataFrame, is_query: Column, k: int = 5, relax: float = 0.25, vec_id: str = "vec_id", vector: str = "embedding", **blocks) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest found for each row that ``is_query`` (a condition on ``id``) admits."""

    def local(keys: np.ndarray, queries: np.ndarray, points: Points):
        best = tree_search(points.vectors, points.least, queries, k + 1, relax)
        n, ids, place = points.expand(best, keys, k)
        return n, ids, best.score[n, place]

    rows = usable(table, vec_id, vector).filter(F.exists("v", lambda x: x != 0))
    return search(rows, is_query, k, local, "double", **blocks)
