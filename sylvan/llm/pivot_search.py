"""Exact top-k by inner product: a pivot-distance index per shard.

Method: vectors are keyed by their nearest pivot and the distance to it and
sorted by that key. A query expands, pivot by pivot, the annulus of keys
around its own distance; the triangle inequality bounds the score of all
keys further out, so the search stops when no annulus can hold a better
vector. Inner products become distances by one added component that gives
all vectors of a shard the same length.

Scores are exact integers: components are floor(1024 * x). Products in
double precision, exact below 2**53, tell which vectors may be among the
best; these are scored and compared as 64-bit integers, where a sum that
fits is right whatever its parts are.

Defined cases: vectors that are null, empty, or hold null or non-finite
components take no part, nor do null ids; rows that share an id are rows of
their own, each a query and each a candidate of the others, equal ones
included; vectors of different lengths are never compared; ties go to the
smaller id; with fewer candidates than k all are returned; empty tables give
an empty result; a score among a query's best that does not fit a long is an
error.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sylvan.llm.vectors import Best, Points, search, usable

#: Keys of one pivot that a query block reads per step.
STEP = 64


def pivots_of(x: np.ndarray, count: int, rounds: int = 4, seed: int = 5) -> np.ndarray:
    """A few rounds of k-means on a bounded sample of the shard (a shard is bounded itself)."""
    rng = np.random.default_rng(seed)
    p = x[rng.choice(len(x), size=min(count, len(x)), replace=False)].copy()
    sample = x[rng.choice(len(x), size=min(len(x), 4096), replace=False)]
    for _ in range(rounds):
        near = distances(sample, p).argmin(axis=1)
        for i in np.unique(near):
            p[i] = sample[near == i].mean(axis=0)
    return p


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * (a @ b.T)))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of integers."""
    if np.abs((a * b).sum(axis=1)).max(initial=0) >= 2.0**63 * (1 - 1e-9):
        raise OverflowError("an inner product does not fit a long")
    with np.errstate(over="ignore", invalid="ignore"):
        return (a.astype(np.int64) * b.astype(np.int64)).sum(axis=1)


def pivot_search(x: np.ndarray, least: np.ndarray, queries: np.ndarray, k: int) -> Best:
    """The k vectors of largest inner product of each query; all components are integers held as doubles."""
    most = np.abs(queries).max(initial=0) * np.abs(x).max(initial=0) * x.shape[1]
    slack = 0.0 if most < 2**53 else most * x.shape[1] * 2.0**-51  # of products in double precision
    best = Best(len(queries), k, slack, lambda q, w: products(queries[q], x[w]), np.int64)
    norms = (x * x).sum(axis=1)
    top = norms.max(initial=0.0)
    lifted = np.concatenate([x, np.sqrt(np.maximum(0, top - norms))[:, None]], axis=1)
    flat = np.concatenate([queries, np.zeros((len(queries), 1))], axis=1)
    pivots = pivots_of(lifted, max(1, int(np.sqrt(len(x)) / 2)))
    d = distances(lifted, pivots)
    own = d.argmin(axis=1)
    reach = d[np.arange(len(x)), own]
    order = np.lexsort((reach, own))
    begin = np.searchsorted(own[order], np.arange(len(pivots) + 1))
    to = distances(flat, pivots)
    qq = (queries * queries).sum(axis=1)
    # rounding slack of the distances: keys within it of a bound are read
    margin = 1e-6 * (1 + np.sqrt(top) + np.sqrt(qq.max(initial=0.0)))

    def room(q: np.ndarray) -> np.ndarray:
        """A vector that reaches the k-th score lies at most this far from the query."""
        worst = best.bound(q)
        return np.where(np.isfinite(worst), np.sqrt(np.maximum(0, qq[q] + top - 2 * np.where(np.isfinite(worst), worst, 0))) + margin, np.inf)

    # pivots by nearness for each query; those of one pivot and rank expand together
    ranked = np.argsort(to, axis=1, kind="stable")
    for r in range(len(pivots)):
        for p in np.unique(ranked[:, r]):
            q = np.flatnonzero(ranked[:, r] == p)
            keys = order[begin[p] : begin[p + 1]]
            if not len(keys):
                continue
            along = reach[keys]
            start = np.searchsorted(along, to[q, p]) // STEP
            chunks = -(-len(keys) // STEP)
            for out in range(chunks + 1):  # annuli outwards from the query's own distance
                for side in (0, 1) if out else (0,):
                    chunk = start + out if side == 0 else start - out
                    live = (chunk >= 0) & (chunk < chunks)
                    if not live.any():
                        continue
                    lo = along[np.clip(chunk * STEP, 0, len(keys) - 1)]
                    hi = along[np.clip(chunk * STEP + STEP - 1, 0, len(keys) - 1)]
                    gap = np.maximum(0, np.maximum(lo - to[q, p], to[q, p] - hi))
                    live &= gap <= room(q)
                    for c in np.unique(chunk[live]):
                        some, part = q[live & (chunk == c)], keys[c * STEP : (c + 1) * STEP]
                        best.add(some, part, least[part], queries[some] @ x[part].T)
    return best


def inner_product_top(table: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding", **blocks) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k largest integer inner products of each row that ``is_query`` (a condition on ``id``) admits."""

    def local(keys: np.ndarray, queries: np.ndarray, points: Points):
        best = pivot_search(points.vectors, points.least, queries, k + 1)
        n, ids, place = points.expand(best, keys, k)
        return n, ids, best.score[n, place]

    whole = F.transform("v", lambda x: F.floor(x * 1024).cast("double"))
    rows = usable(table, vec_id, vector).select("id", whole.alias("v"))
    return search(rows, is_query, k, local, "long", **blocks)
