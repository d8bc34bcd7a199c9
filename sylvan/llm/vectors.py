"""Blocks for searches over vectors: shards of the table against blocks of queries.

A search takes a stated query set against all rows. Rows are dealt to
shards and queries to blocks, both by a hash of id and vector and both of
bounded size; a task gets one shard and one block, builds or uses the
shard's index and returns the block's best of that shard; a window over a
query's few best per shard gives the answer. Nothing grows in one task.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sylvan.llm.common import written


def usable(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``id, v`` of the rows that take part: id and vector not null, every component finite."""
    rows = table.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & (F.size("v") > 0)
    return rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull()).filter(fine)


def search(
    rows: DataFrame,
    is_query: Column,
    k: int,
    local: Callable[[np.ndarray, np.ndarray, "Points"], tuple[np.ndarray, np.ndarray, np.ndarray]],
    score_type: str,
    shard_rows: int = 8192,
    block_rows: int = 4096,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best of ``rows`` (``id, v``) for each row that ``is_query`` admits.

    Rows equal in id and vector are one row with a number of copies, so
    copies make no shard larger; each copy of a query is answered, and the
    other copies are candidates like any other row. ``local(query keys,
    query vectors, points)`` returns the numbers of queries, row ids and
    scores of one shard's best for one block. Vectors of different lengths
    never meet (each length is a shard of its own).
    """
    rows = rows.groupBy("id", "v").agg(F.count(F.lit(1)).alias("copies"))
    rows = written(rows.withColumn("key", F.monotonically_increasing_id()).withColumn("dim", F.size("v")), "vectors")
    queries = written(rows.filter(is_query), "queries")  # a table of its own: the two sides of a cogroup may not share columns
    shards = max(1, -(-rows.count() // shard_rows))
    blocks = max(1, -(-queries.count() // block_rows))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    deal = lambda n, seed: F.pmod(F.xxhash64("id", "v", F.lit(seed)), F.lit(n)).cast("int")
    right = rows.select("*", deal(shards, 1).alias("shard"), every(blocks).alias("block"))
    left = queries.select("*", deal(blocks, 2).alias("block"), every(shards).alias("shard"))

    def run(key, q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(r):
            return pd.DataFrame({"key": [], "query_id": [], "copies": [], "vec_id": [], "score": []})
        q = q.sort_values("key")
        keys, ids, copies = (q[c].to_numpy() for c in ("key", "id", "copies"))
        points = Points(r["id"].to_numpy(), r["key"].to_numpy(), r["copies"].to_numpy(), np.stack(r["v"].to_numpy()))
        n, vec, s = local(keys, np.stack(q["v"].to_numpy()), points)
        return pd.DataFrame({"key": keys[n], "query_id": ids[n], "copies": copies[n], "vec_id": vec, "score": s})

    group = ["shard", "block", "dim"]
    schema = f"key long, query_id long, copies long, vec_id long, score {score_type}"
    best = left.groupBy(*group).cogroup(right.groupBy(*group)).applyInPandas(run, schema)
    w = Window.partitionBy("key").orderBy(F.col("score").desc(), "vec_id")
    best = best.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    out = ["query_id", "rank", "vec_id", "score"]
    return best.select(*out, F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select(*out)


class Points:
    """The different vectors of a shard and the rows of each: those of vector i begin at starts[i], by id."""

    def __init__(self, ids: np.ndarray, keys: np.ndarray, copies: np.ndarray, rows: np.ndarray):
        flat = np.ascontiguousarray(rows + 0.0)  # -0.0 and 0.0 are one
        raw = flat.view(np.dtype((np.void, flat.dtype.itemsize * flat.shape[1]))).ravel()
        _, first, inverse = np.unique(raw, return_index=True, return_inverse=True)
        order = np.lexsort((ids, inverse))
        self.vectors = flat[first]
        self.starts = np.searchsorted(inverse[order], np.arange(len(first) + 1))
        self.ids, self.keys, self.copies = ids[order], keys[order], copies[order]
        self.least = self.ids[self.starts[:-1]]

    def expand(self, best: "Best", query_keys: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of the best different vectors, but for the query's own: (query number, row id, place in ``best``), of one vector the k least ids, since no more can be among the k best."""
        out: list[tuple[int, int, int]] = []
        for n, own in enumerate(query_keys):
            for place, w in enumerate(best.which[n]):
                if w < 0:
                    continue
                left = k
                for at in range(self.starts[w], self.starts[w + 1]):
                    rows = min(left, int(self.copies[at]) - int(self.keys[at] == own))
                    out += [(n, self.ids[at], place)] * rows
                    left -= rows
                    if not left:
                        break
        return tuple(np.array(out, dtype=np.int64).reshape(-1, 3).T)


class Best:
    """The best ``k`` different vectors of each query so far, by exact score, ties to the least id.

    Vectors come with approximate scores, right within ``slack``; those that
    may be among the best by these are scored exactly, ``exact(numbers of
    queries, numbers of vectors)``, and only exact scores are compared.
    """

    #: Pairs scored exactly at a time.
    PAIRS = 8192

    def __init__(self, queries: int, k: int, slack: float, exact: Callable[[np.ndarray, np.ndarray], np.ndarray], dtype: type = np.float64):
        self.slack, self.exact = slack, exact
        self.none = np.iinfo(dtype).min if np.issubdtype(dtype, np.integer) else -np.inf
        self.score = np.full((queries, k), self.none, dtype=dtype)
        self.which = np.full((queries, k), -1, dtype=np.int64)
        self.least = np.full((queries, k), np.iinfo(np.int64).max)

    def add(self, q: np.ndarray, which: np.ndarray, least: np.ndarray, near: np.ndarray) -> None:
        """Vectors ``which`` (least ids ``least``) against queries ``q``; ``near``: approximate scores, q x which."""
        k, many = self.score.shape[1], near.shape[1]
        floor = self.bound(q)
        if many > k:
            floor = np.maximum(floor, np.partition(near, many - k, axis=1)[:, many - k] - self.slack)
        r, c = np.nonzero(near >= (floor - self.slack)[:, None])
        if not len(r):
            return
        score = np.full(near.shape, self.none, dtype=self.score.dtype)
        taken = np.full(near.shape, -1, dtype=np.int64)
        taken[r, c] = which[c]
        for at in range(0, len(r), self.PAIRS):
            i, j = r[at : at + self.PAIRS], c[at : at + self.PAIRS]
            score[i, j] = self.exact(q[i], which[j])
        some = np.unique(r)
        q, score, taken = q[some], score[some], taken[some]
        s = np.concatenate([self.score[q], score], axis=1)
        w = np.concatenate([self.which[q], taken], axis=1)
        i = np.concatenate([self.least[q], np.broadcast_to(least, score.shape)], axis=1)
        i[w < 0] = np.iinfo(np.int64).max
        falling = ~s if np.issubdtype(s.dtype, np.integer) else -s
        order = np.lexsort((i, falling), axis=1)[:, :k]
        self.score[q], self.which[q], self.least[q] = (np.take_along_axis(x, order, axis=1) for x in (s, w, i))

    def bound(self, q: np.ndarray) -> np.ndarray:
        """The score a new vector must reach."""
        return np.where(self.which[q, -1] < 0, -np.inf, self.score[q, -1].astype(float))
