"""Hard negatives for anchors: Fagin's threshold algorithm over windows of scores.

Method: in a shard of candidates every dimension keeps its own sorted list.
An anchor reads each list from the end that its own sign points to, all
lists to the same depth; every vector met in any list is scored in integers
by random access. What no list has shown yet scores at most the threshold,
the inner product of the anchor with the lists' present frontier. An anchor
keeps one or more windows of scores (least and most) and the k best of each;
it stops once the threshold falls strictly below the kth score of each, or
below its least one. Ties are therefore read to the end.

Two searches follow one another: positives (same label, one open window),
then negatives (another label, one window for each positive's score). Rows
are dealt to shards and anchors to blocks, both of bounded size; for the
positives both within a label, hot labels in as many shards as they need.
Equal vectors of one label are one entry of the lists with its ids, so
copies cost no depth. Anchors of a block read the lists together, so that
scoring is one matrix product a step; a vector that one of them meets is
scored for all.

Scores are exact: in double precision while no sum can reach 2**53, beyond
that with Python's integers; one that does not fit a long is an error.

Defined cases: rows with a null id or label, a vector that is null, empty or
holds a null or non-finite component take no part; rows that agree in id,
label and vector count once; rows that share an id but differ are rows of
their own, also as anchors, and an anchor never meets its own row; vectors
of different lengths are never compared; ties go to the smaller id; fewer
rows than asked are returned as they are, and an anchor without a positive
or negative has no row; empty tables give an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sylvan.llm.common import col, join_counted, written

#: Entries of each list that the first step reads; each step doubles the depth.
FIRST_DEPTH = 16
#: Numbers that one scoring step holds.
STEP_CELLS = 1 << 21
LEAST, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


class Lists:
    """The rows of one shard, equal ones (label and vector) as one entry, and every dimension's entries by value.

    ``ids`` are numbers that win ties when lower; entries are numbered by
    their least one.
    """

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        order = np.lexsort((ids, *vectors.T[::-1], labels))
        ids, labels, vectors = ids[order], labels[order], vectors[order]
        first = np.ones(len(ids), dtype=bool)
        first[1:] = (labels[1:] != labels[:-1]) | (vectors[1:] != vectors[:-1]).any(axis=1)
        begin = np.flatnonzero(first)
        rank = np.argsort(ids[begin], kind="stable")
        self.begin, self.end, self.ids = begin[rank], np.append(begin[1:], len(ids))[rank], ids
        self.labels, self.vectors = labels[begin][rank], vectors[begin][rank]
        self.order = np.argsort(self.vectors, axis=0, kind="stable")

    def frontier(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """The greatest and least values that the lists still hide beyond ``depth`` entries from either end."""
        n, cols = len(self.vectors), np.arange(self.vectors.shape[1])
        return self.vectors[self.order[n - depth - 1], cols], self.vectors[self.order[depth], cols]


def threshold_search(
    lists: Lists, vectors: np.ndarray, labels: np.ndarray, same: bool, owner: np.ndarray, least: np.ndarray, most: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The k best entries of each window, ties to the lower entry: (window, entry, score), and the entries scored.

    Anchors are ``vectors`` with ``labels``; window i belongs to anchor
    ``owner[i]`` and takes scores from ``least[i]`` to ``most[i]`` of entries
    with the anchor's label (``same``) or of any other.
    """
    n = len(lists.vectors)
    up, down = np.maximum(vectors, 0), np.minimum(vectors, 0)
    kept = [np.zeros(0, dtype=np.int64)] * 3
    kth = np.full(len(owner), LEAST)
    live = np.flatnonzero(least <= most)
    seen, depth = np.zeros(n, dtype=bool), 0
    while len(live) and depth < n:
        depth = min(n, max(FIRST_DEPTH, 2 * depth))
        met = np.zeros(n, dtype=bool)
        met[lists.order[:depth]] = True
        met[lists.order[n - depth :]] = True
        new = np.flatnonzero(met & ~seen)
        seen |= met
        anchors = np.unique(owner[live])
        at = np.zeros(len(vectors), dtype=np.int64)
        at[anchors] = np.arange(len(anchors))
        row = at[owner[live]]
        scores = (vectors[anchors] @ lists.vectors[new].T).astype(np.int64)
        fits = (labels[anchors][:, None] == lists.labels[new]) == same
        found = scores[row]
        w, e = np.nonzero(fits[row] & (found >= np.maximum(least, kth)[live][:, None]) & (found <= most[live][:, None]))
        kept = [np.concatenate(x) for x in zip(kept, (live[w], new[e], found[w, e]))]
        order = np.lexsort((kept[1], -kept[2], kept[0]))
        kept = [x[order] for x in kept]
        nth = np.arange(len(order)) - np.searchsorted(kept[0], kept[0])
        kept = [x[nth < k] for x in kept]
        begin = np.searchsorted(kept[0], np.arange(len(owner) + 1))
        full = np.flatnonzero(np.diff(begin) == k)
        kth[full] = kept[2][begin[full + 1] - 1]
        if depth < n:
            high, low = lists.frontier(depth)
            threshold = (up[anchors] @ high + down[anchors] @ low)[row]
            live = live[~((threshold < kth[live]) | (threshold < least[live])).astype(bool)]
    return *kept, int(seen.sum())


def exact(vectors: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as doubles where no sum of products can reach 2**53, else as Python integers."""
    most, least = (float(f(np.abs(x).max(initial=0) for x in (vectors, others))) for f in (max, min))
    if most < 2.0**53 and most * least * vectors.shape[1] < 2.0**53:
        return vectors, others
    whole = np.vectorize(int, otypes=[object])
    return whole(vectors), whole(others)


def search_shard(anchors: pd.DataFrame, rows: pd.DataFrame, same: bool, k: int, percent: tuple[int, int]) -> pd.DataFrame:
    """The best rows of one shard for one block of anchors: ``uid, asked, vec_id, score``, at most k for each score asked.

    ``anchors`` holds ``uid, label, v, asked`` (scores whose ``percent`` are
    the window; for the same label it is open and ``asked`` is one 0),
    ``rows`` holds ``uid, id, label, v``.
    """
    out = {"uid": [], "asked": [], "vec_id": [], "score": []}
    if len(anchors) and len(rows):
        rows = rows.sort_values(["id", "uid"])  # row numbers stand for ids
        lists = Lists(np.arange(len(rows)), rows["label"].to_numpy(), np.stack(rows["v"].to_numpy()))
        vectors, lists.vectors = exact(np.stack(anchors["v"].to_numpy()), lists.vectors)
        uids, labels, ids, row_uids = anchors["uid"].to_numpy(), anchors["label"].to_numpy(), rows["id"].to_numpy(), rows["uid"].to_numpy()
        asked = [np.asarray(x, dtype=np.int64) for x in anchors["asked"]]
        step = max(1, STEP_CELLS // (len(lists.vectors) * max(map(len, asked))))
        for a in range(0, len(anchors), step):
            part = asked[a : a + step]
            owner, score = np.repeat(np.arange(len(part)), [len(x) for x in part]), np.concatenate(part)
            if same:
                least, most = np.full((2, len(score)), [[LEAST], [MOST]])
            else:  # with Python's integers, since a percentage of a long need not fit one
                low, high = ([int(x) * p for x in score] for p in percent)
                least, most = (np.clip(np.array(x, dtype=object), LEAST, MOST).astype(np.int64) for x in ([-(-x // 100) for x in low], [x // 100 for x in high]))
            # one entry more than asked: the anchor's own row may be among them
            w, e, s, _ = threshold_search(lists, vectors[a : a + step], labels[a : a + step], same, owner, least, most, k + 1)
            taken = np.minimum(lists.end[e] - lists.begin[e], k + 1)
            row = lists.ids[np.repeat(lists.begin[e] - (np.cumsum(taken) - taken), taken) + np.arange(taken.sum())]
            w, s = np.repeat(w, taken), np.repeat(s, taken)
            other = row_uids[row] != uids[a + owner[w]]
            w, s, row = w[other], s[other], row[other]
            order = np.lexsort((row, -s, w))
            w, s, row = w[order], s[order], row[order]
            best = np.arange(len(w)) - np.searchsorted(w, w) < k
            w, s, row = w[best], s[best], row[best]
            for name, values in zip(out, (uids[a + owner[w]], score[w], ids[row], s)):
                out[name].append(values)
    return pd.DataFrame({c: np.concatenate([np.zeros(0, dtype=np.int64), *x]) for c, x in out.items()})


def usable(vectors: DataFrame, scale: int, vec_id: str, label: str, vector: str) -> DataFrame:
    """``id, label, v`` of the rows that take part; v holds floor(scale * component) as whole doubles."""
    rows = vectors.select(col(vec_id).cast("long").alias("id"), col(label).cast("long").alias("label"), col(vector).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & (F.size("v") > 0)
    # from 2**53 on every double is whole, and floor as a long could overflow
    floor = lambda x: F.when(F.abs(x * scale) < 2.0**53, F.floor(x * scale).cast("double")).otherwise(x * scale)
    known = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()).filter(fine)
    return known.select("id", "label", F.transform("v", floor).alias("v")).distinct()


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 5,
    percent: tuple[int, int] = (80, 100),
    scale: int = 256,
    vec_id: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    shard_cells: int = 1 << 19,
    block_rows: int = 2048,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    For each anchor (a condition on ``id``) its best ``positives`` other rows
    of the same label, and for each of them the best ``negatives`` rows of
    another label that score from ``percent[0]`` to ``percent[1]`` percent of
    the positive's score. A shard holds about ``shard_cells`` components.
    Every shard meets every block of the second search, so its shuffle grows
    with rows x anchors / ``block_rows``.
    """
    rows = usable(vectors, scale, vec_id, label, vector).withColumn("uid", F.monotonically_increasing_id())
    rows = written(rows.withColumn("anchor", F.coalesce(is_anchor, F.lit(False))).withColumn("dim", F.size("v")), "mining-rows")
    total = rows.count()
    dealt = lambda n, seed: F.pmod(F.xxhash64("uid", F.lit(seed)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def search(asking: DataFrame, keys: list[str], same: bool, k: int) -> DataFrame:
        """The k best rows for each score that an anchor of ``asking`` asks about; shards and blocks within ``keys``."""
        sizes = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.count(F.when(F.col("anchor"), 1)).alias("anchors")).filter("anchors > 0")
        sizes = sizes.select(*keys, "n", F.ceil(F.col("n") * F.col("dim") / shard_cells).cast("int").alias("parts"), F.ceil(F.col("anchors") / block_rows).cast("int").alias("blocks"))
        left = join_counted(asking, sizes, keys, "n", total).select("uid", "label", "v", "asked", *[c for c in keys if c != "label"], dealt("blocks", 2).alias("block"), every("parts").alias("part"))
        right = join_counted(rows, sizes, keys, "n", total).select("uid", "id", "label", "v", *[c for c in keys if c != "label"], dealt("parts", 1).alias("part"), every("blocks").alias("block"))

        def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
            return search_shard(a, b, same, k, percent)

        groups = [*keys, "part", "block"]
        left = left.toDF(*left.columns)  # columns of its own: both sides come from the same table
        best = left.groupBy(*groups).cogroup(right.groupBy(*groups)).applyInPandas(run, "uid long, asked long, vec_id long, score long")
        order = Window.partitionBy("uid", "asked").orderBy(F.col("score").desc(), "vec_id")
        return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    anchors = rows.filter("anchor").select("uid", "id", "label", "v", "dim")
    good = search(anchors.withColumn("asked", F.array(F.lit(0).cast("long"))), ["label", "dim"], True, positives)
    pairs = written(good.select("uid", F.col("vec_id").alias("positive_id"), "rank", F.col("score").alias("positive_score")), "mining-positives")
    asking = anchors.join(pairs.groupBy("uid").agg(F.sort_array(F.collect_set("positive_score")).alias("asked")), "uid")
    hard = search(asking, ["dim"], False, negatives).select("uid", F.col("asked").alias("positive_score"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = pairs.drop("rank").join(anchors.select("uid", F.col("id").alias("anchor_id")), "uid")
    return named.join(hard, ["uid", "positive_score"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
