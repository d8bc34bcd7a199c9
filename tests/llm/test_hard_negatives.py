"""Hard negatives against brute force over all pairs."""

import math
import random

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sylvan.llm import hard_negatives as hn
from sylvan.llm.queries import QUERIES
from sylvan.llm.sql import SQL
from llm_fixtures import SF_ORACLE

ROW = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("label", T.IntegerType()),
    *[T.StructField(n, T.StringType()) for n in ("uid", "score", "dim", "a.b", "part")],
])


def frame(spark, rows):
    return spark.createDataFrame([(i, v, la, *["x"] * 5) for i, v, la in rows], ROW).repartition(3)


def brute(rows, scale=256, k=5, negatives=5, percent=(80, 100)):
    ok = {(i, la, tuple(math.floor(scale * x) for x in v)) for i, v, la in rows if i is not None and la is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for a in (r for r in ok if r[0] % 100 == 0):
        dot = [(sum(x * y for x, y in zip(a[2], b[2])), b) for b in ok if b != a and len(b[2]) == len(a[2])]
        best = sorted((-s, b[0], b) for s, b in dot if b[1] == a[1])[:k]
        for minus, pid, _ in best:
            hard = sorted((-s, b[0]) for s, b in dot if b[1] != a[1] and percent[0] * -minus <= 100 * s <= percent[1] * -minus)[:negatives]
            out += [(a[0], pid, n + 1, nid, -minus, -ms) for n, (ms, nid) in enumerate(hard)]
    return sorted(out)


def mined(df, **how):
    got = hn.mine(df, F.col("id") % 100 == 0, **how)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, got.collect()))


def near(rng, labels=4, dim=6):
    centre = [rng.choice([-1.0, 1.0]) for _ in range(dim)]
    return lambda: [c * rng.choice([0.5, 0.75, 1.0]) + rng.choice([0, 0, 0.125, -0.25]) for c in centre]


def test_against_brute_force_over_shards_and_blocks(spark):
    rng = random.Random(12)
    some = near(rng)
    rows = [(i, some(), rng.randint(0, 3)) for i in range(0, 900)]  # coarse values: many ties and copies
    assert mined(frame(spark, rows), shard_cells=600, block_rows=2) == brute(rows)


def test_hot_label_and_hot_vector(spark):
    rng = random.Random(5)
    some = near(rng)
    hot = some()
    rows = [(i, hot if i % 3 else some(), 7 if i % 5 else rng.randint(0, 5)) for i in range(1, 700)]
    assert mined(frame(spark, rows), shard_cells=400, block_rows=1) == brute(rows)


def test_odd_rows(spark):
    rng = random.Random(6)
    some = near(rng, dim=3)
    rows = [(i, some(), i % 2) for i in range(60)] + [
        (None, some(), 1), (100, None, 1), (100, [], 1), (200, [1.0, None, 0.0], 0), (300, [1.0, float("nan"), 0.0], 0), (300, [1.0, float("inf"), 0.0], 0), (400, some(), None),
        (500, [1.0, 1.0, 1.0], 0), (500, [1.0, 1.0, 1.0], 0), (500, [1.0, 1.0, 0.5], 0), (500, [1.0, 0.9, 0.5], 1),  # an id of several rows
        (600, [1.0, 1.0], 0), (601, [1.0, 1.0], 0), (602, [0.9, 1.0], 1),  # vectors of another length
        (700, [0.0, 0.0, 0.0], 3), (701, [0.0, -0.0, 0.0], 3), (-100, [-1.0, -1.0, -1.0], 1), (800, [1.0], 9),
    ]
    assert mined(frame(spark, rows)) == brute(rows)
    assert mined(frame(spark, [])) == []
    assert mined(frame(spark, rows), positives=2, negatives=1, percent=(50, 120), scale=7) == brute(rows, 7, 2, 1, (50, 120))


def test_scores_beyond_doubles(spark):
    rng = random.Random(8)
    rows = [(i, [float(rng.randint(2**28, 2**28 + 40)) * 4 for _ in range(2)], i % 2) for i in range(80)]
    want = brute(rows, scale=1)
    assert max(r[4] for r in want) > 2**60 and mined(frame(spark, rows), scale=1) == want


def test_a_score_beyond_a_long_is_an_error(spark):
    with pytest.raises(Exception, match="too large"):
        mined(frame(spark, [(0, [1e30], 1), (1, [1e30], 1)]))


def test_stops_early_and_reads_ties():
    """Well separated: few entries are scored. All tied with the kth: read to the end, lowest number first."""
    rng = np.random.default_rng(1)
    x = np.floor(rng.normal(size=(4000, 4)) * 20)
    x[:50] = np.floor(rng.normal(size=(50, 4)) * 3) + 500
    lists = hn.Lists(np.arange(4000), np.zeros(4000, dtype=np.int64), x)
    one, zero = np.array([[9.0, 9.0, 9.0, 9.0]]), np.zeros(1, dtype=np.int64)
    _, e, s, scored = hn.threshold_search(lists, one, zero, True, zero, np.array([hn.LEAST]), np.array([hn.MOST]), 5)
    whole = (x @ one[0]).astype(int)
    assert scored < 1000 and s.tolist() == sorted(whole.tolist(), reverse=True)[:5]
    y = np.array([[i, 100 - i] for i in range(101)], dtype=float)
    lists = hn.Lists(np.arange(101)[::-1].copy(), np.zeros(101, dtype=np.int64), y)
    _, e, s, scored = hn.threshold_search(lists, np.array([[1.0, 1.0]]), zero, True, zero, np.array([hn.LEAST]), np.array([hn.MOST]), 3)
    assert scored == 101 and s.tolist() == [100] * 3 and lists.ids[lists.begin[e]].tolist() == [0, 1, 2]


def test_registered_query_against_sql(spark):
    got = QUERIES["op12_hard_negatives"](spark, SF_ORACLE).toPandas()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF_ORACLE}/embeddings.parquet'")
    want = con.execute(SQL["op12_hard_negatives"]).df()
    order = list(want.columns)
    same = lambda d: d.sort_values(order).reset_index(drop=True).astype("int64")
    assert len(want) and list(got.columns) == order
    pd.testing.assert_frame_equal(same(got), same(want))
