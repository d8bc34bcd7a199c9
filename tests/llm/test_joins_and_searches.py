"""Jaccard join, vector searches and the pipeline against brute force."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sylvan.llm import jaccard, pivot_search, vp_search
from sylvan.llm.queries import QUERIES
from llm_fixtures import columns, docs, odd_rows, SF_ORACLE, SF_SMALL, vectors  # noqa: F401


def brute_groups(rows, words=3, percent=90):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set())
    up = {d: d for d, _ in rows if d is not None}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, (a, _) in enumerate(rows):
        for j in range(i):
            b = rows[j][0]
            if a is not None and b is not None and sets[i] and sets[j]:
                common = len(sets[i] & sets[j])
                if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                    x, y = root(a), root(b)
                    up[max(x, y)] = min(x, y)
    return sorted(((d, len(s), None if d is None else root(d)) for (d, _), s in zip(rows, sets)), key=repr)


def copies(rng, bases, n, size=120, edits=6):
    """Texts made of few bases with word edits, so that similarities fall on both sides of the threshold."""
    vocab = [f"v{i}" for i in range(3000)]
    base = [[rng.choice(vocab) for _ in range(size)] for _ in range(bases)]
    passage = [rng.choice(vocab) for _ in range(40)]
    out = []
    for i in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.randint(0, edits)):
            at, kind = rng.randrange(len(w)), rng.random()
            w[at : at + 1] = [rng.choice(vocab)] if kind < 0.6 else [] if kind < 0.8 else [w[at], rng.choice(vocab)]
        if rng.random() < 0.3:
            w = w + passage
        out.append((i * 3 % n if n % 3 else i, " ".join(w).replace("v1", "V1")))
    return out


@pytest.mark.parametrize("seed,words,percent", [(1, 3, 90), (3, 5, 80)])
def test_jaccard_groups_brute_force(docs, odd_rows, monkeypatch, seed, words, percent):
    monkeypatch.setattr(jaccard, "PARTNERS", 3)  # sets with more partners are split
    rng = random.Random(seed)
    rows = copies(rng, 5, 120) + [(1000 + d if d is not None else None, t) for d, t, _, _ in odd_rows]
    # a chain: neighbours are similar, the ends are not, and no set is similar to all
    w = [f"c{i}" for i in range(400)]
    rows += [(2000 + i, " ".join(w[i * 4 : i * 4 + 150])) for i in range(25)]
    got = jaccard.jaccard_groups(docs([(d, t, "en", "s") for d, t in rows]), words, percent)
    assert columns(got, "doc_id", "n_shingles", "component_id") == brute_groups(rows, words, percent)


def test_parity_bits_never_exceed_the_difference():
    rng = np.random.default_rng(5)
    for size, drop, add in [(1, 0, 1), (2, 1, 5), (60, 3, 9), (64, 0, 0), (65, 30, 1), (900, 40, 300), (5000, 5000, 5000)]:
        one = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
        two = np.unique(np.concatenate([one[drop:], rng.integers(0, 2**64, add, dtype=np.uint64)]))
        only = len(np.setxor1d(one, two))
        least = jaccard.differing(jaccard.parity_bits(one), jaccard.parity_bits(two))
        assert least <= only and least % 2 == only % 2  # folding and parity keep the remainder
        assert least == jaccard.differing(jaccard.parity_bits(two), jaccard.parity_bits(one))
    assert least > 1000  # sets with nothing in common are far apart


def test_jaccard_given_table_and_one_per_group(spark, docs, odd_rows):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    want = brute_groups(rows)
    assert columns(QUERIES["op6_jaccard_join"](spark, SF_SMALL), "doc_id", "n_shingles", "component_id") == want
    d = docs(odd_rows)
    out = jaccard.one_per_group(d)
    assert out.columns == d.columns
    got = Counter(r["doc_id"] for r in out.collect())
    assert got == Counter([1, 2, 3, 4, 5, 6, 7, 8, 9, 10, None, None])
    # two of 100 words changed: 0.81 on shingles of five words
    words = [f"w{i}" for i in range(100)]
    near = [w + "x" if i in (30, 70) else w for i, w in enumerate(words)]
    out = jaccard.one_per_group(docs([(12, " ".join(near), "en", "s"), (11, " ".join(words), "en", "s"), (13, " ".join(words[:70]), "en", "s")]))
    assert columns(out, "doc_id") == [(11,), (13,)]
    assert jaccard.one_per_group(docs([])).count() == 0
    assert jaccard.jaccard_groups(docs([])).count() == 0


def test_components_of_long_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(30)] + [(1000, 1000 + i) for i in range(1, 40)] + [(500, 499), (499, 500), (7, 7)]
    got = {r["id"]: r["comp"] for r in jaccard.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, **{1000 + i: 1000 for i in range(40)}, 499: 499, 500: 499}


def vector_rows(rng, n, dim=16):
    x = rng.normal(0, 1, (n, dim)).astype(np.float32)
    x[n // 2 : n // 2 + 30] = x[0]  # equal vectors tie
    return [(i, x[i].tolist()) for i in range(n)]


ODD_VECTORS = [(5000, None), (5050, []), (5100, [0.0] * 16), (5150, [None] + [1.0] * 15), (5200, [float("nan")] * 16), (5250, [float("inf")] + [0.0] * 15), (None, [1.0] * 16), (5300, [1.0, 2.0])]


def exact(rows, divisor, k, score):
    out = []
    for own, (q, a) in enumerate(rows):
        if q % divisor == 0:
            ranked = sorted((-score(a, b), i) for at, (i, b) in enumerate(rows) if at != own and len(a) == len(b))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(ranked)]
    return sorted(out)


def cosine(a, b):
    a, b = np.array(a, float), np.array(b, float)
    return float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())))


def inner(a, b):
    f = lambda v: np.floor(np.array(v, dtype=np.float32).astype(float) * 1024).astype(np.int64)
    return int((f(a) * f(b)).sum())


@pytest.mark.parametrize("blocks", [{}, {"shard_rows": 60, "block_rows": 4}])
def test_searches_are_exact_without_relaxing(vectors, blocks):
    rows = vector_rows(np.random.default_rng(1), 400)
    rows += [*rows[:3], *rows[200:204], *rows[200:202], (50, rows[7][1]), (50, rows[215][1]), (100, rows[8][1]), (101, rows[0][1])]  # repeated rows and ids
    given = vectors(rows + ODD_VECTORS)
    got = vp_search.cosine_neighbours(given, F.col("id") % 50 == 0, k=5, relax=1.0, **blocks)
    want = exact([*rows, (5300, [1.0, 2.0])], 50, 5, cosine)
    g, e = columns(got, "query_id", "rank", "vec_id", "score"), want
    assert [x[:3] for x in g] == [x[:3] for x in sorted(e, key=repr)]
    assert np.allclose([x[3] for x in g], [x[3] for x in sorted(e, key=repr)], atol=1e-12)
    got = pivot_search.inner_product_top(given, F.col("id") % 100 == 0, k=10, **blocks)
    want = exact([*rows, (5100, [0.0] * 16), (5300, [1.0, 2.0])], 100, 10, inner)
    assert columns(got, "query_id", "rank", "vec_id", "score") == sorted(want, key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_collinear_vectors_rank_by_score_and_id(vectors, seed):
    rng = np.random.default_rng(seed)
    line = rng.normal(0, 1, 12)
    rows = [(i, (line * rng.uniform(0.1, 9)).tolist()) for i in range(160)] + [(i, rng.normal(0, 1, 12).tolist()) for i in range(160, 400)]
    out = vp_search.cosine_neighbours(vectors(rows), F.col("id") % 10 == 0, k=5, relax=1.0, shard_rows=150, block_rows=20)
    rows = [(i, np.array(v, dtype=np.float32).astype(float).tolist()) for i, v in rows]
    assert columns(out, "query_id", "rank", "vec_id", "score") == sorted(exact(rows, 10, 5, cosine), key=repr)


def test_products_beyond_doubles_rank_exactly():
    rng = np.random.default_rng(8)
    x = rng.integers(2**29, 2**29 + 4, (300, 8)).astype(float) - np.where(rng.random((300, 8)) < 0.5, 0, 1)
    q = x[:20]
    best = pivot_search.pivot_search(x, np.arange(300), q, 6)
    for n in range(20):
        want = sorted((-sum(int(a) * int(b) for a, b in zip(q[n], v)), i) for i, v in enumerate(x))[:6]
        assert [(-int(s), int(w)) for s, w in zip(best.score[n], best.which[n])] == want
    with pytest.raises(OverflowError):
        pivot_search.pivot_search(np.full((1, 4), 2.0**32), np.arange(1), np.full((1, 4), 2.0**32), 1)


def test_searches_empty_and_few(vectors):
    for rows in ([], ODD_VECTORS[:7], [(0, [1.0, 0.0])]):
        assert vp_search.cosine_neighbours(vectors(rows), F.col("id") % 50 == 0).count() == 0
    few = vectors([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [2.0, 0.0])])
    assert columns(vp_search.cosine_neighbours(few, F.col("id") % 50 == 0), "query_id", "rank", "vec_id") == [(0, 1, 2), (0, 2, 1)]
    assert columns(pivot_search.inner_product_top(few, F.col("id") % 100 == 0), "query_id", "rank", "vec_id", "score") == [(0, 1, 2, 2 * 1024**2), (0, 2, 1, 1024**2)]
    big = vectors([(0, [1e6, -1e6, 3.0]), (1, [1e6, 1e6, 7.0]), (2, [1e6, -1e6, 0.5])])
    got = columns(pivot_search.inner_product_top(big, F.col("id") % 100 == 0), "vec_id", "score")
    assert got == [(1, inner([1e6, -1e6, 3.0], [1e6, 1e6, 7.0])), (2, inner([1e6, -1e6, 3.0], [1e6, -1e6, 0.5]))]


def test_recall_with_production_parameters(spark):
    e = spark.read.parquet(f"{SF_ORACLE}/embeddings.parquet").collect()
    rows = [(r["vec_id"], r["embedding"]) for r in e]
    want = exact(rows, 50, 5, cosine)
    got = QUERIES["op3_vp_search"](spark, SF_ORACLE).collect()
    assert len({(r["query_id"], r["vec_id"]) for r in got} & {(w[0], w[2]) for w in want}) >= 0.9 * len(want)


def test_pipeline_stages(spark, tmp_path):
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    given = d.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(k))
        before = {r["doc_id"]: r["text"] for r in d.collect()}
        stage(spark, d, SF_SMALL).write.parquet(path)
        d = spark.read.parquet(path)
        rows = d.collect()
        assert set(r["doc_id"] for r in rows) <= set(before)
        if name != "packing":
            assert d.columns == given
        if name == "language_id":
            assert {r["doc_id"] for r in rows} == {i for i, t in before.items() if any(c.isalpha() for c in t or "")}
        if name == "line_dedup":
            assert len(rows) == len(before)
        if name == "near_duplicates":
            assert sorted(r["doc_id"] for r in rows) == sorted(i for i, _, c in brute_groups(list(before.items()), 5, 80) if i == c)
        if name == "source_mix":
            assert max(Counter(r["doc_id"] for r in rows).values()) <= 3
            copies_in = Counter(r["doc_id"] for r in rows)
        if name == "packing":
            assert Counter(r["doc_id"] for r in rows if r["piece"] == 0) == copies_in
            used = defaultdict(int)
            for r in rows:
                used[r["sequence_id"]] += r["length"]
            assert max(used.values()) <= 4096


def test_pipeline_run_is_registered(spark):
    import __spark_entry__ as E

    assert {"pipeline", *QUERIES} <= set(E.queries())
    assert "op2_line_dedup" in E.oracle_sql()
