"""Property tests: Spark results against plain-Python brute force."""

import itertools
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sylvan.operators import evaluate as EV
from sylvan.operators import profile as P
from sylvan.operators import target as TG

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

rows_strategy = st.lists(
    st.tuples(
        st.one_of(st.none(), st.sampled_from(["a", "b", "c", "é", ""])),
        st.one_of(st.none(), st.integers(-3, 3)),
        st.one_of(st.none(), st.sampled_from([0.0, -0.0, 1.5, float("nan")])),
    ),
    min_size=0,
    max_size=40,
)


def _key(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return 0.0 if v == 0 else v
    return v


@SETTINGS
@given(rows_strategy)
def test_profile_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "s string, i int, x double")
    got = {r["name"]: r for r in P.profile(df, enriched=True).collect()}
    for j, name in enumerate(["s", "i", "x"]):
        col = [r[j] for r in rows]
        distinct = {_key(v) for v in col}
        non_null = [v for v in col if v is not None]
        r = got[name]
        assert r["nRows"] == len(rows)
        assert r["nullCount"] == len(rows) - len(non_null)
        assert r["nbDistinctValues"] == len(distinct)
        assert r["nbDistinctNonNull"] == len(distinct - {None})
        if rows:
            assert r["compRatio"] == pytest.approx(len(non_null) / len(rows))
        else:
            assert r["compRatio"] is None
        if non_null:
            counts = {}
            for v in non_null:
                counts[_key(v)] = counts.get(_key(v), 0) + 1
            assert r["frequency"] == max(counts.values())
        else:
            assert r["frequency"] is None


def brute_auc(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    if not pos or not neg:
        return None
    total = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    return total / (len(pos) * len(neg))


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 6).map(lambda v: v / 4), st.integers(0, 1)), min_size=2, max_size=60),
       st.sampled_from([1, 3, 16]))
def test_auc_matches_brute_force(spark, pairs, buckets):
    df = spark.createDataFrame(pairs, "score double, label int")
    got = EV.auc(df, "label", "score", buckets=buckets).first()["auc"]
    want = brute_auc(pairs)
    if want is None:
        assert got is None
    else:
        assert got == pytest.approx(want, abs=1e-12)


@SETTINGS
@given(st.lists(st.integers(0, 10**9), min_size=1, max_size=80, unique=True), st.integers(1, 6))
def test_hash_split_partitioning_invariant(spark, keys, parts):
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    a, b = TG.hash_split(df, "k")
    a2, b2 = TG.hash_split(df.repartition(parts), "k")
    ka, kb = {r.k for r in a.collect()}, {r.k for r in b.collect()}
    assert ka | kb == set(keys) and not ka & kb
    assert {r.k for r in a2.collect()} == ka and {r.k for r in b2.collect()} == kb
