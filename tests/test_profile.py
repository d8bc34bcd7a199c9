import pytest
from pyspark.sql import functions as F

from sylvan.operators import profile as P
from sylvan.operators import select as S

NULL_ROWS = [("a", 1), (None, 2), ("b", None), ("c", 4), ("a", 5)]


@pytest.fixture
def nulls(spark):
    return spark.createDataFrame(NULL_ROWS, "s string, i int")


def as_dict(df):
    return {r["name"]: r.asDict() for r in df.collect()}


def test_profile_counts_null_as_a_value(nulls):
    p = as_dict(P.profile(nulls))
    assert p["s"]["nbDistinctValues"] == 4
    assert p["s"]["nbDistinctNonNull"] == 3
    assert p["s"]["compRatio"] == pytest.approx(0.8)
    assert p["s"]["origType"] == "StringType" and p["s"]["colType"] == "textType"
    assert p["i"]["colType"] == "numericType"


def test_profile_strict_vs_extended(spark):
    df = spark.range(3).withColumn("f", F.lit(1.5).cast("float")).withColumn("t", F.current_timestamp())
    strict = as_dict(P.profile(df))
    ext = as_dict(P.profile(df, mode="extended"))
    assert strict["id"]["colType"] == "otherType" and ext["id"]["colType"] == "numericType"
    assert strict["f"]["colType"] == "otherType" and ext["f"]["colType"] == "numericType"
    assert ext["t"]["colType"] == "temporalType"


def test_profile_empty_table(spark):
    p = as_dict(P.profile(spark.createDataFrame([], "s string, i int")))
    assert p["s"]["compRatio"] is None
    assert p["s"]["nbDistinctValues"] == 0


def test_profile_independent_of_partitioning(nulls):
    a = sorted(P.profile(nulls).collect())
    b = sorted(P.profile(nulls.repartition(5)).collect())
    assert a == b


def test_profile_groups_nan_and_signed_zero(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (float("nan"),)], "x double")
    assert as_dict(P.profile(df))["x"]["nbDistinctValues"] == 2


def test_enriched_mode_and_ties(nulls):
    p = as_dict(P.profile(nulls, enriched=True))
    assert p["s"]["mostFrequentValue"] == "a" and p["s"]["frequency"] == 2
    assert p["s"]["nullCount"] == 1 and p["s"]["nRows"] == 5
    # all values once: tie broken by the smallest value
    assert p["i"]["mostFrequentValue"] == "1" and p["i"]["frequency"] == 1


def test_approx_profile_close(spark):
    df = spark.range(0, 5000).withColumn("m", F.col("id") % 37)
    p = as_dict(P.profile(df, approx=True))
    assert p["m"]["nbDistinctValues"] == pytest.approx(37, rel=0.1)
    assert p["id"]["nbDistinctValues"] == pytest.approx(5000, rel=0.1)


def test_wide_table_is_chunked(spark, monkeypatch):
    monkeypatch.setattr(P, "MAX_BRANCHES_PER_PLAN", 2)
    df = spark.createDataFrame([(1, 2, 3), (1, 5, None)], "a int, b int, c int")
    p = as_dict(P.profile(df))
    assert [p[c]["nbDistinctValues"] for c in "abc"] == [1, 2, 2]


def test_class_distribution(spark):
    df = spark.createDataFrame([(0,), (1,), (1,), (1,)], "y int")
    d = {r["y"]: r for r in P.class_distribution(df, "y").collect()}
    assert d[1]["n"] == 3 and d[1]["share"] == pytest.approx(0.75)
    assert d[0]["imbalance_ratio"] == pytest.approx(3.0)


def test_describe_and_bands(spark, nulls):
    d = P.describe(nulls, ["i"]).first()
    assert d["count"] == 4 and d["mean"] == pytest.approx(3.0) and d["max"] == 5.0
    prof = P.profile(nulls)
    bands = {r["name"]: r["band"] for r in prof.select("name", P.completeness_band(prof).alias("band")).collect()}
    assert bands == {"s": "average", "i": "average"}


def test_selection_rules(spark, nulls):
    prof = P.profile(nulls)
    assert S.text_columns(prof) == ["s"]
    assert S.text_columns(prof, max_distinct=4) == []
    assert S.text_columns(prof, max_distinct=4, inclusive=True) == ["s"]
    assert S.numeric_columns(prof, exclude=("i",)) == []
    assert S.complete_columns(prof) == []
    ids = {r["name"]: r["isIdentifier"] for r in S.identifier_columns(P.profile(nulls, enriched=True)).collect()}
    assert ids == {"s": False, "i": True}  # i: 5 distinct of 5 rows


def test_slot_distinct_counts(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([1.0, 3.0],)], "v array<double>")
    got = {r["slot"]: r["nbDistinctValues"] for r in P.slot_distinct_counts(df, "v").collect()}
    assert got == {0: 1, 1: 2}


def test_profile_odd_column_names(spark):
    df = spark.createDataFrame([(1, "a", 2.0), (None, "a", 3.0)], ["a b", "x.y", "we`ird"])
    p = as_dict(P.profile(df, enriched=True))
    assert set(p) == {"a b", "x.y", "we`ird"}
    assert p["a b"]["nbDistinctValues"] == 2 and p["x.y"]["mostFrequentValue"] == "a"


def test_profile_other_types(spark):
    import datetime
    from decimal import Decimal

    rows = [(True, datetime.date(2020, 1, 2), Decimal("1.10"), bytearray(b"x"), [1, 2], {"k": 1})] * 2 + [
        (False, None, Decimal("2.00"), None, [3], {"k": 2})
    ]
    df = spark.createDataFrame(rows, "b boolean, d date, m decimal(5,2), y binary, a array<int>, mp map<string,int>")
    p = as_dict(P.profile(df, enriched=True, mode="extended"))
    assert {c: p[c]["nbDistinctValues"] for c in p} == {"b": 2, "d": 2, "m": 2, "y": 2, "a": 2, "mp": 2}
    assert p["b"]["colType"] == "booleanType" and p["d"]["colType"] == "temporalType"
    assert p["b"]["mostFrequentValue"] == "true" and p["m"]["mostFrequentValue"] == "1.10"


def test_wide_table_approx_is_chunked(spark, monkeypatch):
    monkeypatch.setattr(P, "MAX_BRANCHES_PER_PLAN", 2)
    df = spark.createDataFrame([(1, 2, 3), (1, 5, None)], "a int, b int, c int")
    p = as_dict(P.profile(df, approx=True))
    assert [p[c]["nbDistinctValues"] for c in "abc"] == [1, 2, 2]
    assert p["c"]["compRatio"] == pytest.approx(0.5)


def test_long_texts_by_digest(spark):
    """Distinct counts and modes of texts that share their beginnings, with ties of long and short values."""
    start = "x" * 64
    cases = {
        "tie of long ones": [start + "b", start + "a", start + "b", start + "a", "q", None],
        "short is less": [start, start + "a", "é" * 70],
        "long is less": ["z", "z", "a" * 80, "a" * 80, "a" * 79 + "b"],
        "most frequent": [start + "c"] * 3 + [start + "a"] * 2 + ["a"],
        "digest as a value": ["m" * 70, __import__("hashlib").md5(("m" * 70).encode()).hexdigest()] * 2,
        "none": [None, None],
    }
    for name, values in cases.items():
        df = spark.createDataFrame([(v,) for v in values], "s string").repartition(3)
        p = as_dict(P.profile(df, enriched=True))["s"]
        known = [v for v in values if v is not None]
        count = {v: known.count(v) for v in known}
        want = min(count, key=lambda v: (-count[v], v)) if known else None
        assert p["mostFrequentValue"] == want, name
        assert (p["nbDistinctNonNull"], p["frequency"]) == (len(count), count.get(want)), name
        assert as_dict(P.profile(df))["s"]["nbDistinctNonNull"] == len(count), name


def test_long_texts_are_not_shuffled(spark):
    """The grouping keys of a text column are a digest and a flag."""
    df = spark.createDataFrame([("a" * 1000,)], "s string")
    plan = P.profile(df)._jdf.queryExecution().optimizedPlan().toString()
    keys = next(line for line in plan.splitlines() if "Aggregate [long" in line)
    assert "md5" in plan and "long" in keys
