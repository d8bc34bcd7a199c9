import datetime

import pytest
from pyspark.sql import functions as F

from sylvan.functions.columns import date_parts, prefix_int
from sylvan.operators import derive as D
from sylvan.operators import target as TG
from sylvan.operators import tune as TU


def test_imputer_strategies(spark):
    df = spark.createDataFrame([(1.0,), (None,), (4.0,), (float("nan"),), (4.0,)], "x double")
    for strategy, fill in (("mean", 3.0), ("median", 4.0), ("mode", 4.0)):
        out, model = D.impute(df, ["x"], strategy=strategy)
        vals = [r["x"] for r in out.collect()]
        assert vals == [1.0, fill, 4.0, fill, 4.0], strategy


def test_imputer_median_lower_middle(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "x double")
    out, _ = D.impute(df, ["x"], strategy="median")
    assert out.where(F.col("x") == 2.0).count() == 2


def test_imputer_keeps_integer_columns_meaningful(spark):
    df = spark.createDataFrame([(0,), (1,), (1,), (None,)], "q int")
    out, _ = D.impute(df, ["q"], strategy="mean", suffix="_imp")
    assert out.where(F.col("q").isNull()).first()["q_imp"] == pytest.approx(2 / 3)


def test_text_mode_fill(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,), ("a",)], "s string")
    assert [r["s"] for r in D.impute_text_mode(df, ["s"]).collect()][3] == "a"


def test_bucketizer_decades(spark):
    splits = D.decade_splits()
    assert len(splits) == 12 and splits[0] == 1911.0 and splits[-1] == 2021.0
    df = spark.createDataFrame([(v,) for v in (1911.0, 1920.9, 1921.0, 2011.0, 2021.0)], "y double")
    out = [r["b"] for r in D.bucketize(df, "y", "b", splits, open_ends=False).collect()]
    assert out == [0.0, 0.0, 1.0, 10.0, 10.0]
    low = spark.createDataFrame([(1900.0,)], "y double")
    with pytest.raises(Exception):
        D.bucketize(low, "y", "b", splits, open_ends=False).collect()
    assert D.bucketize(low, "y", "b", splits).first()["b"] == 0.0


def test_dates_and_prefix(spark):
    df = spark.createDataFrame([("15/07/16", "S123"), ("bad", "X")], "d string, s string")
    parts = df.select(*[c.alias(n) for n, c in date_parts("d", fmt="dd/MM/yy").items()], prefix_int("s").alias("p"))
    rows = parts.collect()
    assert (rows[0]["dayofmonth"], rows[0]["month"], rows[0]["year"], rows[0]["p"]) == (15, 7, 2016, 123)
    assert rows[1]["year"] is None and rows[1]["p"] is None
    d = df.select(F.try_to_date("d", "dd/MM/yy").alias("x")).first()["x"]
    assert d == datetime.date(2016, 7, 15)


def test_range_filter_inclusive_bounds(spark):
    df = spark.createDataFrame([(v,) for v in (1910, 1911, 2019, 2020, None)], "y int")
    assert D.range_filter(df, "y", 1911, 2019).count() == 2
    assert D.range_filter(df, "y", 1911, 2019, low_inclusive=False).count() == 1
    assert D.where_sql(df, "y between 1911 and 2019").count() == 2


def test_lookup_join_keeps_rows_and_refuses_repeated_keys(spark):
    big = spark.range(100).withColumnRenamed("id", "k")
    small = spark.range(10).withColumnRenamed("id", "k").withColumn("v", F.col("k") * 2)
    for options in ({}, {"assume_small": True}, {"split_hot_keys": True}):
        out = D.lookup_join(big, small, "k", **options)
        assert out.count() == 100 and out.where("v is null").count() == 90
        with pytest.raises(ValueError):
            D.lookup_join(big, small.union(small), "k", **options)
    assert D.lookup_join(big, small.union(small), "k", "left_semi").count() == 10


def test_hash_split_disjoint_complete_stable(spark):
    df = spark.range(0, 20000).withColumnRenamed("id", "k")
    train, test = TG.hash_split(df, "k")
    n_train, n_test = train.count(), test.count()
    assert n_train + n_test == 20000
    assert train.join(test, "k").count() == 0
    assert abs(n_train / 20000 - 0.7) < 0.01
    again, _ = TG.hash_split(df.repartition(7), "k")
    assert sorted(r.k for r in train.collect()) == sorted(r.k for r in again.collect())
    labelled = TG.with_split(df, "k")
    assert labelled.where("split = 'train'").count() == n_train


def test_choices_by_key_hash_are_independent(spark):
    df = spark.range(0, 40000, 8).select(F.col("id").alias("k"), F.expr("CASE WHEN id % 5 = 0 THEN 'x' ELSE 'y' END").alias("y"))
    kept = TG.undersample(df, "y", "k")
    n = {(r["y"], r["split"]): r["count"] for r in TG.with_split(kept, "k").groupBy("y", "split").count().collect()}
    assert n["x", "train"] + n["x", "test"] == 1000
    assert all(abs(n[y, "train"] / (n[y, "train"] + n[y, "test"]) - 0.7) < 0.06 for y in "xy")
    train, _ = TG.hash_split(df, "k")
    folds = [r["count"] for r in TU.with_folds(train, "k", 5).groupBy("fold").count().collect()]
    assert len(folds) == 5 and max(folds) < 1.2 * min(folds)


def test_hash_split_keeps_null_keys(spark):
    for kind in ("int", "string", "double"):
        df = spark.createDataFrame([("1",), (None,), ("2",), (None,)], "k string").select(F.col("k").cast(kind))
        assert sum(p.count() for p in TG.hash_split(df, "k")) == 4
        assert TG.with_split(df, "k").where("split IS NULL").count() == 0


def test_many_classes(spark):
    df = spark.range(20002).select(F.col("id").alias("k"), (F.col("id") % 10001).alias("y"))
    assert TG.undersample(df, "y", "k").count() == 20002
    assert TG.with_class_weights(df, "y").agg(F.sum("weight")).first()[0] == pytest.approx(20002)
    none = df.where("false")
    assert TG.undersample(none, "y", "k").count() == 0 and TG.with_class_weights(none, "y").count() == 0


def test_hash_split_string_keys(spark):
    df = spark.range(0, 1000).select(F.col("id").cast("string").alias("k"))
    a, b = TG.hash_split(df, "k")
    assert a.count() + b.count() == 1000


def test_undersample_and_weights(spark):
    df = spark.range(0, 4000).select(F.col("id").alias("k"), (F.col("id") % 5 == 0).cast("int").alias("y"))
    counts = {r["y"]: r["count"] for r in TG.undersample(df, "y", "k").groupBy("y").count().collect()}
    assert counts[1] == 800 and abs(counts[0] - 800) < 80
    w = {r["y"]: r["weight"] for r in TG.with_class_weights(df, "y").select("y", "weight").distinct().collect()}
    assert w[1] == pytest.approx(4000 / (2 * 800)) and w[0] == pytest.approx(4000 / (2 * 3200))


def test_randomize_target_is_seeded(spark):
    df = spark.range(0, 1000).withColumn("t", F.lit(1))
    a = TG.randomize_target(df, "t", seed=3)
    b = TG.randomize_target(df, "t", seed=3)
    assert a.columns[-1] == "t"
    assert a.collect() == b.collect()
    assert 400 < a.where("t = 0").count() < 600


def test_year_range_filter_pushable(spark):
    df = spark.createDataFrame(
        [(datetime.datetime(1994, 12, 31, 23, 59),), (datetime.datetime(1995, 1, 1),), (datetime.datetime(1999, 12, 31, 23),),
         (datetime.datetime(2000, 1, 1),)],
        "t timestamp_ntz",
    )
    assert D.year_range_filter(df, "t", 1995, 1999).count() == 2


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot_rows", [0, 150, 10**9])
def test_hot_key_join_equals_plain_join(spark, how, hot_rows):
    # key 1 holds a third of the big side; key 7 has no lookup row; some keys are NULL
    big = spark.createDataFrame(
        [(i, 1 if i % 3 == 0 else None if i % 13 == 0 else 7 if i % 11 == 0 else i % 5) for i in range(600)], "id long, k long"
    )
    lookup = spark.createDataFrame([(k, f"v{k}") for k in range(6)] + [(None, "x"), (None, "y")], "k long, v string")
    split = D.lookup_join(big, lookup, "k", how, split_hot_keys=True, hot_rows=hot_rows)
    plain = big.join(lookup, "k", how)
    assert sorted(split.collect(), key=repr) == sorted(plain.select(*split.columns).collect(), key=repr)
    if hot_rows == 150:
        assert [tuple(r) for r in D.hot_keys(big, ["k"], hot_rows).collect()] == [(1,)]
