"""Fitted imputation, exact undersampling, CSV quarantine and model bundles."""

import math

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from sylvan.operators import features as FT
from sylvan.operators import models as M
from sylvan.operators import target as TG
from sylvan.operators.impute import FillMissing
from sylvan.sources import bundles as B
from sylvan.sources import quarantine as Q

ROWS = [(1, 1.0, 5, "a", None), (2, None, 5, "b", None), (3, float("nan"), 2, None, None), (4, 4.0, None, "b", None), (5, 7.0, 2, "a", None)]
SCHEMA = "id long, `x y` double, n int, t string, void string"


@pytest.mark.parametrize("strategy, x, n", [("mean", 4.0, 3.5), ("median", 4.0, 2.0), ("mode", 1.0, 2.0)])
def test_fill_values_survive_saving_and_fill_new_rows(spark, tmp_path, strategy, x, n):
    df = spark.createDataFrame(ROWS, SCHEMA)
    stage = FillMissing(numericCols=["x y", "n"], textCols=["t", "void"], strategy=strategy, flagSuffix="_was")
    path = str(tmp_path / "m")
    Pipeline(stages=[stage]).fit(df).write().save(path)
    model = PipelineModel.load(path)
    assert model.stages[0].fill_values() == {"x y": x, "n": n, "t": "a", "void": None}
    new = spark.createDataFrame([(9, None, None, None, None), (10, 0.0, 1, "z", "v")], SCHEMA)
    got = {r["id"]: r for r in model.transform(new).collect()}
    assert (got[9]["x y"], got[9]["n"], got[9]["t"], got[9]["void"], got[9]["x y_was"], got[9]["t_was"]) == (x, n, "a", None, 1.0, 1.0)
    assert (got[10]["x y"], got[10]["n"], got[10]["t"], got[10]["void"], got[10]["n_was"]) == (0.0, 1.0, "z", "v", 0.0)


def test_imputation_in_the_auto_pipeline(spark):
    data = [(i, None if i % 4 == 0 else float(i % 10), None if i % 5 == 0 else "pq"[i % 2], float(i % 10)) for i in range(200)]
    df = spark.createDataFrame(data, "id long, x double, t string, y double")
    auto = FT.auto_pipeline(["t"], ["x"], "y", "regression", 3, impute="mean")
    feats = auto.pipeline.fit(df.where("id < 100"))
    out = FT.encode(feats, df, auto).collect()
    mean = sum(d[1] for d in data[:100] if d[1] is not None) / sum(d[1] is not None for d in data[:100])
    assert len(out) == 200 and all(not math.isnan(v) for r in out for v in r["features"])
    assert out[100]["features"][1] == pytest.approx(mean)


def test_undersample_exact_sizes(spark):
    data = [(i, "rare" if i % 17 == 0 else "often" if i % 3 else None) for i in range(5000)] + [(None, "often"), (None, "often")]
    df = spark.createDataFrame(data, "id long, c string").repartition(5)
    kept = TG.undersample_exact(df, "c", "id")
    want = sum(c == "rare" for _, c in data)
    assert {r["c"]: r["count"] for r in kept.groupBy("c").count().collect()} == {"rare": want, "often": want}
    assert kept.columns == ["id", "c"] and sorted(kept.collect()) == sorted(TG.undersample_exact(df.repartition(2), "c", "id").collect())
    assert kept.where("id is not null").groupBy("id").count().where("count > 1").count() == 0
    assert TG.undersample_exact(df.limit(0), "c", "id").count() == 0
    one_key = spark.createDataFrame([(7, "a")] * 40 + [(i, "b") for i in range(10)], "id long, c string")
    assert {r["c"]: r["count"] for r in TG.undersample_exact(one_key, "c", "id").groupBy("c").count().collect()} == {"a": 10, "b": 10}


def test_quarantine(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,s,d\n1,"x, ""y""",2020-01-31\n2,,\nq,s,2020-01-01\n3,s\n4,s,2020-01-01,5\n')
    (tmp_path / "b.csv").write_text("k,s,d\n5,s,notadate\n6,t,2021-02-28\n")
    clean, rejected = Q.read_csv_checked(spark, str(tmp_path), "k int, s string, d date")
    assert sorted((r["k"], r["s"]) for r in clean.collect()) == [(1, 'x, "y"'), (2, None), (6, "t")]
    assert sorted(r["k"] for r in clean.select("k").collect()) == [1, 2, 6]  # the same rows when few columns are read
    got = {(r["file"][-5:], r["reason"]): r["n"] for r in Q.rejected_counts(rejected).collect()}
    assert got == {("a.csv", "bad value in k"): 1, ("a.csv", "too few fields"): 1, ("a.csv", "too many fields"): 1, ("b.csv", "bad value in d"): 1}
    assert {r["line"] for r in rejected.collect()} == {"q,s,2020-01-01", "3,s", "4,s,2020-01-01,5", "5,s,notadate"}


def test_an_interrupted_save_leaves_the_old_version(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(float(i), float(i % 3)) for i in range(50)], "x double, y double")
    auto = FT.auto_pipeline([], ["x"], "y", "regression", 2)
    feats = auto.pipeline.fit(df)
    model = M.make_model("dt", "regression", maxDepth=2).fit(FT.encode(feats, df, auto))
    path = str(tmp_path / "bundle")
    with pytest.raises(FileNotFoundError):
        B.load_bundle(spark, path)
    first = B.save_bundle(path, feats, model, df, ["x"], purpose="test")
    with monkeypatch.context() as m:
        m.setattr(B, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            B.save_bundle(path, feats, model, df, ["x"])
    got = B.load_bundle(spark, path)
    assert got.version == first and got.manifest["facts"] == {"purpose": "test"} and got.score(df).count() == 50
    second = B.save_bundle(path, feats, model, df, ["x"])
    assert B.load_bundle(spark, path).version == second and B.load_bundle(spark, path, first).version == first
    with pytest.raises(ValueError, match="differ"):
        got.score(df.select(F.col("x").cast("int").alias("x")))
