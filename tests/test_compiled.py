"""Compiled trees against the fitted models, in Spark and in DuckDB."""

import duckdb
import pytest
from pyspark.sql import functions as F

from sylvan import names
from sylvan.operators import compiled as CP
from sylvan.operators import features as FT
from sylvan.operators import models as M
from sylvan.plans.flows import needed_bins


@pytest.fixture(scope="module")
def rows(spark):
    """Text with quotes and backslashes, NULLs, a number of few values, a number of many."""
    kinds = ["it's", "b\\n", 'c"d', "e", "ä f", None]
    data = [
        (i, kinds[i * 7 % 6], str(i % 23), i % 4 if i % 11 else None, (i * 37 % 101) / 7.0 if i % 13 else None, float(i % 5 + (i * 7 % 6) * 2 + (i % 23 > 9) * 3), "yes" if (i * 7 % 6) + i % 4 > 4 else "no")
        for i in range(900)
    ]
    return spark.createDataFrame(data, "id long, kind string, `big kind` string, few int, many double, y double, cls string").repartition(4).persist()


def fitted(rows, kind, algo, **params):
    auto = FT.auto_pipeline(["kind", "big kind"], ["few", "many"], "cls" if kind == "classification" else "y", kind, 8, "keep")
    # fitted on some rows only: the others bring categories never seen
    train = rows.where("id < 600 and coalesce(kind, '') != 'e' and few != 3 and many is not null")
    feats = auto.pipeline.fit(train)
    model = M.make_model(algo, kind, maxBins=needed_bins(feats, 32, ("indexed_cls",)), **params).fit(FT.encode(feats, train, auto))
    return auto, feats, model


CASES = [
    ("classification", "dt", {"impurity": "entropy", "maxDepth": 6}, 0.0),
    ("classification", "rf", {"numTrees": 7}, 0.0),
    ("classification", "gbt", {"maxIter": 4}, 1e-12),
    ("regression", "dt", {"maxDepth": 7}, 0.0),
    ("regression", "rf", {"numTrees": 4, "subsamplingRate": 0.5}, 0.0),
    ("regression", "gbt", {"maxIter": 6}, 1e-12),
]


@pytest.mark.parametrize("kind, algo, params, tolerance", CASES)
def test_equals_model_and_runs_elsewhere(spark, rows, kind, algo, params, tolerance):
    auto, feats, model = fitted(rows, kind, algo, **params)
    scored = model.transform(feats.transform(rows))
    e, slots = CP.ensemble(spark, model), CP.raw_slots(auto, feats)
    got = CP.agreement(scored, e, slots, "id", tolerance).collect()
    assert len(got) == 900 and all(r["same_raw"] and r["same_vector"] for r in got)
    # the text form: in Spark, and in another engine over the raw table
    want = {r["id"]: r[names.PREDICTION] for r in scored.collect()}
    text = {r["id"]: r["p"] for r in rows.select("id", F.expr(CP.predicted_sql(e, slots, "spark")).alias("p")).collect()}
    raw = rows.select("id", "kind", "big kind", "few", "many").toPandas()  # noqa: F841
    raw["few"] = raw["few"].astype("Int64")
    con = duckdb.connect()
    con.register("raw", raw)
    other = dict(con.execute(f"SELECT id, {CP.predicted_sql(e, slots)} FROM raw").fetchall())
    for i, w in want.items():
        assert text[i] == pytest.approx(w, rel=1e-12, abs=1e-12) and other[i] == pytest.approx(w, rel=1e-12, abs=1e-12)


def test_probabilities_and_leaves(spark, rows):
    for algo in ("dt", "rf"):
        auto, feats, model = fitted(rows, "classification", algo)
        e, slots = CP.ensemble(spark, model), CP.raw_slots(auto, feats)
        scored = model.transform(feats.transform(rows)).withColumn("p", CP.probabilities(e, slots))
        for r in scored.select("p", names.PROBABILITY).collect():
            assert list(r["p"]) == pytest.approx(list(r[names.PROBABILITY]), abs=1e-12)
    auto, feats, model = fitted(rows, "regression", "dt", maxDepth=5)
    e, slots = CP.ensemble(spark, model), CP.raw_slots(auto, feats)
    train = rows.where("id < 600 and coalesce(kind, '') != 'e' and few != 3 and many is not null")
    held = {r["leaf"]: r["count"] for r in train.groupBy(CP.leaf_of(e, 0, slots).alias("leaf")).count().collect()}
    assert held == {leaf: n for leaf, _, _, n in CP.rules(e, slots)}
    with pytest.raises(ValueError):
        CP.probabilities(e, slots)


def test_thresholds_are_exact(spark):
    """Values that six digits cannot tell apart fall on the side that the model puts them."""
    df = spark.createDataFrame([(float(12345678 + i / 8), float(i > 3)) for i in range(8)] * 5, "x double, y double")
    auto = FT.auto_pipeline([], ["x"], "y", "regression", 2)
    feats = auto.pipeline.fit(df)
    model = M.make_model("dt", "regression", maxDepth=1).fit(FT.encode(feats, df, auto))
    e, slots = CP.ensemble(spark, model), CP.raw_slots(auto, feats)
    rules = CP.rules(e, slots)
    assert "12345678.4375" in rules[0][1] and [r[3] for r in rules] == [20, 20]
    assert df.where(CP.rules(e, slots, dialect="spark")[0][1]).count() == 20


def test_pipelines_without_raw_slots_are_refused(spark, rows):
    auto = FT.auto_pipeline(["kind"], ["few"], "y", "regression", 8, "keep", one_hot_text=True)
    with pytest.raises(ValueError):
        CP.raw_slots(auto, auto.pipeline.fit(rows))
