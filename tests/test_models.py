import pytest
from pyspark.ml.evaluation import RegressionEvaluator

from sylvan import names
from sylvan.operators import explain as EX
from sylvan.operators import features as FT
from sylvan.operators import models as M
from sylvan.operators import score as SC
from sylvan.operators import text as TX
from sylvan.sources import fixtures as FX

COLS = ["age", "income", "student", "credit_rating"]
GOLF = ["outlook", "temp", "humidity", "windy"]


@pytest.fixture(scope="module")
def buys(spark):
    df = FX.buys_computer(spark)
    auto = FT.auto_pipeline(COLS, [], "buys_computer", "classification", max_categories=3)
    feats = auto.pipeline.fit(df)
    tree = M.make_model("dt", "classification").fit(FT.encode(feats, df, auto))
    return df, auto, feats, tree


def test_default_tree_golden(spark, buys):
    df, auto, feats, tree = buys
    assert (tree.depth, tree.numNodes) == (4, 13)
    imp = tree.featureImportances.toArray()
    assert imp == pytest.approx([0.471111, 0.0, 0.28, 0.248889], abs=1e-6)
    names_ = FT.feature_names(feats.transform(df), names.FEATURES)
    labels = EX.slot_labels(auto.text_indexer(feats), COLS, feats.stages[-1], auto.assembled)
    rules = EX.tree_rules(spark, tree, names_, labels, auto.class_labels(feats)).collect()
    assert sum(r["n"] for r in rules) == 14
    assert any(r["rule"] == "indexed_age in {middle}" and r["predicted_class"] == "yes" for r in rules)
    imps = EX.importances(spark, tree, names_).collect()
    assert sum(r["importance"] for r in imps) == pytest.approx(1.0)


def test_score_with_fitted_stages_vs_refit(spark, buys):
    df, auto, feats, tree = buys
    new = FX.scoring_rows(spark)
    fitted = SC.score(feats, tree, new).collect()
    assert [list(map(int, r["features"].toArray())) for r in fitted] == [[1, 1, 0, 0], [0, 1, 1, 1]]
    assert [r["prediction"] for r in fitted] == [1.0, 1.0]
    # the reference refits the feature stages on the new rows: codes change meaning
    refit_auto = FT.auto_pipeline(COLS, [], None, "regression", max_categories=3)
    refit = tree.transform(refit_auto.pipeline.fit(new).transform(new)).collect()
    assert [list(map(int, r["features"].toArray())) for r in refit] == [[1, 0, 0, 1], [0, 0, 1, 0]]
    assert [r["prediction"] for r in refit] == [1.0, 0.0]


def test_prediction_bands(spark, buys):
    df, auto, feats, tree = buys
    pred = SC.score(feats, tree, FX.scoring_rows(spark))
    rows = SC.prediction_bands(pred, auto.class_labels(feats)).collect()
    assert [r["predicted_class"] for r in rows] == ["no", "no"]
    assert all(r["confidence_level"] in ("high", "medium", "low") for r in rows)


def test_unknown_categories_from_model(spark, buys):
    df, auto, feats, tree = buys
    new = spark.createDataFrame([("teen", "high", "no", "fair")], COLS)
    unk = SC.unknown_categories_from_model(spark, auto.text_indexer(feats), COLS, new).collect()
    assert [(r["column"], r["value"], r["n"]) for r in unk] == [("age", "teen", 1)]


def test_regression_tree_golden(spark):
    df = FX.golf(spark)
    auto = FT.auto_pipeline(GOLF, [], "hours", "regression", max_categories=4)
    feats = auto.pipeline.fit(df)
    assert [list(x) for x in auto.text_indexer(feats).labelsArray] == [
        ["rainy", "sunny", "overcast"], ["mild", "cool", "hot"], ["high", "normal"], ["FALSE", "TRUE"],
    ]
    enc = FT.encode(feats, df, auto)
    tree = M.make_model("dt", "regression").fit(enc)
    assert (tree.depth, tree.numNodes) == (5, 25)
    assert tree.featureImportances.toArray() == pytest.approx([0.568987, 0.277150, 0.003427, 0.150436], abs=1e-6)
    pred = tree.transform(enc)
    assert RegressionEvaluator(metricName="rmse").evaluate(pred) == pytest.approx(0.188982, abs=1e-6)
    assert RegressionEvaluator(metricName="mae").evaluate(pred) == pytest.approx(0.071429, abs=1e-6)
    labels = EX.slot_labels(auto.text_indexer(feats), GOLF, feats.stages[-1], auto.assembled)
    nodes = {r["id"]: r for r in EX.tree_nodes(spark, tree).collect()}
    root = nodes[0]
    assert sorted(labels[root["featureIndex"]][int(c)] for c in root["categories"]) == ["rainy", "sunny"]
    stats = EX.tree_stats(spark, tree).first()
    assert (stats["depth"], stats["numNodes"]) == (5, 25)


def test_ensembles_are_seeded(spark):
    df = FX.golf(spark)
    auto = FT.auto_pipeline(GOLF, [], "hours", "regression", max_categories=4)
    enc = FT.encode(auto.pipeline.fit(df), df, auto).cache()
    a = M.make_model("rf", "regression", numTrees=3, featureSubsetStrategy="onethird", subsamplingRate=0.5).fit(enc)
    b = M.make_model("rf", "regression", numTrees=3, featureSubsetStrategy="onethird", subsamplingRate=0.5).fit(enc)
    assert a.featureImportances == b.featureImportances
    assert EX.tree_stats(spark, a).count() == 3


def test_text_classification_golden(spark):
    model = TX.text_pipeline().fit(FX.text_train(spark))
    out = model.transform(FX.text_score(spark)).orderBy("id").collect()
    assert [r["prediction"] for r in out] == [0.0, 0.0, 1.0, 0.0]
    # 10 L-BFGS iterations stop before convergence, so the last digits
    # depend on the summation order (partitioning): compare to 1e-5.
    assert [r["probability"][1] for r in out] == pytest.approx([0.370790, 0.015230, 0.865877, 0.004429], abs=1e-5)


def test_tokenizer_keeps_inner_empty_tokens(spark):
    df = spark.createDataFrame([(" A  b ",)], "text string")
    assert TX.tokens(df).first()["words"] == ["", "a", "", "b"]


def test_max_bins_check():
    M.check_max_bins(32, {"a": 31}, "keep")
    with pytest.raises(ValueError):
        M.check_max_bins(40, {"a": 40}, "keep")


def test_flow_handles_text_column_wider_than_max_categories(spark):
    """A text column with more values than maxCategories keeps its nominal
    attribute; the flow sizes maxBins from it instead of failing (X8)."""
    from pyspark.sql import functions as F

    from sylvan.plans.flows import supervised_flow

    df = spark.range(0, 600).select(
        F.col("id").alias("k"),
        F.concat(F.lit("c"), (F.col("id") % 45).cast("string")).alias("wide"),
        (F.col("id") % 7).cast("double").alias("x"),
        ((F.col("id") % 45) < 20).cast("int").alias("y"),
    )
    res = supervised_flow(df, "y", "k", ["wide"], ["x"], "classification", "dt", max_categories=10)
    assert res.predictions.count() > 0
    res.release()


def test_unknown_categories_matches_sets(spark):
    train = spark.createDataFrame([("a", "x"), ("b", "x"), (None, "y")], "c1 string, c2 string")
    score = spark.createDataFrame([("a", "z"), ("c", "z"), ("c", None), ("b", "x")], "c1 string, c2 string")
    got = {(r["column"], r["value"], r["n"]) for r in SC.unknown_categories(train, score, ["c1", "c2"]).collect()}
    assert got == {("c1", "c", 2), ("c2", "z", 2)}
