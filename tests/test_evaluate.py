import itertools
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator

from sylvan.operators import evaluate as EV


def brute_auc(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    total = 0.0
    for p, n in itertools.product(pos, neg):
        total += 1.0 if p > n else 0.5 if p == n else 0.0
    return total / (len(pos) * len(neg))


@pytest.mark.parametrize("buckets", [1, 4, 1024])
def test_auc_exact_with_ties(spark, buckets):
    rnd = random.Random(5)
    rows = [(float(rnd.randint(0, 30)) / 10, int(rnd.random() < 0.4)) for _ in range(600)]
    df = spark.createDataFrame(rows, "score double, label int")
    got = EV.auc(df, "label", "score", buckets=buckets).first()
    assert got["auc"] == pytest.approx(brute_auc(rows), abs=1e-12)
    assert got["n_pos"] + got["n_neg"] == 600


def test_auc_hot_score(spark):
    rows = [(0.5, i % 2) for i in range(300)] + [(0.9, 1), (0.1, 0)]
    df = spark.createDataFrame(rows, "score double, label int")
    assert EV.auc(df, "label", "score").first()["auc"] == pytest.approx(brute_auc(rows))


def test_auc_matches_spark_on_continuous_scores(spark):
    rnd = random.Random(11)
    rows = [(rnd.random(), float(rnd.random() < 0.3)) for _ in range(500)]
    df = spark.createDataFrame(rows, "score double, label double")
    ours = EV.auc(df, "label", "score").first()["auc"]
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label")
    assert ours == pytest.approx(ev.evaluate(df), abs=1e-9)


def test_regression_metrics_match_evaluator(spark):
    rnd = random.Random(3)
    rows = [(rnd.gauss(0, 1), rnd.gauss(0, 1)) for _ in range(200)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    m = EV.regression_metrics(df).first()
    for metric in ("rmse", "mse", "mae", "r2"):
        assert m[metric] == pytest.approx(RegressionEvaluator(metricName=metric).evaluate(df), rel=1e-9)


def test_classification_metrics_and_confusion(spark):
    df = spark.createDataFrame([(1.0, 1.0), (0.0, 1.0), (0.0, 0.0), (1.0, 1.0)], "label double, prediction double")
    m = EV.classification_metrics(df).first()
    assert m["accuracy"] == 0.75 and m["test_error"] == 0.25
    conf = {(r["label"], r["prediction"]): r["n"] for r in EV.confusion(df).collect()}
    assert conf == {(1.0, 1.0): 2, (0.0, 1.0): 1, (0.0, 0.0): 1}
    assert EV.errors(df).count() == 1


def test_compare_models_long_table(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0)], "label double, prediction double")
    out = EV.compare_models({"a": df, "b": df}, "regression")
    assert out.count() == 8 and set(out.columns) == {"model", "metric", "value"}


def test_null_labels_and_scores_are_left_out(spark):
    rows = [(1.0, 0.9, 1.0), (0.0, 0.1, 0.0), (None, 0.95, 1.0), (None, 0.99, 1.0), (1.0, 0.5, 0.0), (0.0, None, None)]
    df = spark.createDataFrame(rows, "label double, score double, prediction double")
    assert EV.auc(df, "label", "score").first().asDict() == {"auc": 1.0, "n_pos": 2, "n_neg": 1}
    c, r = EV.classification_metrics(df).first(), EV.regression_metrics(df).first()
    assert (c["n"], c["n_skipped"], r["n"], r["n_skipped"]) == (3, 3, 3, 3)
    assert c["accuracy"] == pytest.approx(2 / 3) and r["r2"] == pytest.approx(1 - 1 / (2 / 3))
    assert sum(x["n"] for x in EV.confusion(df).collect()) == 3
