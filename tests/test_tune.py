"""Cross-validation with shared features: same averages as Spark's, resumable, grids with text values; exact AUC by group."""

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from sylvan.operators import evaluate as EV
from sylvan.operators import features as FT
from sylvan.operators import models as M
from sylvan.operators import target as TG
from sylvan.operators import tune as TU


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, "abc"[i * 7 % 3], (i * 37 % 101) / 10.0, "yes" if (i * 37 % 101) / 10.0 + (i * 7 % 3) + (i * 13 % 7) / 2 > 7 else "no") for i in range(1200)]
    return spark.createDataFrame(data, "id long, kind string, x double, cls string").repartition(4).persist()


def parts():
    auto = FT.auto_pipeline(["kind"], ["x"], "cls", "classification", 5, "keep")
    return auto, M.make_model("dt", "classification")


def test_same_averages_as_fitting_everything_anew(spark, rows):
    auto, tree = parts()
    grid = TU.param_grid(tree, {"impurity": ["gini", "entropy"], "maxDepth": [2, 4]})
    got = {(r["impurity"], r["maxDepth"]): r["avg_metric"] for r in TU.shared_grid_metrics(TU.cross_validate_shared(auto, tree, grid, rows, "id", folds=3)).collect()}
    whole = M.make_model("dt", "classification", label="indexed_cls")
    points = TU.param_grid(whole, {"impurity": ["gini", "entropy"], "maxDepth": [2, 4]})
    cv = TU.cross_validate(Pipeline(stages=auto.pipeline.getStages() + [whole]), points, EV.ExactAUC("indexed_cls"), rows, "id", folds=3)
    want = {(r["impurity"], r["maxDepth"]): r["avg_metric"] for r in TU.grid_metrics(spark, cv).collect()}
    assert got == pytest.approx(want, abs=1e-12) and len(got) == 4


def test_goes_on_where_it_stopped(spark, rows, tmp_path, monkeypatch):
    auto, tree = parts()
    grid = TU.param_grid(tree, {"maxDepth": [1, 3]})
    path, fits = str(tmp_path / "ledger"), []
    plain = type(tree).fit
    monkeypatch.setattr(type(tree), "fit", lambda self, *a: fits.append(1) or plain(self, *a))
    true_auc = EV.auc_by

    def breaks(*a, **b):
        if len(fits) > 2:
            raise RuntimeError("lost")
        return true_auc(*a, **b)

    monkeypatch.setattr(TU.EV, "auc_by", breaks)
    with pytest.raises(RuntimeError):
        TU.cross_validate_shared(auto, tree, grid, rows, "id", folds=3, parallelism=1, ledger=path)
    monkeypatch.setattr(TU.EV, "auc_by", true_auc)
    first = len(fits)
    done = TU.cross_validate_shared(auto, tree, grid, rows, "id", folds=3, parallelism=1, ledger=path)
    assert len(fits) - first == 4 and done.count() == 6  # one fold of two points was finished
    before = len(fits)
    again = TU.cross_validate_shared(auto, tree, grid, rows, "id", folds=3, ledger=path)
    assert len(fits) == before and sorted(again.collect()) == sorted(done.collect())
    TU.cross_validate_shared(auto, tree, grid[:1], rows, "id", folds=3, ledger=path, purpose="another")
    assert len(fits) == before + 3


def test_best_model(spark, rows):
    auto, tree = parts()
    train, test = TG.hash_split(rows, "id")
    grid = TU.param_grid(tree, {"maxDepth": [1, 5]})
    found = TU.cross_validate_shared(auto, tree, grid, train, "id", folds=3)
    point = TU.best_point(found, grid)
    assert list(point.values()) == [5]
    _, model, scored = TU.fit_best(auto, tree, point, train, test)
    m = EV.classification_metrics(scored).first()
    assert m["n"] == test.count() and m["accuracy"] > 0.8 and model.depth > 1


def test_auc_by_group_against_brute_force(spark):
    data = [(None if i % 4 == 0 else "g" + str(i % 4), float(i * 31 % 17), float(i * i % 3 == 1)) for i in range(500)] + [("one class", 1.0, 1.0), ("g1", None, 1.0)]
    df = spark.createDataFrame(data, "g string, score double, label double").repartition(3)
    got = {r["g"]: (r["auc"], r["n_pos"], r["n_neg"]) for r in EV.auc_by(df, ["g"], buckets=5).collect()}
    for g in {d[0] for d in data}:
        rows = [d for d in data if d[0] == g and d[1] is not None]
        pos, neg = [d[1] for d in rows if d[2] == 1], [d[1] for d in rows if d[2] == 0]
        want = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg)) if pos and neg else None
        assert got[g] == (pytest.approx(want) if want is not None else None, len(pos), len(neg))
