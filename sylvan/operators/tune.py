"""Grid search with cross-validation.

Folds come from a key hash (a fold column), so the same rows land in the
same fold whatever the partitioning, and the estimator can be a whole
Pipeline, feature stages included (no leakage from fitting indexers on
all rows before the split).
"""

from __future__ import annotations

import json
import uuid
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sylvan import names
from sylvan.functions.columns import hash_fraction
from sylvan.operators import evaluate as EV
from sylvan.operators import features as FT
from sylvan.session import scratch_path


def param_grid(estimator, grid: dict[str, list]) -> list:
    """ParamGridBuilder from {param name: values}."""
    b = ParamGridBuilder()
    for name, values in grid.items():
        b = b.addGrid(estimator.getParam(name), list(values))
    return b.build()


def with_folds(df: DataFrame, key: str, folds: int, col: str = "fold") -> DataFrame:
    """Fold number 0..folds-1 from the key hash (independent of the split's)."""
    h = hash_fraction(key, "fold")
    return df.withColumn(col, F.least(F.floor(h * folds), F.lit(folds - 1)).cast("int"))


def cross_validate(
    estimator,
    grid: list,
    evaluator,
    df: DataFrame,
    key: str,
    folds: int = 5,
    parallelism: int = 4,
    seed: int = 42,
) -> CrossValidatorModel:
    """k-fold CV of one estimator with a key-hash fold column, by Spark's CrossValidator.

    The input (with its fold column) is cached once for all folds and grid
    points, and released after the fit. Everything in ``estimator`` is fitted
    for every grid point; :func:`cross_validate_shared` fits feature stages
    once a fold.
    """
    data = with_folds(df, key, folds, "__fold").persist(StorageLevel.MEMORY_AND_DISK)
    cv = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=grid,
        evaluator=evaluator,
        numFolds=folds,
        parallelism=parallelism,
        foldCol="__fold",
        seed=seed,
    )
    try:
        return cv.fit(data)
    finally:
        data.unpersist()


def point_name(point: dict) -> str:
    """A grid point (a ParamMap) as text that names it in a ledger."""
    return json.dumps({p.name: v for p, v in sorted(point.items(), key=lambda x: x[0].name)}, sort_keys=True)


class Ledger:
    """Finished (fold, grid point, metric) rows of one search, as small files in a shared folder.

    Every fold writes to a folder of its own, so folds can finish at the same
    time; a fold's rows are there whole or not at all. ``purpose`` names the
    data and the settings: rows of another purpose are not used.
    """

    SCHEMA = "purpose string, point string, metric double"

    def __init__(self, spark: SparkSession, path: str | None, purpose: str):
        self.spark, self.purpose = spark, purpose
        self.path = path or scratch_path(spark, "cv")

    def done(self) -> dict[tuple[int, str], float]:
        try:
            rows = self.spark.read.schema(f"{self.SCHEMA}, fold int, run string").parquet(self.path)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e.getCondition()):
                return {}
            raise
        rows = rows.where(F.col("purpose") == self.purpose).collect()  # folds x grid points
        return {(r["fold"], r["point"]): r["metric"] for r in rows}

    def add(self, fold: int, metrics: dict[str, float]) -> None:
        rows = self.spark.createDataFrame([(self.purpose, p, m) for p, m in metrics.items()], self.SCHEMA)
        rows.coalesce(1).write.parquet(f"{self.path}/fold={fold}/run={uuid.uuid4().hex}")


def cross_validate_shared(
    auto: FT.AutoPipeline,
    estimator,
    grid: list[dict],
    df: DataFrame,
    key: str,
    folds: int = 5,
    parallelism: int = 4,
    ledger: str | None = None,
    purpose: str = "",
) -> DataFrame:
    """``fold, point, metric`` of a binary classifier by exact AUC; the feature stages are fitted once a fold.

    A fold's training part fits the features, its encoded rows are cached,
    and every grid point fits the model alone on them; the scores of all
    points go through one :func:`~sylvan.operators.evaluate.auc_by`. Folds
    run ``parallelism`` at a time. With ``ledger`` (a shared folder) a
    search that was cut off goes on where it stopped: a fold's finished
    points are not fitted again.
    """
    spark = df.sparkSession
    settings = {"folds": folds, "key": key, "purpose": purpose, "estimator": type(estimator).__name__}
    settings["fixed"] = {p.name: str(v) for p, v in estimator.extractParamMap().items()}
    book = Ledger(spark, ledger, json.dumps(settings, sort_keys=True))
    done = book.done()
    points = {point_name(p): p for p in grid}
    data = with_folds(df, key, folds, "__fold").persist(StorageLevel.MEMORY_AND_DISK)

    def run(fold: int) -> None:
        left = {n: p for n, p in points.items() if (fold, n) not in done}
        if not left:
            return
        train, test = data.where(F.col("__fold") != fold), data.where(F.col("__fold") == fold)
        features = auto.pipeline.fit(train)
        fit_rows = FT.encode(features, train, auto).persist(StorageLevel.MEMORY_AND_DISK)
        test_rows = FT.encode(features, test, auto).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            scored = [
                EV.positive_score(estimator.copy(p).fit(fit_rows).transform(test_rows)).select(F.lit(n).alias("point"), names.LABEL, "score")
                for n, p in left.items()
            ]
            found = EV.auc_by(reduce(DataFrame.unionAll, scored), ["point"], names.LABEL, "score").collect()
        finally:
            fit_rows.unpersist()
            test_rows.unpersist()
        metrics = {r["point"]: float("nan") if r["auc"] is None else r["auc"] for r in found}
        book.add(fold, metrics)
        done.update({(fold, n): m for n, m in metrics.items()})

    try:
        with ThreadPool(max(1, min(parallelism, folds))) as pool:
            pool.map(inheritable_thread_target(run), range(folds), chunksize=1)
    finally:
        data.unpersist()
    return spark.createDataFrame([(f, n, done[f, n]) for f in range(folds) for n in points if (f, n) in done], "fold int, point string, metric double")


def _rows_of_points(spark: SparkSession, points: list[dict], extra: list[tuple], extra_schema: str) -> DataFrame:
    """One row per grid point: its values (numbers as double, others as text) and ``extra`` columns."""
    keys = sorted({k for p in points for k in p})
    number = {k: all(isinstance(p[k], (int, float)) and not isinstance(p[k], bool) for p in points if k in p) for k in keys}
    value = lambda k, v: None if v is None else float(v) if number[k] else str(v)
    rows = [tuple(value(k, p.get(k)) for k in keys) + e for p, e in zip(points, extra)]
    return spark.createDataFrame(rows, ", ".join([f"`{k}` {'double' if number[k] else 'string'}" for k in keys] + [extra_schema]))


def grid_metrics(spark: SparkSession, cv_model: CrossValidatorModel) -> DataFrame:
    """One row per grid point: parameter values and the average metric."""
    points = [{p.name: v for p, v in pm.items()} for pm in cv_model.getEstimatorParamMaps()]
    return _rows_of_points(spark, points, [(float(m),) for m in cv_model.avgMetrics], "avg_metric double")


def shared_grid_metrics(results: DataFrame) -> DataFrame:
    """The same from :func:`cross_validate_shared`, with the folds' standard deviation and number."""
    found = results.groupBy("point").agg(F.avg("metric"), F.stddev("metric"), F.count("metric")).collect()  # one per point
    found = sorted(found, key=lambda r: r["point"])
    return _rows_of_points(results.sparkSession, [json.loads(r["point"]) for r in found], [tuple(r)[1:] for r in found], "avg_metric double, std_metric double, n_folds long")


def best_point(results: DataFrame, grid: list[dict]) -> dict:
    """The grid point with the greatest average metric (ties: the first in name); points without a metric lose."""
    means = results.where(~F.isnan("metric")).groupBy("point").agg(F.avg("metric").alias("m")).collect()
    name = min(means, key=lambda r: (-r["m"], r["point"]))["point"]
    return next(p for p in grid if point_name(p) == name)


def fit_best(auto: FT.AutoPipeline, estimator, point: dict, train: DataFrame, test: DataFrame):
    """Features and model of one grid point fitted on all training rows, and the scored test rows."""
    features = auto.pipeline.fit(train)
    rows = FT.encode(features, train, auto).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = estimator.copy(point).fit(rows)
    finally:
        rows.unpersist()
    scored = EV.positive_score(model.transform(FT.encode(features, test, auto)))
    return features, model, scored
