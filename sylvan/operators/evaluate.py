"""Evaluation in one pass.

Each metric family is one aggregate over the predictions: the evaluator
classes of Spark ML run one job per metric, these run one job per
family. AUC is exact: scores are first collapsed to distinct values
(partial aggregation absorbs hot scores), then ranked inside range
buckets whose offsets form a small table, so no single task ever sees
all rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    Evaluator,
    MulticlassClassificationEvaluator,
    RegressionEvaluator,
)
from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sylvan import names
from sylvan.functions.columns import safe_ratio

# Buckets used to rank distinct scores for the exact AUC.
AUC_BUCKETS = 1024


def scored(label: str, prediction: str) -> tuple[Column, Column, Column]:
    """Label, prediction, and whether a row counts.

    One rule for every metric here: rows whose label or prediction is NULL
    are left out; metrics report how many (``n_skipped``).
    """
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    return y, p, y.isNotNull() & p.isNotNull()


def regression_metrics(df: DataFrame, label: str = names.LABEL, prediction: str = names.PREDICTION) -> DataFrame:
    """n, RMSE, MSE, MAE, R^2 and n_skipped in one aggregate (M11); see ``scored``."""
    y, p, known = scored(label, prediction)
    err = p - y
    stats = df.agg(
        F.count(err).alias("n"),
        F.avg(err * err).alias("mse"),
        F.avg(F.abs(err)).alias("mae"),
        F.sum(err * err).alias("sse"),
        F.var_pop(F.when(known, y)).alias("var_y"),
        F.count_if(~known).alias("n_skipped"),
    )
    return stats.select(
        "n",
        F.sqrt("mse").alias("rmse"),
        "mse",
        "mae",
        (F.lit(1.0) - safe_ratio(F.col("sse"), F.col("var_y") * F.col("n"))).alias("r2"),
        "n_skipped",
    )


def classification_metrics(
    df: DataFrame, label: str = names.LABEL, prediction: str = names.PREDICTION
) -> DataFrame:
    """n, accuracy, test error = 1 - accuracy and n_skipped (M9); see ``scored``."""
    y, p, known = scored(label, prediction)
    hit = F.when(known, F.when(y == p, 1.0).otherwise(0.0))
    stats = df.agg(F.count(hit).alias("n"), F.avg(hit).alias("accuracy"), F.count_if(~known).alias("n_skipped"))
    return stats.select("n", "accuracy", (F.lit(1.0) - F.col("accuracy")).alias("test_error"), "n_skipped")


def confusion(df: DataFrame, label: str = names.LABEL, prediction: str = names.PREDICTION) -> DataFrame:
    """Rows per (label, prediction) pair (M9); see ``scored``."""
    return df.where(scored(label, prediction)[2]).groupBy(
        F.col(label).cast("double").alias("label"), F.col(prediction).cast("double").alias("prediction")
    ).agg(F.count(F.lit(1)).alias("n"))


def errors(df: DataFrame, label: str = names.LABEL, prediction: str = names.PREDICTION) -> DataFrame:
    """Misclassified rows."""
    return df.where(F.col(label).cast("double") != F.col(prediction).cast("double"))


def positive_score(df: DataFrame, probability: str = names.PROBABILITY, out: str = "score") -> DataFrame:
    """P(class 1) from a probability vector, as a plain column."""
    return df.withColumn(out, vector_to_array(F.col(probability))[1])


def auc(df: DataFrame, label: str = names.LABEL, score: str = "score", buckets: int = AUC_BUCKETS) -> DataFrame:
    """Exact area under the ROC curve, ties counted one half.

    AUC = sum over positives of (negatives with lower score + half the
    negatives with equal score) / (P * N).

    1. group by score: (score, pos, neg) - one row per distinct score,
       cached because it is read twice (quantiles, then ranking);
    2. cut the distinct scores into ``buckets`` ranges at approximate
       quantiles, and total the negatives per bucket (a table of at most
       ``buckets`` rows, broadcast: its size is fixed by the parameter);
    3. negatives below a score = negatives in earlier buckets + a running
       sum inside its bucket (a window partitioned by bucket).

    Rows with a NULL label or score are left out (see ``scored``).
    Returns a one-row DataFrame (auc, n_pos, n_neg); the work runs when
    this is called.
    """
    return auc_by(df, [], label, score, buckets).select("auc", "n_pos", "n_neg")


def auc_by(
    df: DataFrame, groups: list[str], label: str = names.LABEL, score: str = "score", buckets: int = AUC_BUCKETS
) -> DataFrame:
    """Exact AUC of every group (a model, a fold, a source) in one pass: ``groups, auc, n_pos, n_neg``.

    As :func:`auc`, with the buckets cut once over the scores of all groups
    and the ranking inside (group, bucket), so all groups share one shuffle
    and no group is a task of its own. A NULL in a group column is a group;
    a group without both classes has a NULL AUC.
    """
    y, s, known = scored(label, score)
    spark = df.sparkSession
    by_score = (
        df.where(known)
        .groupBy(*groups, s.alias("s"))
        .agg(
            F.sum(F.when(y == 1.0, 1).otherwise(0)).cast("double").alias("pos"),
            F.sum(F.when(y == 1.0, 0).otherwise(1)).cast("double").alias("neg"),
        )
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    try:
        found = _auc_from_scores(by_score, groups, buckets)
        return spark.createDataFrame(found.collect(), found.schema)  # one row per group
    finally:
        by_score.unpersist()


def _auc_from_scores(by_score: DataFrame, groups: list[str], buckets: int) -> DataFrame:
    """AUC from (groups, s, pos, neg) rows, one row per distinct score of a group (see ``auc``)."""
    probs = [i / buckets for i in range(1, buckets)]
    qs = by_score.agg(F.percentile_approx("s", probs, 10 * buckets).alias("q")).first()["q"] or []
    edges = sorted({float(q) for q in qs if q is not None})
    if edges:
        splits = [float("-inf")] + edges + [float("inf")]
        bucketed = Bucketizer(splits=splits, inputCol="s", outputCol="b", handleInvalid="keep").transform(by_score)
    else:
        bucketed = by_score.withColumn("b", F.lit(0.0))
    per_bucket = bucketed.groupBy(*groups, "b").agg(F.sum("neg").alias("bneg"))
    earlier = Window.partitionBy(*groups).orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    keys = [F.col(g).alias(f"__{g}") for g in groups]
    offsets = per_bucket.select(*keys, F.col("b").alias("__b"), F.coalesce(F.sum("bneg").over(earlier), F.lit(0.0)).alias("off"))
    if not groups:
        offsets = F.broadcast(offsets)  # one row per bucket; with groups the optimizer sees the size
    same = reduce(lambda x, g: x & F.col(g).eqNullSafe(F.col(f"__{g}")), groups, F.col("b") == F.col("__b"))
    within = Window.partitionBy(*groups, "b").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    ranked = bucketed.join(offsets, same).withColumn("neg_below", F.col("off") + F.coalesce(F.sum("neg").over(within), F.lit(0.0)))
    return ranked.groupBy(*groups).agg(
        safe_ratio(
            F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2.0)),
            F.sum("pos") * F.sum("neg"),
        ).alias("auc"),
        F.sum("pos").cast("long").alias("n_pos"),
        F.sum("neg").cast("long").alias("n_neg"),
    )


class ExactAUC(Evaluator):
    """Spark ML evaluator over :func:`auc` (Spark's own bins the scores); NaN without both classes."""

    def __init__(self, label: str = names.LABEL, probability: str = names.PROBABILITY):
        super().__init__()
        self.label, self.probability = label, probability

    def _evaluate(self, dataset: DataFrame) -> float:
        value = auc(positive_score(dataset, self.probability, "__score"), self.label, "__score").first()["auc"]
        return float("nan") if value is None else value

    def isLargerBetter(self) -> bool:
        return True


def metrics_long(metrics: DataFrame) -> DataFrame:
    """One-row metrics table -> (metric, value) rows."""
    cols = metrics.columns
    return metrics.select(
        F.explode(
            F.map_from_arrays(F.array(*[F.lit(c) for c in cols]), F.array(*[F.col(c).cast("double") for c in cols]))
        ).alias("metric", "value")
    )


def compare_models(predictions: dict[str, DataFrame], kind: str = "regression") -> DataFrame:
    """Long table (model, metric, value) for several models."""
    parts = []
    for name, pred in predictions.items():
        m = regression_metrics(pred) if kind == "regression" else classification_metrics(pred)
        metric_cols = [c for c in m.columns if c not in ("n", "n_skipped")]
        parts.append(
            m.select(
                F.lit(name).alias("model"),
                F.explode(F.map_from_arrays(F.array(*[F.lit(c) for c in metric_cols]), F.array(*[F.col(c).cast("double") for c in metric_cols]))).alias("metric", "value"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def spark_evaluator(kind: str, metric: str | None = None):
    """Spark ML evaluator for tuning."""
    if kind == "binary":
        return BinaryClassificationEvaluator(metricName=metric or "areaUnderROC")
    if kind == "classification":
        return MulticlassClassificationEvaluator(metricName=metric or "accuracy")
    return RegressionEvaluator(metricName=metric or "rmse")
