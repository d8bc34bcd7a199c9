"""Batch scoring with the fitted pipeline.

The reference refits the feature indexers on the rows to score, which
silently changes what each code means. Here scoring always applies the
stages fitted on the training rows; a fitted multi-column StringIndexer
skips its target column when the scoring rows have none.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sylvan import names
from sylvan.functions.columns import max_probability

# Confidence bands on the largest class probability.
HIGH_CONFIDENCE = 0.9
MEDIUM_CONFIDENCE = 0.7


def score(features: PipelineModel, model, df: DataFrame) -> DataFrame:
    """Apply fitted feature stages, then the fitted model."""
    return model.transform(features.transform(df))


def prediction_bands(pred: DataFrame, class_labels: list[str] | None = None) -> DataFrame:
    """Max probability, confidence band and decoded class per row."""
    mp = max_probability(names.PROBABILITY)
    band = F.when(mp > HIGH_CONFIDENCE, "high").when(mp > MEDIUM_CONFIDENCE, "medium").otherwise("low")
    out = pred.withColumns({"max_probability": mp, "confidence_level": band})
    if class_labels:
        arr = F.array(*[F.lit(v) for v in class_labels])
        out = out.withColumn("predicted_class", F.get(arr, F.col(names.PREDICTION).cast("int")))
    return out


def unknown_categories_from_model(
    spark: SparkSession, indexer: StringIndexerModel, input_cols: list[str], df: DataFrame
) -> DataFrame:
    """(column, value, n) of values the fitted indexer has never seen.

    The rows to score are grouped by (column, value) with partial
    aggregation; whether the fitted labels are broadcast is left to the
    optimizer, which knows their bytes.
    """
    known = spark.createDataFrame(
        [(c, v) for c, labels in zip(input_cols, indexer.labelsArray) for v in labels], "column string, value string"
    )
    observed = _observed(df, [c for c in input_cols if c in df.columns])
    return observed.join(known, ["column", "value"], "left_anti")


def unknown_categories(train: DataFrame, df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, value, n) of values in ``df`` absent from ``train``.

    Fully distributed: distinct (column, value) pairs on both sides and a
    left-anti join (shuffle join unless the optimizer finds a side small).
    """
    seen = _observed(train, cols).select("column", "value")
    return _observed(df, cols).join(seen, ["column", "value"], "left_anti")


def _observed(df: DataFrame, cols: list[str]) -> DataFrame:
    parts = [
        df.select(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")).where(F.col("value").isNotNull())
        for c in cols
    ]
    return reduce(DataFrame.unionAll, parts).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
