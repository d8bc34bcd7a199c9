"""Versioned model bundles (S6): features, model and manifest, published by one last write.

A bundle is a folder of versions. A save writes a new version aside and then
appends one row to the table of published versions; only that row makes it
visible. A save that is cut off leaves the earlier version in place. Loading
checks the rows to score against the schema that the version was fitted on.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class Bundle:
    version: str
    features: PipelineModel
    model: PipelineModel
    manifest: dict

    def check(self, df: DataFrame) -> None:
        """Raise unless ``df`` has every input column with the type it was fitted on."""
        have = {f.name: f.dataType.simpleString() for f in df.schema}
        wrong = {c: (t, have.get(c)) for c, t in self.manifest["inputs"].items() if have.get(c) != t}
        if wrong:
            raise ValueError(f"columns that differ from the fitted ones (expected, found): {wrong}")

    def score(self, df: DataFrame) -> DataFrame:
        self.check(df)
        return self.model.transform(self.features.transform(df))


def save_bundle(path: str, features: PipelineModel, model, inputs: DataFrame, columns: list[str], **facts) -> str:
    """Write a new version and publish it; returns its name.

    ``inputs`` and ``columns`` give the schema that scoring needs; ``facts``
    (JSON values, e.g. the purpose of the split or metrics) are kept in the
    manifest.
    """
    spark = inputs.sparkSession
    version = uuid.uuid4().hex
    base = f"{path.rstrip('/')}/versions/{version}"
    features.write().save(f"{base}/features")
    PipelineModel(stages=[model]).write().save(f"{base}/model")
    manifest = {"version": version, "inputs": {c: inputs.schema[c].dataType.simpleString() for c in columns}, "facts": facts}
    text = spark.createDataFrame([(json.dumps(manifest, sort_keys=True),)], "value string")
    text.coalesce(1).write.text(f"{base}/manifest")
    _publish(spark, path, version)
    return version


def _publish(spark: SparkSession, path: str, version: str) -> None:
    number = max([r["number"] for r in published(spark, path)], default=0) + 1
    row = spark.createDataFrame([(number, time.time_ns(), version)], "number long, at long, version string")
    row.coalesce(1).write.mode("append").parquet(f"{path.rstrip('/')}/published")


def published(spark: SparkSession, path: str) -> list:
    """The published versions, oldest first (``number, at, version``)."""
    try:
        rows = spark.read.schema("number long, at long, version string").parquet(f"{path.rstrip('/')}/published")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e.getCondition()):
            return []
        raise
    return rows.orderBy("number", "at").collect()  # one row per version


def load_bundle(spark: SparkSession, path: str, version: str | None = None) -> Bundle:
    """The version published last, or a named one."""
    names = [r["version"] for r in published(spark, path)]
    if not names or (version is not None and version not in names):
        raise FileNotFoundError(f"no published version {version or ''} below {path}")
    version = version or names[-1]
    base = f"{path.rstrip('/')}/versions/{version}"
    manifest = json.loads(spark.read.text(f"{base}/manifest").agg(F.first("value")).first()[0])
    return Bundle(version, PipelineModel.load(f"{base}/features"), PipelineModel.load(f"{base}/model"), manifest)
