"""Session helpers: building a session and finding the shared scratch folder.

On a cluster the scratch folder is whatever the cluster names in
``spark.checkpoint.dir`` (a shared file system such as HDFS or an object
store). Only when that setting is missing (local tests) do we fall back
to a folder under the system temp dir.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(
    app: str = "sylvan",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Return (or create) a session with the settings this library expects.

    ``master`` and ``shuffle_partitions`` are only meant for local runs;
    on a cluster leave them unset so the cluster's own values apply.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints, saved models and written tables.

    Reads ``spark.checkpoint.dir`` from the session, or the folder already
    set on the context. Only on a local master (as in tests) a folder is
    created under the system temp dir; on a cluster its executors could not
    share it, so there an unset folder is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not is_local(spark):
            raise ValueError("spark.checkpoint.dir is not set: name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="sylvan-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/sylvan/{kind}/{uuid.uuid4().hex}"


def ensure_utc(spark: SparkSession) -> None:
    """Pin the session time zone so date parts do not depend on the host."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def default_parallelism(spark: SparkSession) -> int:
    return max(1, int(spark.sparkContext.defaultParallelism or os.cpu_count() or 1))
