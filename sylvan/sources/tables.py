"""Scans (S1) and the CSV sink used to exercise them.

Parquet is the default source: Catalyst pushes filters and column
pruning into the scan. CSV is kept because the reference reads CSV; an
explicit schema is preferred to ``inferSchema`` (which costs a full
extra pass over the files at scale).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str, spread_to: int | None = None) -> DataFrame:
    """Read one driver table ``{sf_dir}/{name}.parquet``.

    ``spread_to`` (for heavy per-row work right after the scan): when the
    scan yields fewer partitions than that, spread the rows round-robin.
    A file with one row group is one task; a large table is never touched.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df, spread_to) if spread_to else df


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Repartition a *scan* that has fewer than ``min_partitions`` partitions.

    The reference repartitions to 200 before fitting. Here the shuffle only
    happens when the input is too coarse for the cluster (by default:
    fewer partitions than the default parallelism); a table that already
    has enough splits, as any large one does, is returned unchanged.
    Counting the partitions of a scan plans the file splits without
    running a job; apply it to scans, not to plans with shuffles.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    header: bool = True,
    infer_schema: bool | None = None,
    sep: str = ",",
) -> DataFrame:
    """CSV scan with a header row.

    With ``schema`` the scan is a single pass. Without it Spark infers
    the types with an extra pass, as the reference does.
    """
    reader = spark.read.option("header", str(header).lower()).option("sep", sep)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer_schema is None or infer_schema:
        reader = reader.option("inferSchema", "true")
    return reader.csv(path)


def write_csv(df: DataFrame, path: str, header: bool = True) -> str:
    """Write a DataFrame as CSV (one part file per partition)."""
    df.write.mode("overwrite").option("header", str(header).lower()).csv(path)
    return path
