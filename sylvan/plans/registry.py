"""Registry of named queries: a Spark callable and, where SQL can express
the same result, a DuckDB oracle over the driver tables.

Every query takes ``(spark, sf_dir)``, reads the given tables and returns
a DataFrame; computed columns carry the same alias on both sides and
doubles are rounded to 6 places on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sylvan.session import ensure_utc
from sylvan.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
KIND: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name`` with an optional oracle."""

    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_utc(spark)
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        KIND[name] = "oracle" if sql else "rows"
        if sql:
            ORACLE[name] = sql.strip()
        return run

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def r6(c: str | Column) -> Column:
    """Round a double to 6 places (both sides of every comparison do)."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def documents(spark: SparkSession, sf_dir: str, spread: bool = True) -> DataFrame:
    """documents; with ``spread`` a scan of a single split is spread over
    the cores. Regexes and the tokenizer over whole texts in one task are
    the slow path this avoids (token counts at sf0.1: 2.9 s -> 1.5 s); for
    queries that only group texts it measured neutral locally. A table
    with enough splits, as any large one, is read as is."""
    if not spread:
        return table(spark, sf_dir, "documents")
    return read_table(spark, sf_dir, "documents", spread_to=spark.sparkContext.defaultParallelism)


def docs_with_labels(spark: SparkSession, sf_dir: str, spread: bool = True) -> DataFrame:
    """documents LEFT JOIN labels: the table with real NULLs (quality, toxic)."""
    return documents(spark, sf_dir, spread).join(table(spark, sf_dir, "labels"), "doc_id", "left")


def labeled_docs(spark: SparkSession, sf_dir: str, spread: bool = True) -> DataFrame:
    """documents INNER JOIN labels: the labelled rows (model inputs)."""
    return documents(spark, sf_dir, spread).join(table(spark, sf_dir, "labels"), "doc_id", "inner")


def load_all() -> None:
    """Import every query module so its queries are registered."""
    from sylvan.plans import (  # noqa: F401
        feature_queries,
        model_queries,
        prepare_queries,
        profile_queries,
    )
