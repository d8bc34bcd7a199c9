"""Materialisation (S5) and model persistence.

``materialized`` persists a DataFrame for the duration of a ``with``
block and always unpersists it (the reference never releases its
caches). ``checkpointed`` cuts lineage by writing to the shared
checkpoint folder, so a lost executor does not force recomputation of
the whole upstream plan.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from sylvan.session import checkpoint_dir


@contextmanager
def materialized(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Persist ``df``, force it with one count, yield it, then unpersist."""
    cached = df.persist(level)
    try:
        cached.count()
        yield cached
    finally:
        cached.unpersist()


def checkpointed(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into ``spark.checkpoint.dir`` (never a local one)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def save_model(model, path: str) -> str:
    """Save a *fitted* model or pipeline model, overwriting."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str, cls=PipelineModel):
    """Load a model saved by :func:`save_model`."""
    return cls.load(path)
