import os
import tempfile

from pyspark.ml import PipelineModel

from sylvan import checkpoint_dir, scratch_path
from sylvan.operators import features as FT
from sylvan.sources import fixtures as FX
from sylvan.sources.persist import load_model, materialized, save_model
from sylvan.sources.tables import read_csv, read_table, write_csv

from conftest import SF_SMALL


def test_csv_roundtrip_inferred_and_explicit(spark):
    df = FX.golf(spark)
    path = write_csv(df, os.path.join(tempfile.mkdtemp(), "golf"))
    inferred = read_csv(spark, path)
    assert dict(inferred.dtypes)["hours"] == "double" and inferred.count() == 14
    explicit = read_csv(spark, path, schema=FX.GOLF_SCHEMA)
    assert sorted(explicit.collect()) == sorted(df.collect())


def test_read_table(spark):
    assert read_table(spark, SF_SMALL, "region").count() == 5


def test_materialized_releases_cache(spark):
    df = spark.range(10)
    with materialized(df) as cached:
        assert cached.is_cached
    assert not df.is_cached


def test_save_and_load_fitted_pipeline(spark):
    df = FX.buys_computer(spark)
    auto = FT.auto_pipeline(["age", "income", "student", "credit_rating"], [], "buys_computer", max_categories=3)
    fitted = auto.pipeline.fit(df)
    path = save_model(fitted, scratch_path(spark, "test-models"))
    loaded = load_model(path)
    assert isinstance(loaded, PipelineModel)
    a = [r["features"] for r in fitted.transform(df).collect()]
    b = [r["features"] for r in loaded.transform(df).collect()]
    assert a == b


def test_scratch_is_under_checkpoint_dir(spark):
    assert scratch_path(spark, "x").startswith(checkpoint_dir(spark).rstrip("/"))
