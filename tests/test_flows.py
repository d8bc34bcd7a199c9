"""End-to-end flows on the driver tables: signal, column choice, cache release."""

from sylvan.operators import evaluate as EV
from sylvan.plans.flows import document_features, placed, profile_driven_flow, supervised_flow
from sylvan.plans.registry import QUERIES, labeled_docs, load_all

from conftest import SF_ORACLE

load_all()


def test_classification_flow_beats_majority_and_releases_caches(spark):
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    df = document_features(labeled_docs(spark, SF_ORACLE))
    majority = df.groupBy("quality").count().agg({"count": "max"}).first()[0] / df.count()
    res = profile_driven_flow(df, "quality", "doc_id", "classification", "dt", 31, impurity="entropy")
    assert "quality" not in res.auto.text_cols + res.auto.numeric_cols
    assert "doc_id" not in res.auto.numeric_cols  # identifier, dropped by the profile
    assert set(res.auto.text_cols) == {"lang", "source"}
    acc = EV.classification_metrics(res.predictions).first()["accuracy"]
    assert acc > majority
    res.release()
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == before


def test_forest_does_not_depend_on_how_the_input_is_dealt(spark):
    df = document_features(labeled_docs(spark, SF_ORACLE)).persist()
    seen = set()
    for given in (df.coalesce(1), df.repartition(7), df.repartition(3, "lang")):
        res = supervised_flow(given, "quality", "doc_id", ["lang"], ["n_chars", "letter_share"], algo="rf", partitions=3, numTrees=5, maxDepth=4)
        assert res.train.rdd.getNumPartitions() == 3
        seen.add(res.model.toDebugString.split("\n", 1)[1])
        res.release()
    df.unpersist()
    assert len(seen) == 1


def test_placed_keeps_rows(spark):
    df = spark.createDataFrame([(1, None), (1, None), (None, "a"), (2, "b"), (None, None)], "k long, v string")
    out = placed(df, "k", 4)
    assert out.rdd.getNumPartitions() == 4
    assert sorted(out.collect(), key=repr) == sorted(df.collect(), key=repr)
    assert placed(df.limit(0), "k", 4).count() == 0


def test_regression_workflow_beats_the_mean(spark):
    rows = QUERIES["regression_workflow"](spark, SF_ORACLE).where("metric = 'r2'").collect()
    assert {r["model"] for r in rows} == {"dt", "rf", "gbt"}
    assert all(r["value"] > 0 for r in rows)
