import pytest
from pyspark.ml.feature import StringIndexer, VectorIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from sylvan import names
from sylvan.operators import features as FT
from sylvan.sources import fixtures as FX

COLS = ["age", "income", "student", "credit_rating"]


def fit_buys(spark, max_cat=3):
    df = FX.buys_computer(spark)
    auto = FT.auto_pipeline(COLS, [], "buys_computer", "classification", max_categories=max_cat)
    return df, auto, auto.pipeline.fit(df)


def test_label_orders(spark):
    df, auto, model = fit_buys(spark)
    idx = auto.text_indexer(model)
    assert [list(x) for x in idx.labelsArray] == [
        ["senior", "young", "middle"],
        ["medium", "high", "low"],
        ["no", "yes"],
        ["fair", "excellent"],
    ]
    assert auto.class_labels(model) == ["yes", "no"]


def test_encoded_rows_match_golden(spark):
    df, auto, model = fit_buys(spark)
    rows = FT.encode(model, df, auto).collect()
    got = [([int(x) for x in r["features"].toArray()], int(r["label"])) for r in rows]
    assert got == [
        ([1, 1, 0, 0], 1), ([1, 1, 0, 1], 1), ([2, 1, 0, 0], 0), ([0, 0, 0, 0], 0),
        ([0, 2, 1, 0], 0), ([0, 2, 1, 1], 1), ([2, 2, 1, 1], 0), ([1, 0, 0, 0], 1),
        ([1, 2, 1, 0], 0), ([0, 0, 1, 0], 0), ([1, 0, 1, 1], 0), ([2, 0, 0, 1], 0),
        ([2, 1, 1, 0], 0), ([0, 0, 0, 1], 1),
    ]


def test_one_hot_drop_last_false(spark):
    df = FX.buys_computer(spark)
    idx = FT.string_indexer(["age"]).fit(df).transform(df)
    hot = FT.one_hot(idx, ["indexed_age"], ["hot"], drop_last=False)
    assert FT.vector_sizes(hot, "hot").first().asDict() == {"min_size": 3, "max_size": 3}
    assert FT.one_hot_valid(hot, "hot").first()["n_invalid"] == 0


@pytest.mark.parametrize("sparse", [False, True])
def test_vector_indexer_maps(spark, sparse):
    df = FX.vector_samples(spark, sparse=sparse)
    model = FT.vector_indexer("features", "idx", max_categories=3).fit(df)
    maps = {s: dict(m) for s, m in model.categoryMaps.items()}
    assert maps == {0: {0.0: 0, 1.0: 1, 2.0: 2}, 2: {11.0: 0, 18.0: 1, 20.0: 2}}
    out = [list(map(int, r["idx"].toArray())) for r in model.transform(df).collect()]
    assert out == [[1, 1, 1], [0, 2, 2], [1, 0, 1], [2, 3, 0]]
    assert FT.slot_kinds(model) == {"categorical": 2, "continuous": 1}


def test_vector_indexer_zero_first(spark):
    df = spark.createDataFrame([(Vectors.dense([v]),) for v in (-3.0, 0.0, 7.0)], ["features"])
    model = FT.vector_indexer("features", "idx", max_categories=3).fit(df)
    assert dict(model.categoryMaps[0]) == {0.0: 0, -3.0: 1, 7.0: 2}
    assert FT.category_maps(model) == [(0, 0.0, 0), (0, -3.0, 1), (0, 7.0, 2)]


def test_vector_indexer_second_sample(spark):
    rows = [[5.0, 10.0], [5.0, 20.0], [7.0, 10.0], [9.0, 20.0]]
    df = spark.createDataFrame([(Vectors.dense(r),) for r in rows], ["features"])
    model = FT.vector_indexer("features", "idx", max_categories=4).fit(df)
    assert {s: dict(m) for s, m in model.categoryMaps.items()} == {0: {5.0: 0, 7.0: 1, 9.0: 2}, 1: {10.0: 0, 20.0: 1}}


def test_handle_invalid_modes(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("b", None), ("c", 4), ("a", 5)], "s string, i int")
    skip = StringIndexer(inputCol="s", outputCol="o", handleInvalid="skip").fit(df).transform(df)
    assert skip.count() == 4
    keep = StringIndexer(inputCol="s", outputCol="o", handleInvalid="keep").fit(df).transform(df)
    assert keep.where(F.col("s").isNull()).first()["o"] == 3.0
    with pytest.raises(Exception):
        StringIndexer(inputCol="s", outputCol="o", handleInvalid="error").fit(df).transform(df).collect()
    assert FT.assemble(df, ["i"], "v", handle_invalid="skip").count() == 4
    kept = FT.assemble(df, ["i"], "v", handle_invalid="keep").where(F.col("i").isNull()).first()["v"]
    assert kept[0] != kept[0]  # NaN


def test_target_excluded_by_exact_name(spark):
    auto = FT.auto_pipeline(["t", "t_code"], ["tx", "n"], "t", "classification")
    assert auto.text_cols == ["t_code"] and auto.numeric_cols == ["tx", "n"]


def test_scaling_only_numeric_part(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("a", 5.0)], "c string, x double")
    auto = FT.auto_pipeline(["c"], ["x"], "x", "regression", max_categories=5, scale_numeric=True)
    assert auto.numeric_cols == []
    auto = FT.auto_pipeline(["c"], ["x"], None, "regression", max_categories=2, scale_numeric=True)
    out = auto.pipeline.fit(df).transform(df)
    first = [r["features"].toArray().tolist() for r in out.collect()]
    assert [v[0] for v in first] == [0.0, 1.0, 0.0]  # category codes not scaled
    assert first[1][1] == pytest.approx(3.0 / 2.0)  # x / std(x)


def test_feature_names_from_metadata(spark):
    df, auto, model = fit_buys(spark)
    out = model.transform(df)
    assert FT.feature_names(out, names.FEATURES) == [names.PREFIX + c for c in COLS]


def test_check_categories(spark):
    from sylvan.operators import profile as P

    df = FX.buys_computer(spark)
    prof = P.profile(df)
    assert FT.check_categories(prof, COLS, max_bins=3) == []
    assert FT.check_categories(prof, COLS, max_bins=3, handle_invalid="keep") == ["age", "income"]


def test_dry_run(spark):
    df = FX.buys_computer(spark)
    auto = FT.auto_pipeline(COLS, [], "buys_computer", "classification", max_categories=3)
    assert FT.dry_run(auto, df)["ok"]


def test_vector_to_array_no_udf(spark):
    df = FX.vector_samples(spark, sparse=True)
    vals = [r[0] for r in df.select(vector_to_array("features")[2]).collect()]
    assert vals == [18.0, 20.0, 18.0, 11.0]
