"""Dictionary numbers against StringIndexer, with ties, NULLs, hot labels and odd strings."""

import pytest
from pyspark.sql import functions as F

from sylvan.operators import features as FT
from sylvan.operators import label_dictionary as LD


@pytest.fixture(scope="module")
def rows(spark):
    odd = ["", " ", "a", "A", "ä", "\U0001f600", "￿", "z\x00", "it's", None]
    data = [(i, odd[i * i % 10], f"v{i % 700}" if i % 3 else "hot", i % 13) for i in range(6000)]
    return spark.createDataFrame(data, "id long, odd string, `many labels` string, num int").repartition(5).persist()


COLS = ["odd", "many labels", "num"]


@pytest.mark.parametrize("buckets", [1, 3, 16])
def test_numbers_equal_string_indexer(spark, rows, buckets):
    model = FT.string_indexer(COLS, handle_invalid="keep").fit(rows)
    want = {(c, v): i for c, v, i in FT.label_maps(model, COLS)}
    got = LD.label_dictionary(rows, COLS, buckets).collect()
    assert {(r["column"], r["value"]): r["index"] for r in got} == want
    assert len(got) == len(want)
    assert sum(r["n"] for r in got if r["column"] == "odd") == rows.where("odd is not null").count()


@pytest.mark.parametrize("hot_rows", [1, 10**9])
def test_encoding_equals_string_indexer(spark, rows, monkeypatch, hot_rows):
    """All labels hot, and none."""
    monkeypatch.setattr(LD, "HOT_ROWS", hot_rows)
    known = rows.where("id < 3000 and coalesce(odd, '') not in ('a', 'A')")
    d = LD.label_dictionary(known, COLS)
    for mode in ("keep", "skip"):
        want = FT.string_indexer(COLS, handle_invalid=mode).fit(known).transform(rows)
        got = LD.encode_labels(rows, d, COLS, handle_invalid=mode)
        assert got.columns == want.columns
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) if mode == "skip" else got.exceptAll(want).count() == 0 == want.exceptAll(got).count()
    with pytest.raises(Exception, match="unknown label in odd"):
        LD.encode_labels(rows, d, COLS).collect()


def test_only_hot_labels_are_broadcast_by_hint(spark, rows):
    d = LD.label_dictionary(rows, ["many labels"])
    got = LD.encode_labels(rows, d, ["many labels"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # broadcast: the hot labels, and the offsets of the buckets in both readings of the dictionary
    assert plan.count("SortMergeJoin") == 1 and plan.count("BroadcastHashJoin") == 3 and "Union" not in plan


def test_decode_and_empty_table(spark, rows):
    d = LD.label_dictionary(rows, COLS)
    back = LD.decode_labels(LD.encode_labels(rows, d, COLS, handle_invalid="keep"), d, "indexed_odd", "odd", "again")
    assert back.where(~F.col("again").eqNullSafe(F.col("odd"))).count() == 0 and back.count() == 6000
    none = rows.limit(0)
    assert LD.label_dictionary(none, COLS).count() == 0
    assert LD.encode_labels(none, LD.label_dictionary(none, COLS), COLS).count() == 0
    assert LD.encode_labels(rows, LD.label_dictionary(none, COLS), COLS, handle_invalid="keep").agg(F.max("indexed_odd")).first()[0] == 0.0
