"""Mergeable profile state against the exact profile."""

import pytest
from pyspark.sql import functions as F

from sylvan.operators import profile as P
from sylvan.operators import profile_state as PS


@pytest.fixture(scope="module")
def rows(spark):
    data = [
        (i, i % 9, f"user {i * 31 % 1500}", None if i % 5 == 0 else float(i * 17 % 1009) - 300, "hot" if i % 3 else f"long {'x' * 90} {i % 40}", None)
        for i in range(12_000)
    ]
    return spark.createDataFrame(data, "id long, day int, user string, x double, t string, none string").repartition(4).persist()


def test_merged_states_equal_the_whole_and_its_bounds(spark, rows):
    whole = {r["name"]: r for r in PS.profile_from_states(PS.profile_state(rows)).collect()}
    states = PS.profile_state(rows, "day")
    assert states.count() == 9 * 6
    sliced = {r["name"]: r for r in PS.profile_from_states(states).collect()}
    halves = PS.merge_states(states.where("slice < '4'")).unionByName(PS.merge_states(states.where("slice >= '4'")))
    twice = {r["name"]: r for r in PS.profile_from_states(halves).collect()}
    exact = {r["name"]: r for r in P.profile(rows, enriched=True).collect()}
    for name, e in exact.items():
        for got in (whole[name], sliced[name], twice[name]):
            assert (got["nRows"], got["nullCount"], got["compRatio"], got["origType"], got["colType"]) == (e["nRows"], e["nullCount"], e["compRatio"], e["origType"], e["colType"])
            assert got["nbDistinctNonNull"] == whole[name]["nbDistinctNonNull"]
            assert abs(got["nbDistinctNonNull"] - e["nbDistinctNonNull"]) <= 4 * PS.DISTINCT_ERROR * e["nbDistinctNonNull"]
            assert (got["frequency"] is None) == (e["frequency"] is None)
            if e["frequency"]:
                assert e["frequency"] - got["frequency"] <= PS.FREQUENCY_ERROR * e["nRows"]
    assert [whole[c]["mostFrequentValue"] for c in ("t", "none")] == ["hot", None] and whole["t"]["frequency"] == 8000
    x = sorted(r["x"] for r in rows.where("x is not null").select("x").collect())
    for got in (whole["x"], sliced["x"], twice["x"]):
        assert (got["least"], got["greatest"]) == (x[0], x[-1])
        assert got["mean"] == pytest.approx(sum(x) / len(x))
        rank = sum(v <= got["median"] for v in x) / len(x)
        assert abs(rank - 0.5) <= PS.RANK_ERROR + 0.002
    assert whole["user"]["median"] is None
    one = {r["name"]: r["nbDistinctNonNull"] for r in PS.profile_from_states(PS.profile_state(rows.coalesce(1))).collect()}
    assert one == {n: r["nbDistinctNonNull"] for n, r in sliced.items()}
    mostly_null = rows.select(F.when(F.col("id") % 10 == 0, F.col("id") % 3).alias("v"))
    (r,) = PS.profile_from_states(PS.profile_state(mostly_null)).collect()
    assert (r["mostFrequentValue"] in ("0", "1", "2"), r["frequency"], r["nullCount"]) == (True, 400, 10_800)


def test_refresh_reads_new_slices_only(spark, rows, tmp_path):
    path = str(tmp_path / "states")
    assert PS.saved_slices(spark, path) == []
    assert PS.refresh(rows.where("day < 5"), "day", path) == ["0", "1", "2", "3", "4"]
    assert PS.refresh(rows, "day", path) == ["5", "6", "7", "8"]
    assert PS.refresh(rows, "day", path) == []
    # a slice with a state is not read again: rows that came to it later are not seen
    assert PS.refresh(rows.union(rows.where("day = 1")), "day", path) == []
    got = {r["name"]: r["nRows"] for r in PS.profile_from_states(PS.load_states(spark, path)).collect()}
    assert set(got.values()) == {12_000}


def test_empty_table_and_approximate_mode(spark, rows):
    none = PS.profile_from_states(PS.profile_state(rows.limit(0))).collect()
    assert none == []
    got = {r["name"]: r for r in P.profile(rows, enriched=True, approx=True).collect()}
    assert got["t"]["mostFrequentValue"] == "hot" and got["t"]["frequency"] == 8000 and got["day"]["frequency"] == 1334
    assert got["none"]["frequency"] is None and list(got["t"].asDict()) == P.ENRICHED_COLUMNS
