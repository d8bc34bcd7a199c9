"""Benchmark: headline workloads and registered queries at one scale factor.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_REPS (default 3), BENCH_ONLY (comma list, optional),
BENCH_EVENTLOG (folder for Spark's event log, optional).

once untimed), then BENCH_REPS timed runs per item in a fixed order, the
median reported (it absorbs an item's slower first run); results are
collected when small and written to the no-op sink when large (a
trailing ``count()`` would let Spark prune the work). Fit and transform
are timed separately. Model inputs are persisted and that is said in the
item name. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPS = int(os.environ.get("BENCH_REPS", "3"))
ONLY = [x for x in os.environ.get("BENCH_ONLY", "").split(",") if x]
SEED = 42


def sink(df):
    """Run the whole plan: collect small results, no-op write for big ones."""
    if df.isStreaming:
        raise ValueError("batch only")
    df.write.format("noop").mode("overwrite").save()


def collect(df):
    return df.collect()


def main():
    from sylvan import get_session
    from sylvan.operators import features as FT
    from sylvan.operators import models as M
    from sylvan.operators import profile as P
    from sylvan.plans.registry import QUERIES, load_all
    from sylvan.sources.tables import read_table

    extra = {"spark.driver.memory": "8g"}
    if os.environ.get("BENCH_EVENTLOG"):
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENTLOG"]})
    spark = get_session(app="sylvan-bench", master=f"local[{CPUS}]", shuffle_partitions=max(8, CPUS), extra=extra)
    load_all()

    lineitem = read_table(spark, SF_DIR, "lineitem")
    spread_lineitem = read_table(spark, SF_DIR, "lineitem", spread_to=spark.sparkContext.defaultParallelism)
    text = ["l_returnflag", "l_linestatus"]
    numeric = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
    auto_cls = FT.auto_pipeline(["l_linestatus"], ["l_quantity", "l_extendedprice", "l_discount", "l_tax"],
                                "l_returnflag", "classification", max_categories=32)
    auto_reg = FT.auto_pipeline(text, ["l_quantity", "l_discount", "l_tax", "l_linenumber"],
                                "l_extendedprice", "regression", max_categories=32)
    state = {}

    def fitted_features():
        if "features" not in state:
            state["features"] = FT.auto_pipeline(text, numeric, None, "regression", 32).pipeline.fit(lineitem)
        return state["features"]

    def encoded(key, auto):
        if key not in state:
            feats = auto.pipeline.fit(spread_lineitem)
            state[key] = FT.encode(feats, spread_lineitem, auto).persist()
        return state[key]

    items = {
        "profile_lineitem": lambda: collect(P.profile(lineitem)),
        "profile_lineitem_enriched": lambda: collect(P.profile(lineitem, enriched=True)),
        "profile_lineitem_approx": lambda: collect(P.profile(lineitem, approx=True)),
        "feature_fit": lambda: FT.auto_pipeline(text, numeric, None, "regression", 32).pipeline.fit(lineitem),
        "feature_transform": lambda: sink(fitted_features().transform(lineitem)),
        "dt_classifier_fit_cached": lambda: M.make_model(
            "dt", "classification", maxDepth=5, impurity="entropy", maxBins=32
        ).fit(encoded("cls", auto_cls)),
        "rf_regressor_fit_cached": lambda: M.make_model(
            "rf", "regression", numTrees=5, featureSubsetStrategy="onethird", subsamplingRate=0.5, maxBins=40
        ).fit(encoded("reg", auto_reg)),
        "gbt_regressor_fit_cached": lambda: M.make_model(
            "gbt", "regression", featureSubsetStrategy="onethird", subsamplingRate=0.5, maxBins=40
        ).fit(encoded("reg", auto_reg)),
    }
    for name in (
        "profile_documents", "profile_enriched", "select_complete", "detect_identifiers", "date_parts",
        "impute_median", "hash_split", "undersample", "lookup_enrich", "unknown_categories", "string_index",
        "vector_index", "auto_features_classification", "token_counts", "auc", "stump_regression",
        "classification_workflow", "regression_workflow", "cv_grid", "score_bands", "text_lr",
    ):
        fn = QUERIES[name]
        items[f"q_{name}"] = (lambda f=fn: sink(f(spark, SF_DIR)))

    if ONLY:
        items = {k: v for k, v in items.items() if k in ONLY}
    results = {}
    next(iter(items.values()))()  # warm-up pass
    for name, fn in items.items():
        times = []
        for _ in range(REPS):
            t0 = time.perf_counter()
            fn()
            times.append(time.perf_counter() - t0)
        results[name] = round(statistics.median(times), 3)
        print(f"# {name}: {results[name]}s {['%.2f' % t for t in times]}", file=sys.stderr, flush=True)
    for key, df in state.items():
        if key != "features":
            df.unpersist()
    sf = os.path.basename(SF_DIR).replace("sf", "")
    out = {
        "metric": "sum_of_median_seconds",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": CPUS,
        "reps": REPS,
        "seed": SEED,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
