"""Evaluation, tree and model queries.

Evaluators and single-split trees are checked against SQL: predictions
come from fixed rules (or a depth-1 tree, whose best split SQL can find
with prefix sums). Trained ensembles, cross-validation and scoring are
checked on rows only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylvan import names
from sylvan.functions.columns import letter_share
from sylvan.operators import compiled as CP
from sylvan.operators import evaluate as EV
from sylvan.operators import explain as EX
from sylvan.operators import features as FT
from sylvan.operators import models as M
from sylvan.operators import score as SC
from sylvan.operators import text as TX
from sylvan.operators import tune as TU
from sylvan.plans.flows import chosen_columns, document_features, needed_bins, profile_driven_flow, supervised_flow
from sylvan.plans.registry import docs_with_labels, documents, labeled_docs, query, r6, table

# Fixed values of the evaluation rules.
LETTER_SHARE_CUT = 0.7

LS_SQL = r"length(regexp_replace(d.text, '[^\p{L}]', '', 'g'))::DOUBLE / nullif(length(d.text), 0)"
RULE_SQL = f"""
    (SELECT d.doc_id, l.quality::DOUBLE AS label, {LS_SQL} AS score,
            CASE WHEN {LS_SQL} >= {LETTER_SHARE_CUT} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
     FROM documents d JOIN labels l ON d.doc_id = l.doc_id)
"""
PRICE_RULE_SQL = """
    (SELECT p_partkey, p_retailprice AS label, 925.0 + (p_partkey % 1000) / 20.0 AS prediction FROM part)
"""


def _rule_predictions(spark, sf_dir):
    """label = quality, score = letter share, prediction = score >= 0.7."""
    d = labeled_docs(spark, sf_dir)
    score = letter_share("text")
    return d.select(
        "doc_id",
        F.col("quality").cast("double").alias(names.LABEL),
        score.alias("score"),
        F.when(score >= LETTER_SHARE_CUT, 1.0).otherwise(0.0).alias(names.PREDICTION),
    )


def _price_predictions(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select(
        "p_partkey",
        F.col("p_retailprice").alias(names.LABEL),
        (F.lit(925.0) + F.pmod("p_partkey", F.lit(1000)) / F.lit(20.0)).alias(names.PREDICTION),
    )


@query(
    "accuracy",
    f"""
    SELECT count(*) AS n, round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
           round(1 - avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS test_error
    FROM {RULE_SQL}
    """,
)
def accuracy(spark, sf_dir):
    """M9: accuracy and test error of a rule prediction, one aggregate."""
    m = EV.classification_metrics(_rule_predictions(spark, sf_dir))
    return m.select("n", r6("accuracy").alias("accuracy"), r6("test_error").alias("test_error"))


@query("confusion", f"SELECT label, prediction, count(*) AS n FROM {RULE_SQL} GROUP BY 1, 2")
def confusion(spark, sf_dir):
    """M9: confusion matrix as (label, prediction, n)."""
    return EV.confusion(_rule_predictions(spark, sf_dir))


@query("errors", f"SELECT doc_id, label, prediction FROM {RULE_SQL} WHERE label != prediction")
def errors(spark, sf_dir):
    """Misclassified rows."""
    return EV.errors(_rule_predictions(spark, sf_dir)).select("doc_id", names.LABEL, names.PREDICTION)


@query(
    "auc",
    f"""
    WITH g AS (SELECT score AS s, sum(label) AS pos, sum(1 - label) AS neg FROM {RULE_SQL} GROUP BY 1),
    r AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
          FROM g)
    SELECT round(sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)), 6) AS auc,
           CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg
    FROM r
    """,
)
def auc(spark, sf_dir):
    """Exact ROC AUC of the letter-share score (ties count one half)."""
    a = EV.auc(_rule_predictions(spark, sf_dir), names.LABEL, "score")
    return a.select(r6("auc").alias("auc"), "n_pos", "n_neg")


@query(
    "auc_by_source",
    f"""
    WITH g AS (SELECT d.source, r.score AS s, sum(r.label) AS pos, sum(1 - r.label) AS neg
               FROM {RULE_SQL} r JOIN documents d ON d.doc_id = r.doc_id GROUP BY 1, 2),
    r AS (SELECT source, pos, neg, coalesce(sum(neg) OVER (PARTITION BY source ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
          FROM g)
    SELECT source, round(sum(pos * (below + neg / 2.0)) / nullif(sum(pos) * sum(neg), 0), 6) AS auc,
           CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg
    FROM r GROUP BY source
    """,
)
def auc_by_source(spark, sf_dir):
    """Exact AUC of the letter-share score of every source, all in one shuffle."""
    d = labeled_docs(spark, sf_dir).select("source", F.col("quality").alias(names.LABEL), letter_share("text").alias("score"))
    found = EV.auc_by(d, ["source"], names.LABEL, "score")
    return found.select("source", r6("auc").alias("auc"), "n_pos", "n_neg")


@query(
    "rmse_mae_r2",
    f"""
    SELECT count(*) AS n, round(sqrt(avg((prediction - label) * (prediction - label))), 6) AS rmse,
           round(avg((prediction - label) * (prediction - label)), 6) AS mse,
           round(avg(abs(prediction - label)), 6) AS mae,
           round(1 - sum((prediction - label) * (prediction - label)) / (var_pop(label) * count(*)), 6) AS r2
    FROM {PRICE_RULE_SQL}
    """,
)
def rmse_mae_r2(spark, sf_dir):
    """RMSE, MSE, MAE and R^2 in one aggregate."""
    m = EV.regression_metrics(_price_predictions(spark, sf_dir))
    return m.select("n", *[r6(c).alias(c) for c in ("rmse", "mse", "mae", "r2")])


@query(
    "metrics_null_labels",
    """
    WITH p AS (SELECT l.quality::DOUBLE AS label, d.n_chars::DOUBLE AS score, (d.n_chars >= 1000)::INTEGER::DOUBLE AS prediction
               FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
    k AS (SELECT * FROM p WHERE label IS NOT NULL),
    g AS (SELECT score AS s, sum(label) AS pos, sum(1 - label) AS neg FROM k GROUP BY 1),
    r AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g)
    SELECT count(*) AS n, (SELECT count(*) FROM p WHERE label IS NULL) AS n_skipped,
           round(avg((label = prediction)::INTEGER), 6) AS accuracy,
           round(sqrt(avg((prediction - label) ^ 2)), 6) AS rmse,
           round(1 - sum((prediction - label) ^ 2) / (var_pop(label) * count(*)), 6) AS r2,
           (SELECT round(sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)), 6) FROM r) AS auc
    FROM k
    """,
)
def metrics_null_labels(spark, sf_dir):
    """M9-M11 where most labels are NULL: those rows are left out and counted."""
    p = docs_with_labels(spark, sf_dir).select(
        F.col("quality").cast("double").alias(names.LABEL),
        F.col("n_chars").cast("double").alias("score"),
        (F.col("n_chars") >= 1000).cast("double").alias(names.PREDICTION),
    )
    acc = EV.classification_metrics(p).select("n", "n_skipped", r6("accuracy").alias("accuracy"))
    reg = EV.regression_metrics(p).select("n", *[r6(c).alias(c) for c in ("rmse", "r2")])
    return acc.join(reg, "n").join(F.broadcast(EV.auc(p).select("n_pos", "n_neg", r6("auc").alias("auc"))), F.expr("n = n_pos + n_neg")).drop("n_pos", "n_neg")


@query(
    "rule_compare",
    f"""
    WITH p AS {PRICE_RULE_SQL},
    m AS (SELECT 'partkey_rule' AS model, sqrt(avg((prediction - label) ^ 2)) AS rmse, avg((prediction - label) ^ 2) AS mse,
                 avg(abs(prediction - label)) AS mae, 1 - sum((prediction - label) ^ 2) / (var_pop(label) * count(*)) AS r2 FROM p
          UNION ALL
          SELECT 'constant_950', sqrt(avg((950.0 - label) ^ 2)), avg((950.0 - label) ^ 2), avg(abs(950.0 - label)),
                 1 - sum((950.0 - label) ^ 2) / (var_pop(label) * count(*)) FROM p)
    SELECT model, metric, round(value, 6) AS value FROM m
    UNPIVOT (value FOR metric IN (rmse, mse, mae, r2))
    """,
)
def rule_compare(spark, sf_dir):
    """(model, metric, value) table for two predictors."""
    p = _price_predictions(spark, sf_dir)
    const = p.withColumn(names.PREDICTION, F.lit(950.0))
    cmp = EV.compare_models({"partkey_rule": p, "constant_950": const}, "regression")
    return cmp.select("model", "metric", r6("value").alias("value"))


def _stump_nodes(spark, model):
    nodes = EX.tree_nodes(spark, model).where("treeID = 0")
    root = nodes.where("id = 0").select(
        F.col("categories")[0].alias("threshold"), F.col("leftChild").alias("l"), F.col("rightChild").alias("r")
    )
    left = nodes.select(F.col("id").alias("l"), F.col("rawCount").alias("left_n"), F.col("prediction").alias("left_pred"))
    right = nodes.select(F.col("id").alias("r"), F.col("rawCount").alias("right_n"), F.col("prediction").alias("right_pred"))
    return root.join(left, "l").join(right, "r")


# Best variance split of price on size (prefix sums over distinct sizes).
STUMP_REG_SQL = """
    g AS (SELECT p_size::DOUBLE AS x, count(*) AS n, sum(p_retailprice) AS s FROM part GROUP BY 1),
    c AS (SELECT x, lead(x) OVER (ORDER BY x) AS nx, sum(n) OVER (ORDER BY x) AS nl, sum(s) OVER (ORDER BY x) AS sl FROM g),
    tot AS (SELECT sum(n) AS n, sum(s) AS s FROM g),
    cand AS (SELECT (x + nx) / 2 AS threshold, nl, sl, tot.n - nl AS nr, tot.s - sl AS sr FROM c, tot WHERE nx IS NOT NULL),
    best AS (SELECT * FROM cand ORDER BY sl * sl / nl + sr * sr / nr DESC LIMIT 1)
"""


def _regression_stump(spark, sf_dir):
    part = FT.assemble(table(spark, sf_dir, "part"), ["p_size"], names.FEATURES)
    part = part.withColumn(names.LABEL, F.col("p_retailprice"))
    return part, M.make_model("dt", "regression", maxDepth=1, maxBins=64).fit(part)


@query(
    "stump_regression",
    f"""
    WITH {STUMP_REG_SQL}
    SELECT round(threshold, 6) AS threshold, CAST(nl AS BIGINT) AS left_n, CAST(nr AS BIGINT) AS right_n,
           round(sl / nl, 6) AS left_mean, round(sr / nr, 6) AS right_mean
    FROM best
    """,
)
def stump_regression(spark, sf_dir):
    """M3 at depth 1: best variance split of price on size, leaf means."""
    _, model = _regression_stump(spark, sf_dir)
    s = _stump_nodes(spark, model)
    return s.select(
        r6("threshold").alias("threshold"),
        "left_n",
        "right_n",
        r6("left_pred").alias("left_mean"),
        r6("right_pred").alias("right_mean"),
    )


# Best gini split of quality on the letter-share bucket x = floor(20 * share).
STUMP_CLS_SQL = f"""
    s AS (SELECT floor(20 * score) AS x, label AS y FROM {RULE_SQL}),
    g AS (SELECT x, count(*) AS n, sum(y) AS p FROM s GROUP BY 1),
    c AS (SELECT x, lead(x) OVER (ORDER BY x) AS nx, sum(n) OVER (ORDER BY x) AS nl, sum(p) OVER (ORDER BY x) AS pl FROM g),
    tot AS (SELECT sum(n) AS n, sum(p) AS p FROM g),
    cand AS (SELECT (x + nx) / 2 AS threshold, nl, pl, tot.n - nl AS nr, tot.p - pl AS pr FROM c, tot WHERE nx IS NOT NULL),
    best AS (SELECT * FROM cand ORDER BY (2 * pl * (nl - pl) / nl) + (2 * pr * (nr - pr) / nr) ASC LIMIT 1)
"""


@query(
    "stump_classification",
    f"""
    WITH {STUMP_CLS_SQL}
    SELECT round(threshold, 6) AS threshold, CAST(nl AS BIGINT) AS left_n, CAST(nr AS BIGINT) AS right_n,
           CASE WHEN 2 * pl > nl THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS left_pred,
           CASE WHEN 2 * pr > nr THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS right_pred
    FROM best
    """,
)
def stump_classification(spark, sf_dir):
    """M1 at depth 1 (gini): best split of quality on the letter-share bucket."""
    model = _classification_stump(spark, sf_dir)
    s = _stump_nodes(spark, model)
    return s.select(r6("threshold").alias("threshold"), "left_n", "right_n", "left_pred", "right_pred")


def _share_bucket(df):
    """x = floor(20 * letter share) as the single feature vector."""
    return FT.assemble(df.withColumn("x", F.floor(letter_share("text") * 20).cast("double")), ["x"], names.FEATURES)


def _classification_stump(spark, sf_dir):
    p = _rule_predictions(spark, sf_dir).select(
        F.floor(F.col("score") * 20).cast("double").alias("x"), F.col(names.LABEL)
    )
    p = FT.assemble(p, ["x"], names.FEATURES)
    return M.make_model("dt", "classification", maxDepth=1, maxBins=32, impurity="gini").fit(p)


@query(
    "stump_rules",
    f"""
    WITH {STUMP_REG_SQL}
    SELECT 0 AS treeID, 1 AS leaf, 'p_size <= ' || CAST(threshold::DOUBLE AS VARCHAR) AS rule,
           round(sl / nl, 6) AS prediction, CAST(NULL AS VARCHAR) AS predicted_class, CAST(nl AS BIGINT) AS n FROM best
    UNION ALL
    SELECT 0, 2, 'p_size > ' || CAST(threshold::DOUBLE AS VARCHAR), round(sr / nr, 6), NULL, CAST(nr AS BIGINT) FROM best
    """,
)
def stump_rules(spark, sf_dir):
    """The regression stump as rules with the feature's name."""
    part, model = _regression_stump(spark, sf_dir)
    names_ = FT.feature_names(part, names.FEATURES)
    rules = EX.tree_rules(spark, model, names_)
    return rules.select("treeID", "leaf", "rule", r6("prediction").alias("prediction"), "predicted_class", "n")


@query(
    "stump_score_bands",
    f"""
    WITH {STUMP_CLS_SQL},
    u AS (SELECT d.doc_id, floor(20 * {LS_SQL}) AS x
          FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.doc_id IS NULL),
    p AS (SELECT u.doc_id, CASE WHEN u.x <= b.threshold THEN b.pl / b.nl ELSE b.pr / b.nr END AS p1 FROM u, best b)
    SELECT doc_id, CASE WHEN p1 > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction,
           round(greatest(p1, 1 - p1), 6) AS max_probability,
           CASE WHEN greatest(p1, 1 - p1) > 0.9 THEN 'high' WHEN greatest(p1, 1 - p1) > 0.7 THEN 'medium'
                ELSE 'low' END AS confidence_level
    FROM p
    """,
)
def stump_score_bands(spark, sf_dir):
    """Score the unlabelled documents with the fitted stump;
    class probability of the leaf, confidence band."""
    model = _classification_stump(spark, sf_dir)
    docs = docs_with_labels(spark, sf_dir, spread=True).where(F.col("quality").isNull())
    pred = model.transform(_share_bucket(docs))
    bands = SC.prediction_bands(pred)
    return bands.select("doc_id", names.PREDICTION, r6("max_probability").alias("max_probability"), "confidence_level")


# ---------------------------------------------------------------- trained models (rows only)

DOC_TEXT = ["lang", "source"]
DOC_NUMERIC = ["n_chars", "letter_share", "distinct_token_share"]
PART_TEXT = ["p_type", "p_brand"]
PART_NUMERIC = ["p_size", "p_partkey"]


def _doc_frame(spark, sf_dir):
    return document_features(labeled_docs(spark, sf_dir))


def _doc_flow(spark, sf_dir, algo="dt", **params):
    return supervised_flow(
        _doc_frame(spark, sf_dir), "quality", "doc_id", DOC_TEXT, DOC_NUMERIC, "classification", algo, 32, **params
    )


def _part_flow(spark, sf_dir, algo="dt", **params):
    part = table(spark, sf_dir, "part")
    return supervised_flow(part, "p_retailprice", "p_partkey", PART_TEXT, PART_NUMERIC, "regression", algo, 40, **params)


def _with_score(pred):
    return EV.positive_score(pred)


def _summary(pred):
    """(metric, value) rows: n, accuracy, test error and AUC on the test part."""
    pred = _with_score(pred)
    return EV.metrics_long(EV.classification_metrics(pred)).unionByName(
        EV.metrics_long(EV.auc(pred, names.LABEL, "score").select("auc"))
    )


@query("dt_classify", None)
def dt_classify(spark, sf_dir):
    """M2: entropy decision tree on document signals; accuracy and AUC on test."""
    res = _doc_flow(spark, sf_dir, "dt", impurity="entropy")
    return res.small_result(_summary(res.predictions))


@query("rebalanced_fit", None)
def rebalanced_fit(spark, sf_dir):
    """T2 into a fit: the decision tree on all training rows, on weighted classes and on undersampled ones. For each
    class (its index, 0 the larger one): rows and weight that the fit saw, test rows and the share of them found."""
    found = []
    for how in (None, "weights", "undersample"):
        # few categories: Spark's trees need as many rows as a feature has categories, also after undersampling
        res = supervised_flow(
            _doc_frame(spark, sf_dir), "quality", "doc_id", ["lang"], DOC_NUMERIC, "classification", "dt", 8, impurity="entropy", rebalance=how
        )
        weight = F.col("weight") if how == "weights" else F.lit(1.0)
        seen = res.train.groupBy(F.col(names.LABEL).cast("int").alias("class")).agg(F.count(F.lit(1)).alias("n_train"), F.sum(weight).alias("weight_train"))
        hit = F.avg((F.col(names.LABEL) == F.col(names.PREDICTION)).cast("double"))
        tested = res.predictions.groupBy(F.col(names.LABEL).cast("int").alias("class")).agg(F.count(F.lit(1)).alias("n_test"), hit.alias("recall"))
        out = seen.join(tested, "class", "full").select(F.lit(how or "none").alias("rebalance"), "class", "n_train", "weight_train", "n_test", "recall")
        found.append(res.small_result(out))
    return reduce(DataFrame.unionByName, found)


@query("dt_regress", None)
def dt_regress(spark, sf_dir):
    """M3: regression tree on part, maxBins from the categories (>= 40)."""
    res = _part_flow(spark, sf_dir, "dt", maxBins=40)
    return res.small_result(EV.regression_metrics(res.predictions))


@query("rf_regress", None)
def rf_regress(spark, sf_dir):
    """M4: random forest, 5 trees, onethird features, subsample 0.5."""
    res = _part_flow(
        spark, sf_dir, "rf", numTrees=5, featureSubsetStrategy="onethird", subsamplingRate=0.5, maxBins=40
    )
    return res.small_result(EV.regression_metrics(res.predictions))


@query("gbt_regress", None)
def gbt_regress(spark, sf_dir):
    """M5: gradient-boosted trees, onethird, subsample 0.5, 20 rounds."""
    res = _part_flow(spark, sf_dir, "gbt", featureSubsetStrategy="onethird", subsamplingRate=0.5, maxBins=40)
    return res.small_result(EV.regression_metrics(res.predictions))


@query("rf_classify", None)
def rf_classify(spark, sf_dir):
    """M6: random forest classifier with 10 trees."""
    res = _doc_flow(spark, sf_dir, "rf", numTrees=10)
    return res.small_result(_summary(res.predictions))


@query("model_compare", None)
def model_compare(spark, sf_dir):
    """DT vs RF vs GBT on the same split, long table incl. GBT."""
    flows = {
        "dt": _part_flow(spark, sf_dir, "dt", maxBins=40),
        "rf": _part_flow(spark, sf_dir, "rf", numTrees=3, featureSubsetStrategy="onethird", subsamplingRate=0.5),
        "gbt": _part_flow(spark, sf_dir, "gbt", maxIter=10, featureSubsetStrategy="onethird", subsamplingRate=0.5),
    }
    cmp = EV.compare_models({k: f.predictions for k, f in flows.items()}, "regression")
    rows, schema = cmp.collect(), cmp.schema
    for f in flows.values():
        f.release()
    return spark.createDataFrame(rows, schema)


def _cv_parts(spark, sf_dir):
    df = _doc_frame(spark, sf_dir).select("doc_id", "quality", *DOC_TEXT, *DOC_NUMERIC)
    auto = FT.auto_pipeline(DOC_TEXT, DOC_NUMERIC, "quality", "classification", 32, "keep")
    return df, auto, M.make_model("dt", "classification", impurity="entropy", maxBins=40)


@query("cv_grid", None)
def cv_grid(spark, sf_dir):
    """5-fold CV of a tree over 4 grid points by exact AUC, features fitted once a fold."""
    df, auto, tree = _cv_parts(spark, sf_dir)
    grid = TU.param_grid(tree, {"maxDepth": [4, 6], "minInstancesPerNode": [10, 100]})
    found = TU.cross_validate_shared(auto, tree, grid, df, "doc_id", folds=5, parallelism=5, purpose="quality")
    return TU.shared_grid_metrics(found)


@query("cv_best", None)
def cv_best(spark, sf_dir):
    """The best of a grid with text values (impurity), refitted on all
    training rows: accuracy, test error and AUC on the test rows, and importances."""
    from sylvan.operators import target as TG

    df, auto, tree = _cv_parts(spark, sf_dir)
    df = df.persist()
    try:
        train, test = TG.hash_split(df, "doc_id")
        grid = TU.param_grid(tree, {"impurity": ["gini", "entropy"], "maxDepth": [3, 6]})
        found = TU.cross_validate_shared(auto, tree, grid, train, "doc_id", folds=3, parallelism=3, purpose="quality")
        point = TU.best_point(found, grid)
        features, model, scored = TU.fit_best(auto, tree, point, train, test)
        metrics = EV.metrics_long(EV.classification_metrics(scored)).unionByName(EV.metrics_long(EV.auc(scored, names.LABEL, "score").select("auc")))
        rows = [("test", r["metric"], r["value"]) for r in metrics.collect()]
        rows += [("importance", n, float(v)) for n, v in zip(auto.assembled, model.featureImportances.toArray())]
        rows += [("best", p.name, float(v)) for p, v in point.items() if not isinstance(v, str)]
    finally:
        df.unpersist()
    return spark.createDataFrame(rows, "kind string, name string, value double")


@query("importances", None)
def importances(spark, sf_dir):
    """Named feature importances of the regression tree."""
    res = _part_flow(spark, sf_dir, "dt", maxBins=40)
    res.release()
    return EX.importances(spark, res.model, res.feature_names)


@query("tree_rules", None)
def tree_rules(spark, sf_dir):
    """The classification tree as readable rules with category labels."""
    res = _doc_flow(spark, sf_dir, "dt", impurity="entropy", maxDepth=3)
    idx = res.auto.text_indexer(res.features)
    labels = EX.slot_labels(idx, DOC_TEXT, res.features.stages[-1], res.auto.assembled)
    classes = res.auto.class_labels(res.features)
    res.release()
    return EX.tree_rules(spark, res.model, res.feature_names, labels, classes)


def _agreement(spark, res, rows, key, tolerance=0.0):
    """Compiled predictions of all ``rows`` against the fitted model's."""
    res.release()
    e = CP.ensemble(spark, res.model)
    return CP.agreement(SC.score(res.features, res.model, rows), e, CP.raw_slots(res.auto, res.features), key, tolerance)


ALL_DOCS_AGREE = "SELECT doc_id, TRUE AS same_raw, TRUE AS same_vector FROM documents"
ALL_PARTS_AGREE = "SELECT p_partkey, TRUE AS same_raw, TRUE AS same_vector FROM part"


@query("rules_score_dt", ALL_DOCS_AGREE)
def rules_score_dt(spark, sf_dir):
    """The entropy tree as one expression over raw columns, and over
    the vector, gives the model's class for every document, labelled or not."""
    res = _doc_flow(spark, sf_dir, "dt", impurity="entropy")
    return _agreement(spark, res, document_features(documents(spark, sf_dir)), "doc_id")


@query("rules_score_rf_classify", ALL_DOCS_AGREE)
def rules_score_rf_classify(spark, sf_dir):
    """The class votes of a forest of 10 trees as one expression, on every document."""
    res = _doc_flow(spark, sf_dir, "rf", numTrees=10)
    return _agreement(spark, res, document_features(documents(spark, sf_dir)), "doc_id")


@query("rules_score_rf", ALL_PARTS_AGREE)
def rules_score_rf(spark, sf_dir):
    """The mean of a forest of 5 regression trees as one expression, on every part."""
    res = _part_flow(spark, sf_dir, "rf", numTrees=5, featureSubsetStrategy="onethird", subsamplingRate=0.5, maxBins=40)
    return _agreement(spark, res, table(spark, sf_dir, "part"), "p_partkey")


@query("rules_score_gbt", ALL_PARTS_AGREE)
def rules_score_gbt(spark, sf_dir):
    """20 boosted stages summed in one expression, on every part
    (equal but for the order of the sum: 1e-12 of the value)."""
    res = _part_flow(spark, sf_dir, "gbt", featureSubsetStrategy="onethird", subsamplingRate=0.5, maxBins=40)
    return _agreement(spark, res, table(spark, sf_dir, "part"), "p_partkey", 1e-12)


@query(
    "rules_leaf_counts",
    "SELECT CAST(count(*) AS BIGINT) AS n_rows, TRUE AS every_row_in_one_leaf, TRUE AS leaf_counts_equal FROM part",
)
def rules_leaf_counts(spark, sf_dir):
    """A regression tree's printed rules, run as SQL filters over the raw
    table it was fitted on, are disjoint, hold every row, and each holds as
    many rows as its leaf counted in training."""
    part = table(spark, sf_dir, "part")
    auto = FT.auto_pipeline(PART_TEXT, PART_NUMERIC, "p_retailprice", "regression", 40, "keep")
    feats = auto.pipeline.fit(part)
    train = FT.encode(feats, part, auto)
    model = M.make_model("dt", "regression", maxBins=needed_bins(feats, 40)).fit(train)
    leaves = CP.rules(CP.ensemble(spark, model), CP.raw_slots(auto, feats), dialect="spark")
    hits = [F.expr(f"CASE WHEN {rule} THEN 1 ELSE 0 END") for _, rule, _, _ in leaves]
    per_row = sum(hits[1:], hits[0])
    held = part.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.bool_and(per_row == 1).alias("every_row_in_one_leaf"),
        *[F.sum(h).alias(f"leaf{i}") for i, h in enumerate(hits)],
    )
    equal = F.lit(True)
    for i, (_, _, _, n) in enumerate(leaves):
        equal = equal & (F.col(f"leaf{i}") == n)
    return held.select("n_rows", "every_row_in_one_leaf", equal.alias("leaf_counts_equal"))


@query("model_bundle", ALL_PARTS_AGREE.replace("same_raw", "same_prediction").replace(", TRUE AS same_vector", ""))
def model_bundle(spark, sf_dir):
    """A forest published as the second version of a bundle, loaded and
    checked against the table, gives the predictions it gave before."""
    from sylvan.session import scratch_path
    from sylvan.sources.bundles import load_bundle, save_bundle

    res = _part_flow(spark, sf_dir, "rf", numTrees=3)
    res.release()
    part = table(spark, sf_dir, "part")
    path = scratch_path(spark, "bundle")
    for n in (1, 2):
        save_bundle(path, res.features, res.model, part, PART_TEXT + PART_NUMERIC, save=n, split="split")
    before = SC.score(res.features, res.model, part).select("p_partkey", F.col(names.PREDICTION).alias("before"))
    after = load_bundle(spark, path).score(part).select("p_partkey", names.PREDICTION)
    return after.join(before, "p_partkey").select("p_partkey", (F.col(names.PREDICTION) == F.col("before")).alias("same_prediction"))


@query("tree_stats", None)
def tree_stats(spark, sf_dir):
    """Depth, nodes and features per tree of a 5-tree forest."""
    res = _part_flow(spark, sf_dir, "rf", numTrees=5, featureSubsetStrategy="onethird", subsamplingRate=0.5)
    res.release()
    return EX.tree_stats(spark, res.model)


@query("score_bands", None)
def score_bands(spark, sf_dir):
    """Score the unlabelled documents with the fitted stages,
    confidence band and decoded class per document."""
    res = _doc_flow(spark, sf_dir, "dt", impurity="entropy")
    res.release()
    docs = docs_with_labels(spark, sf_dir, spread=True).where(F.col("quality").isNull()).drop("quality", "toxic")
    pred = SC.score(res.features, res.model, document_features(docs))
    classes = res.auto.class_labels(res.features)
    bands = SC.prediction_bands(pred, classes)
    return bands.select("doc_id", names.PREDICTION, "predicted_class", r6("max_probability").alias("max_probability"), "confidence_level")


@query("text_lr", None)
def text_lr(spark, sf_dir):
    """Tokenizer -> HashingTF(1000) -> LR(maxIter 10, reg .001) on whole texts."""
    from sylvan.operators import target as TG

    d = labeled_docs(spark, sf_dir).select("doc_id", "text", F.col("quality").cast("double").alias("label"))
    train, test = TG.hash_split(d, "doc_id")
    model = TX.text_pipeline().fit(train)
    out = _summary(model.transform(test))
    return spark.createDataFrame(out.collect(), out.schema)


@query("classification_workflow", None)
def classification_workflow(spark, sf_dir):
    """Classification end to end: profile the labelled documents' signals, pick columns
    from the profile (text < 32 values, numeric, identifiers out), split by
    key hash, fit features on train, entropy tree, accuracy and AUC on test."""
    df = _doc_frame(spark, sf_dir).drop("toxic")  # the other label: unlabelled documents have none
    res = profile_driven_flow(df, "quality", "doc_id", "classification", "dt", 31, impurity="entropy")
    summary = _summary(res.predictions).unionByName(
        spark.createDataFrame(
            [("n_text_features", float(len(res.auto.text_cols))), ("n_numeric_features", float(len(res.auto.numeric_cols)))],
            "metric string, value double",
        )
    )
    return res.small_result(summary)


@query("regression_workflow", None)
def regression_workflow(spark, sf_dir):
    """Regression end to end: log length of all documents, the
    longest included in fit and metrics, text columns with at most 40 values
    and numeric columns picked from one profile, then DT, RF (5 trees) and
    GBT on the same split by key; RMSE/MAE/R^2 of all three in one long table."""
    docs = document_features(documents(spark, sf_dir)).withColumn("log_chars", F.log1p("n_chars")).drop("n_chars").persist()
    text, numeric = chosen_columns(docs, "log_chars", "regression", 40)
    bagged = {"featureSubsetStrategy": "onethird", "subsamplingRate": 0.5}
    runs = {
        algo: supervised_flow(docs, "log_chars", "doc_id", text, numeric, "regression", algo, 40, **params)
        for algo, params in (("dt", {}), ("rf", {"numTrees": 5, **bagged}), ("gbt", bagged))
    }
    cmp = EV.compare_models({k: r.predictions for k, r in runs.items()}, "regression")
    rows, schema = cmp.collect(), cmp.schema
    for r in runs.values():
        r.release()
    docs.unpersist()
    return spark.createDataFrame(rows, schema)
