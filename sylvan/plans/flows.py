"""End-to-end flows: classification (documents -> quality) and regression
(part -> retail price), in the order the reference runs them but with
the split first, feature stages fitted on the training part only, seeds
everywhere and the fitted stages reused for scoring.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylvan import names
from sylvan.functions.columns import letter_share, safe_ratio
from sylvan.operators import features as FT
from sylvan.operators import models as M
from sylvan.operators import target as TG
from sylvan.operators import text as TX
from sylvan.session import checkpoint_dir


@dataclass
class FlowResult:
    auto: FT.AutoPipeline
    features: PipelineModel
    model: object
    train: DataFrame
    predictions: DataFrame
    feature_names: list[str]
    cached: list[DataFrame]

    def release(self) -> None:
        """Drop the cached model input (predictions then recompute from source)."""
        for df in self.cached:
            df.unpersist()

    def small_result(self, df: DataFrame) -> DataFrame:
        """Materialise a small result (metrics, rules), then release caches."""
        rows, schema = df.collect(), df.schema
        self.release()
        return df.sparkSession.createDataFrame(rows, schema)


def document_features(docs: DataFrame) -> DataFrame:
    """Per-document signals computed over whole texts, JVM-side.

    letter share (letters / characters) and distinct-token share
    (distinct tokens / tokens) carry the quality signal of the labels.
    """
    tok = TX.tokens(docs, "text", "__w")
    return tok.select(
        "doc_id",
        "lang",
        "source",
        "n_chars",
        letter_share("text").alias("letter_share"),
        safe_ratio(F.size(F.array_distinct("__w")), F.size("__w")).alias("distinct_token_share"),
        *[c for c in docs.columns if c not in ("doc_id", "lang", "source", "n_chars", "text")],
    )


def placed(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """The rows in ``partitions`` partitions (default: ``spark.sql.shuffle.partitions``), placed and ordered by
    their hash (P11).

    Bagging draws per partition in row order, so forests and boosted trees
    would otherwise change with the input's splits. The number is a
    parameter of the result: equal for equal rows, columns and ``partitions``,
    however the input is dealt and whatever the number of cores or rows.
    ``key`` is unique, so no hash holds many rows.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    h = F.xxhash64(*[F.col(c) for c in df.columns])
    return df.repartition(n, h).sortWithinPartitions(h, key)


def needed_bins(features: PipelineModel, floor: int = 32, skip_cols: tuple[str, ...] = ()) -> int:
    """maxBins large enough for every categorical feature.

    Two sources of categorical features: slots the VectorIndexer made
    categorical, and text columns whose StringIndexer nominal attribute
    survives assembly even when the VectorIndexer leaves the slot alone.
    ``keep`` adds one category. The result is exact, never capped.
    """
    from pyspark.ml.feature import StringIndexerModel, VectorIndexerModel

    widest = 0
    for stage in features.stages:
        if isinstance(stage, VectorIndexerModel):
            widest = max([widest] + [len(m) + 1 for m in stage.categoryMaps.values()])
        elif isinstance(stage, StringIndexerModel):
            outs = stage.getOutputCols() if stage.isSet("outputCols") else [stage.getOutputCol()]
            extra = 1 if stage.getHandleInvalid() == "keep" else 0
            for out, labels in zip(outs, stage.labelsArray):
                if out not in skip_cols:
                    widest = max(widest, len(labels) + extra)
    return max(floor, widest)


def supervised_flow(
    df: DataFrame,
    target: str,
    key: str,
    text_cols: list[str],
    numeric_cols: list[str],
    kind: str = "classification",
    algo: str = "dt",
    max_categories: int = 32,
    handle_invalid: str = "keep",
    seed: int = M.DEFAULT_SEED,
    train_fraction: float = 0.7,
    partitions: int | None = None,
    rebalance: str | None = None,
    **params,
) -> FlowResult:
    """Split by key hash, fit features on train, fit a model, predict test.

    The model's input is placed by row hash over ``partitions`` (see :func:`placed`).
    ``rebalance`` evens the classes of the model's input (T2): ``weights``
    weighs each class alike, ``undersample`` cuts each to the size of the
    smallest. Feature stages are fitted on all training rows either way; a
    tree needs at least as many rows as its widest feature has categories.

    The shared checkpoint folder is set on the context (if the cluster has
    not already), so iterative fits such as GBT checkpoint their state every
    ``checkpointInterval`` rounds instead of growing one long lineage.
    """
    if rebalance not in (None, "weights", "undersample") or (rebalance and kind != "classification"):
        raise ValueError(f"cannot rebalance {kind} by {rebalance!r}")
    checkpoint_dir(df.sparkSession)
    # Only the model's columns are kept and cached: the derived features
    # (regexes over whole texts, tokens) are then computed once, not once
    # per fit, encode and metric pass.
    cols = list(dict.fromkeys([key, target] + list(text_cols) + list(numeric_cols)))
    base = placed(df.select(*cols).where(F.col(target).isNotNull()), key, partitions).persist(StorageLevel.MEMORY_AND_DISK)
    train, test = TG.hash_split(base, key, (train_fraction, 1.0 - train_fraction))
    auto = FT.auto_pipeline(text_cols, numeric_cols, target, kind, max_categories, handle_invalid)
    feats = auto.pipeline.fit(train)
    fitted_on = train
    if rebalance == "undersample":
        fitted_on = placed(TG.undersample_exact(train, target, key), key, partitions)
    enc_train = FT.encode(feats, fitted_on, auto)
    if rebalance == "weights":
        enc_train = TG.with_class_weights(enc_train, names.LABEL)
        params["weightCol"] = "weight"
    enc_train = enc_train.persist(StorageLevel.MEMORY_AND_DISK)
    skip = (auto.indexed_target,) if auto.indexed_target else ()
    params["maxBins"] = needed_bins(feats, params.get("maxBins", 32), skip)
    if algo == "lr":
        params.pop("maxBins")
    model = M.make_model(algo, kind, seed=seed, **params).fit(enc_train)
    scored = feats.transform(test)
    label = F.col(auto.indexed_target) if kind == "classification" else F.col(target).cast("double")
    pred = model.transform(scored.withColumn(names.LABEL, label))
    names_ = FT.feature_names(feats.transform(train.limit(1)), names.FEATURES)
    return FlowResult(auto, feats, model, enc_train, pred, names_, [base, enc_train])


def chosen_columns(
    df: DataFrame, target: str, kind: str, max_categories: int, mode: str = "strict", min_completeness: float = 0.8
) -> tuple[list[str], list[str]]:
    """Text and numeric feature columns by the profile of ``df``: identifiers out (C8), text columns with at most
    ``max_categories`` values and numeric columns, both complete enough, target excluded (C2-C6, F26)."""
    from sylvan.operators import profile as P
    from sylvan.operators import select as S

    found = P.profile(df, mode=mode)
    rows = found.collect()  # one row per column: computed once, not once per list taken from it
    prof = df.sparkSession.createDataFrame(rows, found.schema)
    ids = [r["name"] for r in S.identifier_columns(prof).where("isIdentifier").select("name").collect()]
    auto = FT.auto_pipeline_from_profile(
        prof, target, kind, min_completeness, max_categories, exclude=tuple(c for c in ids if c != target)
    )
    return auto.text_cols, auto.numeric_cols


def profile_driven_flow(
    df: DataFrame,
    target: str,
    key: str,
    kind: str,
    algo: str,
    max_categories: int,
    mode: str = "strict",
    min_completeness: float = 0.8,
    **params,
) -> FlowResult:
    """The reference's end-to-end flow, profile first.

    profile -> drop identifier columns (C8) -> text columns with at most
    ``max_categories`` values and numeric columns, both complete enough,
    target excluded (C2-C6, F26) -> key-hash split -> feature stages fitted
    on the training part -> model -> predictions on the test part.
    """
    # The profile and the model input both read the (derived) table: cache
    # it once so derived columns (regexes over texts, tokens) are computed once.
    data = df.persist(StorageLevel.MEMORY_AND_DISK)
    text_cols, numeric_cols = chosen_columns(data, target, kind, max_categories, mode, min_completeness)
    res = supervised_flow(data, target, key, text_cols, numeric_cols, kind, algo, max_categories, **params)
    res.cached.append(data)
    return res
