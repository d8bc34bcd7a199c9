"""Feature transformers and the automatic feature pipeline (F1-F32).

Every transformer is a Spark ML stage; the helpers here wire them
together (``auto_pipeline``), turn their fitted state into DataFrames
(label maps, category maps, feature dictionaries) and check their
outputs with SQL expressions (one-hot validity, vector sizes) instead of
per-row UDFs.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    PCA,
    IndexToString,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
    VectorIndexer,
    VectorIndexerModel,
    VectorSlicer,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sylvan import names
from sylvan.functions.columns import array_sum
from sylvan.operators.impute import FillMissing

HANDLE_INVALID = ("error", "skip", "keep")


def string_indexer(
    input_cols: list[str],
    output_cols: list[str] | None = None,
    handle_invalid: str = "error",
    order: str = "frequencyDesc",
) -> StringIndexer:
    """Multi-column StringIndexer (F1-F4): one pass over all columns.

    ``frequencyDesc`` gives index 0 to the most frequent value, ties broken
    by ascending string value. ``keep`` sends NULL and unseen values to an
    extra index n, ``skip`` drops those rows, ``error`` fails.
    """
    if handle_invalid not in HANDLE_INVALID:
        raise ValueError(f"handle_invalid must be one of {HANDLE_INVALID}")
    outs = output_cols or [names.PREFIX + c for c in input_cols]
    return StringIndexer(
        inputCols=list(input_cols), outputCols=outs, handleInvalid=handle_invalid, stringOrderType=order
    )


def label_maps(model: StringIndexerModel, input_cols: list[str]) -> list[tuple[str, str, float]]:
    """(column, value, index) triples of a fitted indexer (F30); model-sized."""
    out = []
    for col, labels in zip(input_cols, model.labelsArray):
        out += [(col, v, float(i)) for i, v in enumerate(labels)]
    return out


def label_maps_df(spark: SparkSession, model: StringIndexerModel, input_cols: list[str]) -> DataFrame:
    schema = "column string, value string, index double"
    return spark.createDataFrame(label_maps(model, input_cols), schema)


def decode(df: DataFrame, col: str, labels: list[str], out: str) -> DataFrame:
    """Index back to string with explicit labels."""
    return IndexToString(inputCol=col, outputCol=out, labels=list(labels)).transform(df)


def one_hot(df: DataFrame, cols: list[str], outs: list[str], drop_last: bool = False) -> DataFrame:
    """OneHotEncoder over index columns (F7); dropLast=False keeps all slots."""
    enc = OneHotEncoder(inputCols=cols, outputCols=outs, dropLast=drop_last)
    return enc.fit(df).transform(df)


def assemble(df: DataFrame, cols: list[str], out: str = names.FEATURES_VEC, handle_invalid: str = "error") -> DataFrame:
    """Concatenate numeric and vector columns in order."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid=handle_invalid).transform(df)


def vector_indexer(
    input_col: str = names.FEATURES_VEC,
    output_col: str = names.FEATURES,
    max_categories: int = 20,
    handle_invalid: str = "error",
) -> VectorIndexer:
    """Slots with at most ``max_categories`` values become categorical."""
    return VectorIndexer(
        inputCol=input_col, outputCol=output_col, maxCategories=max_categories, handleInvalid=handle_invalid
    )


def category_maps(model: VectorIndexerModel) -> list[tuple[int, float, int]]:
    """(slot, value, index) of a fitted VectorIndexer (F10); model-sized."""
    out = []
    for slot, m in sorted(model.categoryMaps.items()):
        out += [(int(slot), float(v), int(i)) for v, i in sorted(m.items(), key=lambda kv: kv[1])]
    return out


def category_maps_df(spark: SparkSession, model: VectorIndexerModel) -> DataFrame:
    return spark.createDataFrame(category_maps(model), "slot int, value double, index int")


def slot_kinds(model: VectorIndexerModel) -> dict[str, int]:
    """Number of categorical and continuous slots (F32)."""
    n_cat = len(model.categoryMaps)
    return {"categorical": n_cat, "continuous": model.numFeatures - n_cat}


def vector_column(col: str) -> F.Column:
    """ML vector as a SQL array."""
    return vector_to_array(F.col(col))


def one_hot_valid(df: DataFrame, col: str) -> DataFrame:
    """Rows whose one-hot vector does not sum to exactly 1, counted (F8)."""
    s = array_sum(vector_to_array(F.col(col)))
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(s == 1.0, 1).otherwise(0)).cast("long").alias("n_valid"),
        F.sum(F.when(s != 1.0, 1).otherwise(0)).cast("long").alias("n_invalid"),
    )


def vector_sizes(df: DataFrame, col: str) -> DataFrame:
    """Min and max vector size over the rows."""
    size = F.size(vector_to_array(F.col(col)))
    return df.agg(F.min(size).alias("min_size"), F.max(size).alias("max_size"))


def scaler(input_col: str, output_col: str, with_mean: bool = False, with_std: bool = True) -> StandardScaler:
    """StandardScaler (F19); place it on the numeric sub-vector only."""
    return StandardScaler(inputCol=input_col, outputCol=output_col, withMean=with_mean, withStd=with_std)


def pca(input_col: str, output_col: str, k: int) -> PCA:
    """PCA to k components."""
    return PCA(k=k, inputCol=input_col, outputCol=output_col)


def slicer(input_col: str, output_col: str, indices: list[int]) -> VectorSlicer:
    """Select vector slots by index."""
    return VectorSlicer(inputCol=input_col, outputCol=output_col, indices=list(indices))


def array_column_to_vector(df: DataFrame, col: str, out: str) -> DataFrame:
    return df.withColumn(out, array_to_vector(F.col(col)))


@dataclass
class AutoPipeline:
    """An unfitted feature pipeline plus what it will produce."""

    pipeline: Pipeline
    kind: str
    text_cols: list[str]
    numeric_cols: list[str]
    target: str | None
    assembled: list[str] = field(default_factory=list)

    @property
    def indexed_target(self) -> str | None:
        if self.kind == "classification" and self.target:
            return names.PREFIX + self.target
        return None

    def text_indexer(self, fitted: PipelineModel) -> StringIndexerModel | None:
        """The fitted indexer of the text columns, if any."""
        return fitted_indexer(fitted, names.PREFIX + self.text_cols[0]) if self.text_cols else None

    def class_labels(self, fitted: PipelineModel) -> list[str] | None:
        """Target value of each class index (classification)."""
        if not self.indexed_target:
            return None
        return list(fitted_indexer(fitted, self.indexed_target).labelsArray[0])

    def feature_dictionary(self) -> list[tuple[int, str]]:
        """Ordinal -> input column (before one-hot expansion)."""
        return list(enumerate(self.assembled))


def fitted_indexer(fitted: PipelineModel, output_col: str) -> StringIndexerModel:
    """The fitted StringIndexer stage that writes ``output_col``."""
    for stage in fitted.stages:
        if isinstance(stage, StringIndexerModel):
            outs = stage.getOutputCols() if stage.isSet("outputCols") else [stage.getOutputCol()]
            if output_col in outs:
                return stage
    raise KeyError(output_col)


def auto_pipeline(
    text_cols: list[str],
    numeric_cols: list[str],
    target: str | None = None,
    kind: str = "classification",
    max_categories: int = 32,
    handle_invalid: str = "error",
    one_hot_text: bool = False,
    scale_numeric: bool = False,
    target_invalid: str = "error",
    impute: str | None = None,
) -> AutoPipeline:
    """Index text (+ target), assemble, vector-index.

    Classification also indexes the target (``indexed_<target>``,
    frequency order) with its own indexer (``target_invalid``, default
    ``error``: drop rows without a target before fitting); regression
    leaves it alone.
    The target is removed from both lists by exact name. With
    ``one_hot_text`` the indexed text columns are one-hot encoded; with
    ``scale_numeric`` only the numeric columns are scaled before the final
    assembly, so category codes are never scaled. ``impute`` (mean, median
    or mode) fills missing numbers, and text with its most frequent value,
    from what the training rows held.
    """
    if kind not in ("classification", "regression"):
        raise ValueError("kind must be 'classification' or 'regression'")
    if handle_invalid not in HANDLE_INVALID:
        raise ValueError(f"handle_invalid must be one of {HANDLE_INVALID}")
    text = [c for c in text_cols if c != target]
    numeric = [c for c in numeric_cols if c != target]
    if kind == "classification" and not target:
        raise ValueError("classification needs a target")
    stages = []
    if impute:
        stages.append(FillMissing(numericCols=numeric, textCols=text, strategy=impute))
    if text:
        stages.append(string_indexer(text, handle_invalid=handle_invalid))
    if kind == "classification":
        # The target gets its own indexer: ``keep`` must never invent an
        # extra class. With ``error`` a fitted target indexer also passes
        # through rows that have no target column at all (scoring).
        stages.append(string_indexer([target], handle_invalid=target_invalid))
    text_features = [names.PREFIX + c for c in text]
    if one_hot_text and text_features:
        hot = [f"onehot_{c}" for c in text]
        stages.append(OneHotEncoder(inputCols=text_features, outputCols=hot, dropLast=False))
        text_features = hot
    numeric_features = list(numeric)
    if scale_numeric and numeric:
        stages.append(VectorAssembler(inputCols=numeric, outputCol="numericVec", handleInvalid=handle_invalid))
        stages.append(StandardScaler(inputCol="numericVec", outputCol="numericScaled", withMean=False, withStd=True))
        numeric_features = ["numericScaled"]
    assembled = text_features + numeric_features
    if not assembled:
        raise ValueError("no feature columns")
    stages.append(VectorAssembler(inputCols=assembled, outputCol=names.FEATURES_VEC, handleInvalid=handle_invalid))
    stages.append(vector_indexer(max_categories=max_categories, handle_invalid=handle_invalid))
    return AutoPipeline(Pipeline(stages=stages), kind, text, numeric, target, assembled)


def auto_pipeline_from_profile(
    prof: DataFrame,
    target: str,
    kind: str = "classification",
    min_completeness: float = 0.8,
    max_categories: int = 20,
    handle_invalid: str = "keep",
    exclude: tuple[str, ...] = (),
) -> AutoPipeline:
    """AutoPipeline whose columns are chosen from a profile.

    Text columns: completeness >= ``min_completeness`` and at most
    ``max_categories`` distinct non-NULL values (so every text column fits
    the tree's bins); numeric columns: completeness >= ``min_completeness``.
    The target and ``exclude`` (e.g. identifier columns) are left out by
    exact name. Lists are bounded by the schema width.
    """
    keep_out = [target, *exclude]
    base = prof.where(~F.col("name").isin(keep_out) & (F.col("compRatio") >= min_completeness))
    text = sorted(
        r["name"]
        for r in base.where((F.col("colType") == names.TEXT) & (F.col("nbDistinctNonNull") <= max_categories))
        .select("name")
        .collect()
    )
    numeric = sorted(r["name"] for r in base.where(F.col("colType") == names.NUMERIC).select("name").collect())
    return auto_pipeline(text, numeric, target, kind, max_categories, handle_invalid)


def encode(model: PipelineModel, df: DataFrame, auto: AutoPipeline) -> DataFrame:
    """Transform and keep ``features`` and ``label`` only."""
    out = model.transform(df)
    if auto.kind == "classification":
        label = F.col(auto.indexed_target)
    else:
        label = F.col(auto.target).cast("double")
    return out.select(F.col(names.FEATURES), label.alias(names.LABEL))


def feature_names(df: DataFrame, vec_col: str) -> list[str]:
    """Slot names of a vector column from its ML attribute metadata.

    One-hot expansions appear as ``<column>_<value>``; bounded by the
    vector size.
    """
    meta = df.schema[vec_col].metadata.get("ml_attr", {})
    attrs = meta.get("attrs", {})
    slots = {}
    for group in attrs.values():
        for a in group:
            slots[a["idx"]] = a.get("name", f"feature {a['idx']}")
    size = meta.get("num_attrs", len(slots))
    return [slots.get(i, f"feature {i}") for i in range(size)]


def check_categories(
    prof: DataFrame, text_cols: list[str], max_bins: int, handle_invalid: str = "error"
) -> list[str]:
    """Text columns whose category count would exceed ``max_bins``.

    ``keep`` adds one category. Fitting a tree with such a column fails in
    Spark; checking the profile first gives a clear message instead.
    """
    extra = 1 if handle_invalid == "keep" else 0
    rows = (
        prof.where(F.col("name").isin(list(text_cols)))
        .select("name", (F.col("nbDistinctNonNull") + extra).alias("k"))
        .collect()
    )
    return sorted(r["name"] for r in rows if r["k"] > max_bins)


def dry_run(auto: AutoPipeline, df: DataFrame, n_fit: int = 100, n_check: int = 10) -> dict:
    """Fit on the first rows and check the outputs exist."""
    sample = df.limit(n_fit)
    model = auto.pipeline.fit(sample)
    out = model.transform(sample.limit(n_check))
    expected = [names.FEATURES] + ([auto.indexed_target] if auto.indexed_target else [])
    missing = [c for c in expected if c not in out.columns]
    return {"ok": not missing, "missing": missing, "rows": out.count()}


def to_double_vector_schema(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, T.ArrayType)
