"""Model factory (M1-M7): Spark ML estimators with a seed and checked bins.

Tree induction itself is Spark ML's: per-level histogram aggregation over
the cached training rows, so its cost grows with rows x features x bins
per level, and the model lives on the driver.
"""

from __future__ import annotations

from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor

from sylvan import names

DEFAULT_SEED = 42

_ESTIMATORS = {
    ("dt", "classification"): DecisionTreeClassifier,
    ("dt", "regression"): DecisionTreeRegressor,
    ("rf", "classification"): RandomForestClassifier,
    ("rf", "regression"): RandomForestRegressor,
    ("gbt", "classification"): GBTClassifier,
    ("gbt", "regression"): GBTRegressor,
    ("lr", "classification"): LogisticRegression,
}

_SEEDED = {"dt", "rf", "gbt"}


def make_model(
    algo: str,
    kind: str = "classification",
    seed: int = DEFAULT_SEED,
    features: str = names.FEATURES,
    label: str = names.LABEL,
    **params,
):
    """An estimator by short name: dt / rf / gbt / lr.

    Reference settings: DT classifier entropy with maxBins = maxCat (M2);
    DT regressor maxBins 40 (M3); RF 3 or 5 trees, ``onethird``,
    subsamplingRate .5 (M4); GBT ``onethird``, .5 (M5); RF classifier 10
    trees (M6); LR maxIter 10, regParam .001 (M7).
    """
    cls = _ESTIMATORS.get((algo, kind))
    if cls is None:
        raise ValueError(f"unknown model {algo!r} for {kind!r}")
    kwargs = dict(featuresCol=features, labelCol=label, **params)
    if algo in _SEEDED:
        kwargs["seed"] = seed
    return cls(**kwargs)


def check_max_bins(max_bins: int, category_counts: dict[str, int], handle_invalid: str = "error") -> None:
    """Fail early when a categorical feature has more values than maxBins."""
    extra = 1 if handle_invalid == "keep" else 0
    bad = {c: k + extra for c, k in category_counts.items() if k + extra > max_bins}
    if bad:
        raise ValueError(f"maxBins={max_bins} is below the category count of {bad}")
