"""Column-name constants and column type classes.

Fixed values (must equal the reference's for the same outputs):
    label column            "label"
    indexed-column prefix   "indexed_"
    assembled vector        "featuresVec"
    indexed vector          "features"
    type classes            "textType", "numericType", "otherType"
    extended type classes   "temporalType", "booleanType"
"""

from __future__ import annotations

from pyspark.sql import types as T

LABEL = "label"
PREFIX = "indexed_"
FEATURES_VEC = "featuresVec"
FEATURES = "features"

TEXT = "textType"
NUMERIC = "numericType"
OTHER = "otherType"
TEMPORAL = "temporalType"
BOOLEAN = "booleanType"

PREDICTION = "prediction"
PROBABILITY = "probability"
RAW_PREDICTION = "rawPrediction"

_STRICT = {
    T.StringType: TEXT,
    T.IntegerType: NUMERIC,
    T.DoubleType: NUMERIC,
}

_EXTENDED = {
    T.StringType: TEXT,
    T.IntegerType: NUMERIC,
    T.DoubleType: NUMERIC,
    T.FloatType: NUMERIC,
    T.LongType: NUMERIC,
    T.TimestampType: TEMPORAL,
    T.TimestampNTZType: TEMPORAL,
    T.DateType: TEMPORAL,
    T.BooleanType: BOOLEAN,
}


def type_name(dt: T.DataType) -> str:
    """Scala-style type name, e.g. ``StringType`` (not ``string``)."""
    return type(dt).__name__


def classify_type(dt: T.DataType, mode: str = "strict") -> str:
    """Type class of a column.

    ``strict`` follows the reference code: only String, Integer and Double
    are text/numeric, everything else (Long included) is ``otherType``.
    ``extended`` also counts Float/Long as numeric and adds temporal and
    boolean classes.
    """
    table = _STRICT if mode == "strict" else _EXTENDED
    if mode not in ("strict", "extended"):
        raise ValueError(f"mode must be 'strict' or 'extended', got {mode!r}")
    return table.get(type(dt), OTHER)
