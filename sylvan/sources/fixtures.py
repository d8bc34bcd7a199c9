"""In-memory tables (S2-S4) used by the examples and tests.

These are the small literal tables of the teaching material; they are
not registered as driver queries (those read the given tables).

Fixed values (rows of the teaching fixtures, in source order).
"""

from __future__ import annotations

from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# buys_computer rows (age, income, student, credit_rating, buys_computer)
BUYS_COMPUTER = [
    ("young", "high", "no", "fair", "no"),
    ("young", "high", "no", "excellent", "no"),
    ("middle", "high", "no", "fair", "yes"),
    ("senior", "medium", "no", "fair", "yes"),
    ("senior", "low", "yes", "fair", "yes"),
    ("senior", "low", "yes", "excellent", "no"),
    ("middle", "low", "yes", "excellent", "yes"),
    ("young", "medium", "no", "fair", "no"),
    ("young", "low", "yes", "fair", "yes"),
    ("senior", "medium", "yes", "fair", "yes"),
    ("young", "medium", "yes", "excellent", "yes"),
    ("middle", "medium", "no", "excellent", "yes"),
    ("middle", "high", "yes", "fair", "yes"),
    ("senior", "medium", "no", "excellent", "no"),
]

# Golf rows (outlook, temp, humidity, windy, hours)
GOLF = [
    ("rainy", "hot", "high", "FALSE", 25.0),
    ("rainy", "hot", "high", "TRUE", 30.0),
    ("overcast", "hot", "high", "FALSE", 46.0),
    ("sunny", "mild", "high", "FALSE", 45.0),
    ("sunny", "cool", "normal", "FALSE", 52.0),
    ("sunny", "cool", "normal", "TRUE", 23.0),
    ("overcast", "cool", "normal", "TRUE", 43.0),
    ("rainy", "mild", "high", "FALSE", 35.0),
    ("rainy", "cool", "normal", "FALSE", 38.0),
    ("sunny", "mild", "normal", "FALSE", 46.0),
    ("rainy", "mild", "normal", "TRUE", 48.0),
    ("overcast", "mild", "high", "TRUE", 52.0),
    ("overcast", "hot", "normal", "FALSE", 44.0),
    ("sunny", "mild", "high", "TRUE", 30.0),
]

# Text training and scoring rows
TEXT_TRAIN = [
    (0, "a b c d e spark", 1.0),
    (1, "b d", 0.0),
    (2, "spark f g h", 1.0),
    (3, "hadoop mapreduce", 0.0),
]
TEXT_SCORE = [(4, "spark i j k"), (5, "l m n"), (6, "spark hadoop spark"), (7, "apache hadoop")]

BUYS_COMPUTER_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("age", "income", "student", "credit_rating", "buys_computer")]
)
GOLF_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("outlook", "temp", "humidity", "windy")]
    + [T.StructField("hours", T.DoubleType())]
)


def buys_computer(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(BUYS_COMPUTER, BUYS_COMPUTER_SCHEMA)


def golf(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(GOLF, GOLF_SCHEMA)


def scoring_rows(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [("young", "high", "no", "fair"), ("senior", "high", "yes", "excellent")],
        ["age", "income", "student", "credit_rating"],
    )


def text_train(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TEXT_TRAIN, ["id", "text", "label"])


def text_score(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TEXT_SCORE, ["id", "text"])


def vector_samples(spark: SparkSession, sparse: bool = False) -> DataFrame:
    """Dense vectors, optionally with the last two rows sparse."""
    rows = [
        Vectors.dense([1.0, 1.0, 18.0]),
        Vectors.dense([0.0, 2.0, 20.0]),
        Vectors.dense([1.0, 0.0, 18.0]),
        Vectors.dense([2.0, 3.0, 11.0]),
    ]
    if sparse:
        rows[2] = Vectors.sparse(3, {0: 1.0, 2: 18.0})
        rows[3] = Vectors.sparse(3, {0: 2.0, 1: 3.0, 2: 11.0})
    return spark.createDataFrame([(v,) for v in rows], ["features"])
