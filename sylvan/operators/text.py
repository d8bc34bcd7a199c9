"""Text classification (F16, F17, M24): Tokenizer -> HashingTF -> LR."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Tokenizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def text_pipeline(
    text: str = "text",
    label: str = "label",
    num_features: int = 1000,
    max_iter: int = 10,
    reg_param: float = 0.001,
) -> Pipeline:
    """Lower-case whitespace tokens, hashed term counts, logistic regression."""
    tok = Tokenizer(inputCol=text, outputCol="words")
    tf = HashingTF(inputCol="words", outputCol="features", numFeatures=num_features)
    lr = LogisticRegression(maxIter=max_iter, regParam=reg_param, labelCol=label)
    return Pipeline(stages=[tok, tf, lr])


def tokens(df: DataFrame, text: str = "text", out: str = "words") -> DataFrame:
    """Tokenizer: lower case, split on single whitespace characters (F16).

    Empty tokens between repeated spaces are kept, trailing ones dropped.
    """
    return Tokenizer(inputCol=text, outputCol=out).transform(df)


def token_counts(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, n_tokens, n_distinct_tokens) per text, over the whole text."""
    words = tokens(df.select(key, text), text, "__w")
    return words.select(
        key,
        F.size("__w").cast("long").alias("n_tokens"),
        F.size(F.array_distinct("__w")).cast("long").alias("n_distinct_tokens"),
    )
