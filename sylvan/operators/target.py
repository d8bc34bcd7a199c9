"""Target handling, sampling and splitting.

Every random step takes a seed. The default split is by key hash: it
depends only on the key, so it does not change when the input is read
with a different partitioning (a seeded ``randomSplit`` does).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sylvan.functions.columns import hash_fraction


def randomize_target(df: DataFrame, target: str, seed: int) -> DataFrame:
    """Replace the target by a fair coin flip, as last column.

    This is what the reference calls rebalancing; it destroys the target
    and is kept only as a null-model baseline.
    """
    flip = F.when(F.rand(seed) > 0.5, F.lit(0)).otherwise(F.lit(1))
    return df.drop(target).withColumn(target, flip)


def with_split(
    df: DataFrame,
    key: str,
    fractions: tuple[float, ...] = (0.7, 0.3),
    labels: tuple[str, ...] = ("train", "test"),
    col: str = "split",
) -> DataFrame:
    """Add a split label from the key hash (T3, default split)."""
    if len(fractions) != len(labels):
        raise ValueError("one label per fraction")
    total = float(sum(fractions))
    h = hash_fraction(key, "split")
    edge = 0.0
    expr = None
    for frac, label in zip(fractions[:-1], labels[:-1]):
        edge += frac / total
        expr = F.when(h < edge, label) if expr is None else expr.when(h < edge, label)
    expr = F.lit(labels[-1]) if expr is None else expr.otherwise(labels[-1])
    return df.withColumn(col, expr)


def hash_split(
    df: DataFrame, key: str, fractions: tuple[float, ...] = (0.7, 0.3)
) -> list[DataFrame]:
    """Split into disjoint, complete parts by key hash (T3); rows with a NULL key are in one of them."""
    total = float(sum(fractions))
    h = hash_fraction(key, "split")
    out, lo = [], 0.0
    for i, frac in enumerate(fractions):
        hi = lo + frac / total
        cond = (h >= lo) & (h < hi) if i < len(fractions) - 1 else (h >= lo)
        out.append(df.where(cond))
        lo = hi
    return out


def random_split(df: DataFrame, weights: tuple[float, ...] = (0.7, 0.3), seed: int = 42) -> list[DataFrame]:
    """Seeded ``randomSplit`` (T3, the reference's method, now seeded)."""
    return df.randomSplit(list(weights), seed=seed)


def _with_class_size(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """``df`` with the rows of its class as ``_class_n`` (NULL without a class), and the table of classes.

    Any number of classes: the class table is joined, and the optimizer
    broadcasts it only where its size in bytes allows.
    """
    classes = df.where(F.col(target).isNotNull()).groupBy(F.col(target).alias("_class")).agg(F.count(F.lit(1)).alias("_class_n"))
    return df.join(classes, F.col(target) == F.col("_class"), "left").drop("_class"), classes


def undersample(df: DataFrame, target: str, key: str) -> DataFrame:
    """True rebalancing by undersampling.

    Every class keeps about as many rows as the smallest class: a row of
    class c is kept when its key hash is below min_count / count(c). The
    choice depends only on the key, so it is reproducible and SQL-checkable,
    and it is independent of the split and the folds. Rows without a class
    are dropped.
    """
    sized, classes = _with_class_size(df, target)
    smallest = classes.agg(F.min("_class_n")).first()[0]
    return sized.where(hash_fraction(key, "undersample") < F.lit(smallest).cast("double") / F.col("_class_n")).drop("_class_n")


def _edges(rows: DataFrame, wanted: DataFrame, bits: int) -> DataFrame:
    """Per class, the bucket of ``rows`` (``_class, _bucket``) in which its ``_need``-th row lies, and how many of
    that bucket's rows are needed. A class has at most 2**bits buckets to add up."""
    sizes = rows.groupBy("_class", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy("_class").orderBy("_bucket"))
    sums = sizes.withColumn("_upto", upto).join(wanted, "_class")
    edge = sums.where((F.col("_upto") >= F.col("_need")) & (F.col("_upto") - F.col("_n") < F.col("_need")))
    return edge.select("_class", F.col("_bucket").alias("_edge"), (F.col("_need") - F.col("_upto") + F.col("_n")).alias("_need"))


def undersample_exact(df: DataFrame, target: str, key: str) -> DataFrame:
    """Every class with exactly as many rows as the smallest (T2): those with the least hash of ``key`` (ties: least key).

    No sort: a histogram of the hash's upper 16 bits finds the bucket in
    which a class's last row lies, a second one the next 16 bits of that
    bucket, and only the rows left at the border, a 2**32nd of a class, are
    ranked. Rows without a class are dropped.
    """
    text = F.concat(F.lit("undersample:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")  # 60 bits
    rows = df.where(F.col(target).isNotNull()).withColumns({"_class": F.col(target), "_h": h})
    classes = rows.groupBy("_class").agg(F.count(F.lit(1)).alias("_n"))
    smallest = classes.agg(F.min("_n")).first()[0]
    if smallest is None:
        return df.limit(0)
    upper, lower = F.shiftright("_h", 44), F.shiftright("_h", 28)
    first = _edges(rows.select("_class", upper.alias("_bucket")), classes.select("_class", F.lit(smallest).alias("_need")), 16)
    border = rows.select("_class", "_h").join(first.drop("_need"), "_class").where(upper == F.col("_edge")).select("_class", lower.alias("_bucket"))
    edges = _edges(border, first.select("_class", "_need"), 16)
    joined = rows.join(edges, "_class")
    rank = F.row_number().over(Window.partitionBy("_class").orderBy("_h", key))
    last = joined.where(lower == F.col("_edge")).withColumn("_rank", rank).where(F.col("_rank") <= F.col("_need"))
    return joined.where(lower < F.col("_edge")).select(*df.columns).unionByName(last.select(*df.columns))


def stratified_sample(df: DataFrame, target: str, fractions: dict, seed: int = 42) -> DataFrame:
    """Random stratified sample per class (``sampleBy``), seeded."""
    return df.sampleBy(target, fractions, seed)


def with_class_weights(df: DataFrame, target: str, col: str = "weight") -> DataFrame:
    """Add balanced class weights n / (k * n_c) as a weight column (T2); NULL without a class."""
    sized, classes = _with_class_size(df, target)
    total, k = classes.agg(F.sum("_class_n"), F.count(F.lit(1))).first()
    return sized.withColumn(col, F.lit(total).cast("double") / (F.lit(k) * F.col("_class_n"))).drop("_class_n")


def head(df: DataFrame, n: int) -> DataFrame:
    """First ``n`` rows (T4); a limit is the feature here (dry runs)."""
    return df.limit(n)
