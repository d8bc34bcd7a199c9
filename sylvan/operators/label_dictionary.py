"""Label dictionaries as tables: StringIndexer's numbering without the driver.

``StringIndexer`` brings every distinct label to the driver. Here a
dictionary is a table (column, value, n, index) of any number of labels:

1. the values of all columns are counted in one aggregation, combined
   map-side (a label that holds a third of all rows is a row per task);
2. the counts are range-partitioned by (column, count descending, value), so
   every partition is a contiguous bucket of the numbering, and written:
   a row's place in its bucket is fixed from then on;
3. an index is the place plus the number of labels in earlier buckets of the
   column, a prefix sum over at most (partitions + columns) rows.

Encoding joins the dictionary back. Labels with at least a thousandth of
the rows are at most a thousand a column and are broadcast; rows that these
settle, and rows with a NULL, get salted keys that match nothing, so no key
of the shuffle is hot and no row is scanned twice.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sylvan import names
from sylvan.operators.features import HANDLE_INVALID
from sylvan.session import scratch_path

#: A label is hot with at least 1/HOT_SHARE of the rows, and at least HOT_ROWS of them.
HOT_SHARE = 1000
HOT_ROWS = 10_000
SALTS = 4096


def _quoted(c: str) -> Column:
    return F.col("`" + c.replace("`", "``") + "`")


def _java_order(value: Column) -> Column:
    """Strings in Java's order, which StringIndexer breaks ties by (UTF-16, not UTF-8)."""
    return F.encode(value, "UTF-16BE")


def _written(df: DataFrame, kind: str) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, kind)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def label_dictionary(df: DataFrame, cols: list[str], buckets: int | None = None) -> DataFrame:
    """``column, value, n, index`` for every non-NULL value of ``cols`` (cast to text), numbered by frequency.

    The most frequent value has index 0, ties go by value; the same numbers
    as ``StringIndexer(frequencyDesc)``. ``buckets`` is the number of ranges
    (default: the shuffle partitions); it does not change the numbers.
    """
    if not cols:
        raise ValueError("no columns")
    spark = df.sparkSession
    values = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), _quoted(c).cast("string").alias("value")) for c in cols])).alias("v")
    counts = df.select(values).select("v.*").where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    order = [F.col("column"), F.col("n").desc(), _java_order(F.col("value"))]
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the id holds the partition in its upper 31 bits and the place in it in the lower 33
    placed = _written(counts.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id()), "labels")
    bucket = F.shiftright("__id", 33).cast("int")
    ranges = placed.groupBy("column", bucket.alias("__bucket")).agg(F.count(F.lit(1)).alias("__labels"), F.min("__id").alias("__first"))
    earlier = Window.partitionBy("column").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select(
        F.col("column"), F.col("__bucket"), (F.coalesce(F.sum("__labels").over(earlier), F.lit(0)) - F.col("__first")).alias("__shift")
    )
    # at most (buckets + columns) rows: a bucket is a range, so columns share few of them
    numbered = placed.withColumn("__bucket", bucket).join(F.broadcast(offsets), ["column", "__bucket"])
    return numbered.select("column", "value", "n", (F.col("__id") + F.col("__shift")).cast("double").alias("index"))


def encode_labels(
    df: DataFrame, dictionary: DataFrame, cols: list[str], outs: list[str] | None = None, handle_invalid: str = "error"
) -> DataFrame:
    """``df`` with the index of each column's value, by join with a dictionary of :func:`label_dictionary`.

    ``keep`` sends NULL and unknown values to one index after the last,
    ``skip`` drops their rows, ``error`` fails on them when the rows are read.
    """
    if handle_invalid not in HANDLE_INVALID:
        raise ValueError(f"handle_invalid must be one of {HANDLE_INVALID}")
    outs = outs or [names.PREFIX + c for c in cols]
    sizes = {r["column"]: (r["labels"], r["rows"]) for r in dictionary.groupBy("column").agg(F.count(F.lit(1)).alias("labels"), F.sum("n").alias("rows")).collect()}
    salt = F.pmod(F.xxhash64(*[_quoted(c) for c in df.columns]), F.lit(SALTS)).cast("int") + 1
    for c, out in zip(cols, outs):
        labels, rows = sizes.get(c, (0, 0))
        least = max(rows // HOT_SHARE, HOT_ROWS)
        own = dictionary.where(F.col("column") == c)
        hot = own.where(F.col("n") >= least).select(F.col("value").alias("__hot"), F.col("index").alias("__hot_index"))  # at most HOT_SHARE rows
        cold = own.where(F.col("n") < least).select(F.col("value").alias("__cold"), F.col("index").alias("__cold_index"), F.lit(0).alias("__cold_salt"))
        marked = df.withColumn("__value", _quoted(c).cast("string")).join(F.broadcast(hot), F.col("__value") == F.col("__hot"), "left")
        settled = F.col("__hot").isNotNull() | F.col("__value").isNull()
        marked = marked.withColumns({"__salt": F.when(settled, salt).otherwise(0), "__key": F.when(settled, F.lit("")).otherwise(F.col("__value"))})
        joined = marked.join(cold, (F.col("__key") == F.col("__cold")) & (F.col("__salt") == F.col("__cold_salt")), "left")
        index = F.coalesce("__hot_index", "__cold_index")
        if handle_invalid == "keep":
            index = F.coalesce(index, F.lit(float(labels)))
        elif handle_invalid == "error":
            index = F.when(index.isNull(), F.raise_error(F.concat(F.lit(f"unknown label in {c}: "), F.coalesce("__value", F.lit("NULL"))))).otherwise(index)
        df = joined.withColumn(out, index).drop("__value", "__hot", "__hot_index", "__salt", "__key", "__cold", "__cold_index", "__cold_salt")
    if handle_invalid == "skip":
        df = df.where(reduce(lambda a, b: a & b, [_quoted(o).isNotNull() for o in outs]))
    return df


def decode_labels(df: DataFrame, dictionary: DataFrame, col: str, column: str, out: str) -> DataFrame:
    """The value behind an index column (F5), by join; NULL for an index that no value has."""
    own = dictionary.where(F.col("column") == column).select(F.col("index").alias("__index"), F.col("value").alias(out))
    return df.join(own, _quoted(col) == F.col("__index"), "left").drop("__index")
