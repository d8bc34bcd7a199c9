"""Helpers shared by the operators: scratch tables, hot-key joins, bounded samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sylvan.session import scratch_path

#: Characters that count as white space in every contract here: space, \t, \n, \v, \f, \r.
SPACE = " \t\n\x0b\x0c\r"
#: One word: a run of anything else (Java, RE2 and Python read it alike).
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: A key with at least 1/HOT_SHARE of all rows is hot; there are at most HOT_SHARE such keys.
HOT_SHARE = 1000

#: Bytes of one Arrow batch. A task holds one on either side of the worker, with buffers grown by doubling.
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound Arrow batches of the session by ``BATCH_BYTES``, since records of long texts make batches as large as
    Spark's own bound (64 MB) lets them. A session that sets its own bound keeps it."""
    bound = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.set(bound, spark.conf.get(bound, str(BATCH_BYTES)))


def written(df: DataFrame, kind: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back.

    Cuts lineage (a lost executor never reruns what led here) and freezes
    ids made by ``monotonically_increasing_id``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{kind}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def col(name: str) -> Column:
    """The column of exactly this name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_row(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct, so that added columns cannot clash."""
    return F.struct(*[col(c) for c in df.columns])


def unpack(df: DataFrame, row: str = "_row", **changed: Column) -> DataFrame:
    """The columns kept by :func:`whole_row`, with ``changed`` ones replaced."""
    fields = df.schema[row].dataType.names
    name = lambda f: f.replace("`", "``")
    return df.select(*[(changed[f] if f in changed else F.col(f"{row}.`{name(f)}`")).alias(f) for f in fields])


def join_counted(big: DataFrame, small: DataFrame, keys: list[str], n: str, total: int, how: str = "inner") -> DataFrame:
    """Join ``big`` with ``small`` (unique ``keys``; ``n`` = rows of ``big`` per key), hot keys apart.

    Keys with at least 1/1000 of the ``total`` rows of ``big`` number at
    most 1000, so those rows of ``small`` are broadcast whatever the input
    size; all other keys are too small to skew a shuffle join. ``how`` is
    inner only: with a left join the rows would come twice.
    """
    if how != "inner":
        raise ValueError("only inner joins")
    hot = F.col(n) >= F.lit(max(total // HOT_SHARE, 100_000))
    return big.join(F.broadcast(small.filter(hot)), keys).unionByName(big.join(small.filter(~hot), keys))


def bounded_sample(df: DataFrame, group: str, per_group: int, id_col: str) -> DataFrame:
    """At most ``per_group`` rows of each group, those with the smallest hash of ``id_col``.

    The group sizes come from a scan of two columns; a hash fraction of
    about twice the need passes on, so the window sees a bounded set. The
    same rows whatever the partitioning. Rows with a null group are left
    out.
    """
    spark = df.sparkSession
    sizes = df.filter(col(group).isNotNull()).groupBy(col(group).alias("_g")).count()
    share = sizes.select("_g", (F.lit(2.0 * per_group + 20) / F.col("count")).alias("_p"))
    h = F.xxhash64(col(id_col).cast("string"), F.lit("sample"))
    frac = F.shiftrightunsigned(h, 11) / F.lit(float(1 << 53))
    cols = df.columns
    w = Window.partitionBy(col(group)).orderBy("_h", col(id_col))
    return (
        df.withColumn("_h", h)
        .join(F.broadcast(share) if spark.conf.get("spark.sql.autoBroadcastJoinThreshold") != "-1" else share, col(group) == F.col("_g"))
        .filter(frac < F.col("_p"))
        .withColumn("_n", F.row_number().over(w))
        .filter(F.col("_n") <= per_group)
        .select(*[col(c) for c in cols])
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
