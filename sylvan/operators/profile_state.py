"""Column profiles as mergeable state.

A table that grows by slices (days, loads) is profiled slice by slice: each
slice leaves one row per column with counts, sums and three sketches -
distinct values (HyperLogLog), frequent values and quantiles (KLL). States
merge in any grouping, so a profile of all slices reads only their states,
and :func:`refresh` scans only slices that have none yet.

Bounds, for the merged profile: counts, nulls, least, greatest and sums are
exact (sums up to rounding); distinct counts have a standard error of
``DISTINCT_ERROR``; the reported most frequent value occurs at most
``FREQUENCY_ERROR`` times the rows less often than the true one, and exactly
as often as reported where a column has at most ``TRACKED`` values; ranks of
quantiles are off by at most ``RANK_ERROR`` (99 % of the time).

Text values of more than ``LONG_VALUE`` bytes stand in the sketches by their
first characters and a 128-bit digest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sylvan import names
from sylvan.functions.columns import safe_ratio

LONG_VALUE = 64
#: HyperLogLog of 2**12 registers: 1.04 / sqrt(2**12).
HLL_BITS, DISTINCT_ERROR = 12, 0.01625
#: Values tracked by the frequency sketch; its map has 4096 places, its error is 3.5 / 4096 of the rows.
TRACKED, FREQUENCY_ERROR = 2048, 3.5 / 4096
#: Size of the quantile sketch.
KLL_SIZE, RANK_ERROR = 400, 0.01

NUMBERS = (T.IntegralType, T.FloatType, T.DoubleType, T.DecimalType)


def _quoted(c: str) -> Column:
    return F.col("`" + c.replace("`", "``") + "`")


def _shown(dt: T.DataType, c: Column) -> Column:
    """The value as text, long ones by beginning and digest."""
    text = F.to_json(c) if isinstance(dt, (T.MapType, T.ArrayType, T.StructType)) else F.hex(c) if isinstance(dt, T.BinaryType) else c.cast("string")
    return F.when(F.octet_length(text) > LONG_VALUE, F.concat(F.left(text, F.lit(LONG_VALUE)), F.lit("…"), F.md5(text))).otherwise(text)


def profile_state(df: DataFrame, slice_by: str | Column | None = None, columns: list[str] | None = None) -> DataFrame:
    """One row per slice and column: ``slice, name, type, n, nulls, distinct, frequent, least, numbers``.

    One scan, aggregated map-side: a task sends one state per slice, whatever
    its rows. ``slice_by`` is a column or expression (default: one slice).
    """
    cols = list(columns or df.columns)
    key = F.lit("all") if slice_by is None else (_quoted(slice_by) if isinstance(slice_by, str) else slice_by).cast("string")
    picked = [key.alias("slice")]
    for i, c in enumerate(cols):
        dt = df.schema[c].dataType
        picked.append(_shown(dt, _quoted(c)).alias(f"v{i}"))
        if isinstance(dt, NUMBERS):
            x = _quoted(c).cast("double")
            picked.append(F.when(~F.isnan(x), x).alias(f"x{i}"))
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(cols):
        v = F.col(f"v{i}")
        aggs += [F.count(v).alias(f"nn{i}"), F.hll_sketch_agg(v, F.lit(HLL_BITS)).alias(f"d{i}"), F.expr(f"approx_top_k_accumulate(v{i}, {TRACKED})").alias(f"f{i}"), F.min(v).alias(f"l{i}")]
        if isinstance(df.schema[c].dataType, NUMBERS):
            x = F.col(f"x{i}")
            aggs += [F.kll_sketch_agg_double(x, F.lit(KLL_SIZE)).alias(f"q{i}"), F.count(x).alias(f"c{i}"), F.min(x).alias(f"a{i}"), F.max(x).alias(f"z{i}"), F.sum(x).alias(f"s{i}"), F.sum(x * x).alias(f"t{i}")]
    wide = df.select(*picked).groupBy("slice").agg(*aggs)
    none = F.lit(None).cast("struct<sketch: binary, count: bigint, least: double, greatest: double, total: double, squares: double>")
    rows = []
    for i, c in enumerate(cols):
        dt = df.schema[c].dataType
        numbers = none
        if isinstance(dt, NUMBERS):
            parts = zip(("q", "c", "a", "z", "s", "t"), ("sketch", "count", "least", "greatest", "total", "squares"))
            numbers = F.struct(*[F.col(f"{p}{i}").alias(name) for p, name in parts])
        rows.append(
            F.struct(
                F.lit(c).alias("name"), F.lit(names.type_name(dt)).alias("type"), F.col("n"), (F.col("n") - F.col(f"nn{i}")).alias("nulls"),
                F.col(f"d{i}").alias("distinct"), F.col(f"f{i}").alias("frequent"), F.col(f"l{i}").alias("least"), numbers.alias("numbers"),
            )
        )
    return wide.select("slice", F.inline(F.array(*rows)))


def merge_states(states: DataFrame) -> DataFrame:
    """One row per column from the states of any number of slices; the same form, so merged states merge again."""
    merged = states.groupBy("name", "type").agg(
        F.sum("n").alias("n"),
        F.sum("nulls").alias("nulls"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.expr(f"approx_top_k_combine(frequent, {TRACKED})").alias("frequent"),
        F.min("least").alias("least"),
        F.kll_merge_agg_double(F.when(F.col("numbers.count") > 0, F.col("numbers.sketch"))).alias("q"),
        *[f(f"numbers.{c}").alias(f"__{c}") for f, c in ((F.sum, "count"), (F.min, "least"), (F.max, "greatest"), (F.sum, "total"), (F.sum, "squares"))],
    )
    numbers = F.when(
        F.col("__count").isNotNull(),
        F.struct(F.col("q").alias("sketch"), *[F.col(f"__{c}").alias(c) for c in ("count", "least", "greatest", "total", "squares")]),
    )
    return merged.select(F.lit("merged").alias("slice"), "name", "type", "n", "nulls", "distinct", "frequent", "least", numbers.alias("numbers"))


def profile_from_states(states: DataFrame, mode: str = "strict") -> DataFrame:
    """The enriched profile, and ``least, greatest, mean, stddev, median`` of numbers, from states.

    ``mostFrequentValue`` is the first of the frequent values; where no value
    stands out by more than the sketch's error it is the least value (no
    other is more frequent by more than that error), with frequency 1.
    """
    s = merge_states(states).withColumns(
        {
            # united with itself, a sketch is estimated from its registers alone, however it came about
            "d": F.hll_sketch_estimate(F.hll_union("distinct", "distinct")),
            # NULL is a value to the frequency sketch
            "top": F.get(F.filter(F.expr("approx_top_k_estimate(frequent, 2)"), lambda x: x["item"].isNotNull()), F.lit(0)),
            "known": F.col("n") - F.col("nulls"),
            "count": F.col("numbers.count"),
        }
    )
    kinds = {T.__dict__[k]: names.classify_type(T.__dict__[k](), mode) for k in ("StringType", "IntegerType", "DoubleType", "FloatType", "LongType", "TimestampType", "TimestampNTZType", "DateType", "BooleanType")}
    kind = F.coalesce(F.create_map(*[F.lit(x) for k, v in kinds.items() for x in (k.__name__, v)])[F.col("type")], F.lit(names.OTHER))
    distinct = F.col("d") + F.when(F.col("nulls") > 0, 1).otherwise(0)
    mean = F.try_divide("numbers.total", "count")
    spread = F.col("numbers.squares") - F.col("numbers.total") * mean
    return s.select(
        "name",
        F.col("type").alias("origType"),
        kind.alias("colType"),
        safe_ratio("known", "n").alias("compRatio"),
        distinct.cast("long").alias("nbDistinctValues"),
        F.col("d").cast("long").alias("nbDistinctNonNull"),
        F.col("n").alias("nRows"),
        F.col("nulls").alias("nullCount"),
        safe_ratio(distinct, "n").alias("uniqueRatio"),
        F.when(F.col("known") > 0, F.coalesce("top.item", "least")).alias("mostFrequentValue"),
        F.when(F.col("known") > 0, F.coalesce("top.count", F.lit(1))).cast("long").alias("frequency"),
        F.col("numbers.least").alias("least"),
        F.col("numbers.greatest").alias("greatest"),
        mean.alias("mean"),
        F.sqrt(F.try_divide(F.greatest(spread, F.lit(0.0)), F.col("count") - 1)).alias("stddev"),
        F.when(F.col("count") > 0, F.kll_sketch_get_quantile_double("numbers.sketch", F.lit(0.5))).alias("median"),
    )


def saved_slices(spark: SparkSession, path: str) -> list[str]:
    """The slices that have a state below ``path``."""
    from pyspark.errors import AnalysisException

    try:
        states = spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e.getCondition()):
            return []
        raise
    return sorted(r["slice"] for r in states.select(F.col("slice").cast("string")).distinct().collect())  # one per slice


def refresh(df: DataFrame, slice_by: str | Column, path: str, columns: list[str] | None = None) -> list[str]:
    """Adds the states of slices that ``path`` lacks and returns their names; others are not read where ``df`` can
    prune by the slice. A slice is taken to be complete once it has a state."""
    spark = df.sparkSession
    done = saved_slices(spark, path)
    key = _quoted(slice_by) if isinstance(slice_by, str) else slice_by
    fresh = df.where(~key.cast("string").isin(done)) if done else df
    states = profile_state(fresh.where(key.isNotNull()), slice_by, columns or df.columns)
    states.write.mode("append").partitionBy("slice").parquet(path)
    return sorted(set(saved_slices(spark, path)) - set(done))


def load_states(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
