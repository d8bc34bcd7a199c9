"""Column profiling.

The reference profiles a table with a driver loop of 1 + 2*C jobs (one
count, then a filtered count and a ``distinct().count()`` per column).
Here the whole profile is one lazy query: for every column a
``groupBy(column).count()`` (partial aggregation map-side, so a value
holding a third of all rows collapses to one row per task before the
shuffle); the per-value counts of all columns are unioned and reduced by
a single ``groupBy(column index)``. Each branch reads only its own
column, and there is one final shuffle instead of one single-partition
aggregate per column.

``approx=True`` replaces the C shuffles by one pass with HyperLogLog++
(``approx_count_distinct``), the right choice on very large tables; with
``enriched`` the modal value comes from a sketch as well.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sylvan import names
from sylvan.functions.columns import safe_ratio

PROFILE_COLUMNS = ["name", "origType", "colType", "compRatio", "nbDistinctValues", "nbDistinctNonNull", "nRows"]
ENRICHED_COLUMNS = PROFILE_COLUMNS + ["nullCount", "uniqueRatio", "mostFrequentValue", "frequency"]

# Plans with more branches than this are evaluated chunk by chunk.
MAX_BRANCHES_PER_PLAN = 64

# Text values of more bytes than this are grouped by a 128-bit digest and their first characters.
LONG_VALUE = 64


def _ident(c: str) -> str:
    """A column name as a quoted SQL identifier."""
    return "`" + c.replace("`", "``") + "`"


def _groupable(df: DataFrame, c: str) -> Column:
    """The column as a grouping key (maps cannot be grouped; use their JSON)."""
    dt = df.schema[c].dataType
    col = F.col(_ident(c))
    if isinstance(dt, T.MapType):
        return F.to_json(col)
    return col


def _key_sql(dt: T.DataType, c: str) -> str:
    """SQL of the grouping key of column c."""
    return f"to_json({_ident(c)})" if isinstance(dt, T.MapType) else _ident(c)


def _order_keys_sql(dt: T.DataType) -> tuple[str, str, str]:
    """Order-preserving (long, double, string) key of ``v``, by type family.

    Only one of the three is set for a given column, so comparing the
    struct compares values of that column in their natural order (used to
    break ties of the modal value towards the smallest value).
    """
    nl, nd, ns = "CAST(NULL AS BIGINT)", "CAST(NULL AS DOUBLE)", "CAST(NULL AS STRING)"
    if isinstance(dt, (T.IntegralType, T.BooleanType)):
        return "CAST(v AS BIGINT)", nd, ns
    if isinstance(dt, (T.FloatType, T.DoubleType, T.DecimalType)):
        return nl, "CAST(v AS DOUBLE)", ns
    if isinstance(dt, T.DateType):
        return "unix_date(v)", nd, ns
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return "unix_micros(CAST(v AS TIMESTAMP))", nd, ns
    if isinstance(dt, T.StringType):
        return nl, nd, "v"
    if isinstance(dt, T.BinaryType):
        return nl, nd, "hex(v)"
    if isinstance(dt, T.MapType):
        return nl, nd, "v"
    return nl, nd, "CAST(v AS STRING)"


def _counts_sql(df: DataFrame, view: str, cols: list[str], enriched: bool) -> str:
    """SQL: per column, (idx, nul, cnt[, value, order keys]) per distinct value,
    all columns unioned, reduced by one GROUP BY idx.

    ``GROUP BY v`` aggregates partially before the shuffle, so a value that
    holds a third of all rows is one row per task when it is shuffled. One
    placeholder row per column (cnt 0) keeps every column in the result
    when the table is empty, without an extra job to test for it.
    """
    branches = []
    for i, c in enumerate(cols):
        dt = df.schema[c].dataType
        source, keys, extra = f"SELECT {_key_sql(dt, c)} AS v FROM {view}", "v", ""
        if isinstance(dt, (T.StringType, T.MapType)):
            # long texts never leave the scan: their digest and first characters are the key
            long = f"octet_length(v) > {LONG_VALUE}"
            start = f", left(v, {LONG_VALUE}) AS start" if enriched else ""
            source = f"SELECT {long} AS long, CASE WHEN {long} THEN md5(v) ELSE v END AS v{start} FROM ({source})"
            keys = "long, v, start" if enriched else "long, v"
            if enriched:
                extra = ", CASE WHEN NOT long THEN v END AS value, CAST(NULL AS BIGINT) AS kl, CAST(NULL AS DOUBLE) AS kd, start AS ks, long"
        elif enriched:
            kl, kd, ks = _order_keys_sql(dt)
            extra = f", CAST(v AS STRING) AS value, {kl} AS kl, {kd} AS kd, {ks} AS ks, FALSE AS long"
        branches.append(f"SELECT {i} AS idx, v IS NULL AS nul, count(1) AS cnt{extra} FROM ({source}) GROUP BY {keys}")
    seed_extra = (
        ", CAST(NULL AS STRING) AS value, CAST(NULL AS BIGINT) AS kl, CAST(NULL AS DOUBLE) AS kd, "
        "CAST(NULL AS STRING) AS ks, CAST(NULL AS BOOLEAN) AS long"
        if enriched
        else ""
    )
    values = ", ".join(f"({i})" for i in range(len(cols)))
    branches.append(
        f"SELECT idx, CAST(NULL AS BOOLEAN) AS nul, CAST(0 AS BIGINT) AS cnt{seed_extra} FROM VALUES {values} AS s(idx)"
    )
    aggs = (
        "sum(cnt) AS n, sum(CASE WHEN NOT nul THEN cnt END) AS nn, "
        "sum(CASE WHEN cnt > 0 THEN 1 ELSE 0 END) AS d, sum(CASE WHEN cnt > 0 AND NOT nul THEN 1 ELSE 0 END) AS dnn"
    )
    if enriched:
        # modal non-null value: highest count, ties -> smallest value
        aggs += (
            ", min_by(struct(value, long, ks), CASE WHEN NOT nul THEN struct(-cnt, kl, kd, ks, long) END) AS mode"
            ", max(CASE WHEN NOT nul THEN cnt END) AS freq"
        )
    return f"SELECT idx, {aggs} FROM ({' UNION ALL '.join(branches)}) GROUP BY idx"


def _from_counts(df: DataFrame, cols: list[str], mode: str, enriched: bool) -> DataFrame:
    """Union the per-value counts of all columns, then one groupBy(idx).

    The C branches are written as one SQL statement over a temporary view
    of ``df``: the plan is then analysed once instead of once per
    DataFrame call (building it through the API cost about a second of
    driver time for 11 columns). The view is dropped right away; the
    DataFrame keeps the resolved plan.
    """
    spark = df.sparkSession
    view = f"sylvan_profile_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(view)
    try:
        g = spark.sql(_counts_sql(df, view, cols, enriched))
    finally:
        spark.catalog.dropTempView(view)
    dts = [df.schema[c].dataType for c in cols]
    if enriched:
        g = _with_modes(df, cols, g)

    def pick(values):
        return F.get(F.array(*[F.lit(x) for x in values]), F.col("idx"))

    n = F.coalesce(F.col("n"), F.lit(0)).cast("long")
    out = [
        pick(cols).alias("name"),
        pick([names.type_name(dt) for dt in dts]).alias("origType"),
        pick([names.classify_type(dt, mode) for dt in dts]).alias("colType"),
        safe_ratio(F.coalesce(F.col("nn"), F.lit(0)), n).alias("compRatio"),
        F.col("d").cast("long").alias("nbDistinctValues"),
        F.col("dnn").cast("long").alias("nbDistinctNonNull"),
        n.alias("nRows"),
    ]
    if enriched:
        out += [
            (n - F.coalesce(F.col("nn"), F.lit(0))).cast("long").alias("nullCount"),
            safe_ratio("d", n).alias("uniqueRatio"),
            F.col("mode").alias("mostFrequentValue"),
            F.col("freq").cast("long").alias("frequency"),
        ]
    return g.select(*out)


def _with_modes(df: DataFrame, cols: list[str], counts: DataFrame) -> DataFrame:
    """The counts with the modal value as text; where it is a long one it is fetched now, by its first characters.

    One row per column is read back. A long modal value is the least of
    those with its frequency: only rows that begin as it does are read again,
    and one value of each digest is compared.
    """
    spark = df.sparkSession
    rows = [r.asDict() for r in counts.select("idx", "n", "nn", "d", "dnn", "mode.value", "mode.long", "mode.ks", "freq").collect()]
    wanted = [r for r in rows if r["long"]]
    parts = []
    for r in wanted:
        v = _groupable(df, cols[r["idx"]])
        begins = df.select(v.alias("v")).where((F.octet_length("v") > LONG_VALUE) & (F.left("v", F.lit(LONG_VALUE)) == F.lit(r["ks"])))
        same = begins.groupBy(F.md5("v")).agg(F.min("v").alias("v"), F.count(F.lit(1)).alias("c")).where(F.col("c") == r["freq"])
        parts.append(same.agg(F.lit(r["idx"]).alias("idx"), F.min("v").alias("v")))
    if parts:
        found = {r["idx"]: r["v"] for r in reduce(DataFrame.unionAll, parts).collect()}
        for r in wanted:
            r["value"] = found[r["idx"]]
    schema = "idx int, n long, nn long, d long, dnn long, mode string, freq long"
    return spark.createDataFrame([(r["idx"], r["n"], r["nn"], r["d"], r["dnn"], r["value"], r["freq"]) for r in rows], schema)


def _approx(df: DataFrame, cols: list[str], mode: str, rsd: float) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, c in enumerate(cols):
        col = _groupable(df, c)
        aggs += [F.count(col).alias(f"nn{i}"), F.approx_count_distinct(col, rsd).alias(f"d{i}")]
    wide = df.agg(*aggs)
    rows = []
    for i, c in enumerate(cols):
        dt = df.schema[c].dataType
        nn, d, n = F.col(f"nn{i}"), F.col(f"d{i}"), F.col("__n")
        has_null = F.when(nn < n, F.lit(1)).otherwise(F.lit(0))
        fields = [
            F.lit(c).alias("name"),
            F.lit(names.type_name(dt)).alias("origType"),
            F.lit(names.classify_type(dt, mode)).alias("colType"),
            safe_ratio(nn, n).alias("compRatio"),
            (d + has_null).cast("long").alias("nbDistinctValues"),
            d.cast("long").alias("nbDistinctNonNull"),
            n.cast("long").alias("nRows"),
        ]
        rows.append(F.struct(*fields))
    return wide.select(F.inline(F.array(*rows)))


def _approx_enriched(df: DataFrame, cols: list[str], mode: str) -> DataFrame:
    """With the most frequent value from a sketch (its bounds: ``profile_state``), one scan; none of an empty table."""
    from sylvan.operators import profile_state as PS

    return PS.profile_from_states(PS.profile_state(df, None, cols), mode).select(*ENRICHED_COLUMNS)


def profile(
    df: DataFrame,
    mode: str = "strict",
    enriched: bool = False,
    approx: bool = False,
    rsd: float = 0.05,
    columns: list[str] | None = None,
) -> DataFrame:
    """One row per column: name, origType, colType, compRatio, distinct counts (A3).

    ``nbDistinctValues`` counts NULL as one value, as the reference's
    ``select(c).distinct().count`` does; ``nbDistinctNonNull`` does not.
    ``compRatio`` is NULL on an empty table; ``nRows`` is the row count.
    ``enriched=True`` adds null count, unique ratio and the modal non-null
    value with its frequency (A5), and runs when called. Long texts are
    counted by a 128-bit digest, so what is shuffled does not grow with their
    length. Row order of the result is not defined.
    """
    cols = list(columns or df.columns)
    if approx:
        # One aggregate per chunk of columns keeps generated code small on
        # very wide tables; each chunk scans only its own columns.
        chunks = [cols[i : i + MAX_BRANCHES_PER_PLAN] for i in range(0, len(cols), MAX_BRANCHES_PER_PLAN)]
        parts = [_approx(df, c, mode, rsd) if not enriched else _approx_enriched(df, c, mode) for c in chunks]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionAll(part)
        return out
    if len(cols) <= MAX_BRANCHES_PER_PLAN:
        prof = _from_counts(df, cols, mode, enriched)
    else:
        # Very wide table: evaluate bounded plans one by one; each result is
        # one row per column, bounded by the schema, not by the data.
        rows = []
        for i in range(0, len(cols), MAX_BRANCHES_PER_PLAN):
            rows += _from_counts(df, cols[i : i + MAX_BRANCHES_PER_PLAN], mode, enriched).collect()
        prof = df.sparkSession.createDataFrame(rows, _from_counts(df, cols[:1], mode, enriched).schema)
    return prof


def class_distribution(df: DataFrame, target: str) -> DataFrame:
    """Rows per class with share and majority/minority ratio (A2).

    The totals are one aggregated row read back as literals, so no window
    ever pulls all classes into one task, however many there are.
    """
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    tot = counts.agg(F.sum("n").alias("t"), F.max("n").alias("hi"), F.min("n").alias("lo")).first()
    return counts.select(
        target,
        "n",
        safe_ratio(F.col("n"), F.lit(tot["t"])).alias("share"),
        safe_ratio(F.lit(tot["hi"]), F.lit(tot["lo"])).alias("imbalance_ratio"),
    )


# Completeness bands (lower bound, label), checked top-down.
COMPLETENESS_BANDS = [
    (1.0, "perfect"),
    (0.9, "very good"),
    (0.7, "average"),
    (0.5, "problematic"),
]
BELOW_BANDS = "critical"


def completeness_band(prof: DataFrame, col: str = "compRatio") -> Column:
    """Band label for a completeness ratio."""
    expr = None
    for bound, label in COMPLETENESS_BANDS:
        cond = F.col(col) >= F.lit(bound)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(BELOW_BANDS)


def mean_text_cardinality(prof: DataFrame) -> DataFrame:
    """Average distinct count of the text columns."""
    return prof.where(F.col("colType") == names.TEXT).agg(
        F.avg(F.col("nbDistinctValues").cast("double")).alias("avgCardinality")
    )


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """count, mean, stddev, min, max per numeric column, typed.

    One pass with partial aggregation; the C result rows are produced by
    ``inline`` from a single aggregated row.
    """
    structs = []
    for c in cols:
        x = F.col(c).cast("double")
        structs.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count(x).alias("count"),
                F.avg(x).alias("mean"),
                F.stddev_samp(x).alias("stddev"),
                F.min(x).alias("min"),
                F.max(x).alias("max"),
            )
        )
    return df.agg(F.array(*structs).alias("s")).select(F.inline("s"))


def vector_summary(df: DataFrame, vec: str = names.FEATURES) -> DataFrame:
    """Mean and sample standard deviation per vector slot."""
    s = df.select(Summarizer.metrics("mean", "std").summary(F.col(vec)).alias("s"))
    return s.select(
        F.posexplode(
            F.arrays_zip(vector_to_array(F.col("s.mean")).alias("mean"), vector_to_array(F.col("s.std")).alias("std"))
        ).alias("slot", "z")
    ).select("slot", F.col("z.mean").alias("mean"), F.col("z.std").alias("std"))


def slot_distinct_counts(df: DataFrame, vec: str) -> DataFrame:
    """Distinct values per vector (or array) slot (A10), fully distributed."""
    dt = df.schema[vec].dataType
    arr = F.col(vec) if isinstance(dt, T.ArrayType) else vector_to_array(F.col(vec))
    return (
        df.select(F.posexplode(arr).alias("slot", "value"))
        .groupBy("slot")
        .agg(F.count_distinct("value").alias("nbDistinctValues"))
    )
