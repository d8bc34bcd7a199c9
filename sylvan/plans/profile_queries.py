"""Profiling and column-selection queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sylvan.operators import profile as P
from sylvan.operators import profile_state as PS
from sylvan.operators import select as S
from sylvan.plans.registry import docs_with_labels, query, r6, table
from sylvan.sources.tables import read_table

DOCS_LABELS_SQL = (
    "(SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic "
    "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"
)

# Expected (column, Spark type name, strict class, extended class) per table.
DOCS_LABELS_COLUMNS = [
    ("doc_id", "LongType", "otherType", "numericType"),
    ("text", "StringType", "textType", "textType"),
    ("lang", "StringType", "textType", "textType"),
    ("source", "StringType", "textType", "textType"),
    ("n_chars", "LongType", "otherType", "numericType"),
    ("quality", "IntegerType", "numericType", "numericType"),
    ("toxic", "IntegerType", "numericType", "numericType"),
]
LINEITEM_COLUMNS = [
    ("l_orderkey", "LongType", "otherType", "numericType"),
    ("l_partkey", "LongType", "otherType", "numericType"),
    ("l_suppkey", "LongType", "otherType", "numericType"),
    ("l_linenumber", "IntegerType", "numericType", "numericType"),
    ("l_quantity", "DoubleType", "numericType", "numericType"),
    ("l_extendedprice", "DoubleType", "numericType", "numericType"),
    ("l_discount", "DoubleType", "numericType", "numericType"),
    ("l_tax", "DoubleType", "numericType", "numericType"),
    ("l_returnflag", "StringType", "textType", "textType"),
    ("l_linestatus", "StringType", "textType", "textType"),
    ("l_shipdate", "TimestampNTZType", "otherType", "temporalType"),
]
ORDERS_COLUMNS = [
    ("o_orderkey", "LongType", "otherType", "numericType"),
    ("o_custkey", "LongType", "otherType", "numericType"),
    ("o_orderstatus", "StringType", "textType", "textType"),
    ("o_totalprice", "DoubleType", "numericType", "numericType"),
    ("o_orderdate", "TimestampNTZType", "otherType", "temporalType"),
    ("o_orderpriority", "StringType", "textType", "textType"),
]


def _profile_sql(src: str, cols, extended: bool = False) -> str:
    parts = []
    for name, tname, strict, ext in cols:
        cls = ext if extended else strict
        parts.append(
            f"SELECT '{name}' AS name, '{tname}' AS origType, '{cls}' AS colType, "
            f"round(count({name})::DOUBLE / count(*), 6) AS compRatio, "
            f"(SELECT count(*) FROM (SELECT DISTINCT {name} FROM t)) AS nbDistinctValues, "
            f"count(DISTINCT {name}) AS nbDistinctNonNull FROM t"
        )
    return f"WITH t AS {src} " + " UNION ALL ".join(parts)


def _profile_out(prof):
    return prof.select(
        "name", "origType", "colType", r6("compRatio").alias("compRatio"), "nbDistinctValues", "nbDistinctNonNull"
    )


@query("profile_documents", _profile_sql(DOCS_LABELS_SQL, DOCS_LABELS_COLUMNS))
def profile_documents(spark, sf_dir):
    """A3 on documents LEFT JOIN labels (real NULLs in quality/toxic)."""
    return _profile_out(P.profile(docs_with_labels(spark, sf_dir)))


@query("profile_lineitem", _profile_sql("(SELECT * FROM lineitem)", LINEITEM_COLUMNS))
def profile_lineitem(spark, sf_dir):
    """A3 on lineitem, the reference's strict type classes."""
    return _profile_out(P.profile(table(spark, sf_dir, "lineitem")))


@query("profile_orders_extended", _profile_sql("(SELECT * FROM orders)", ORDERS_COLUMNS, extended=True))
def profile_orders_extended(spark, sf_dir):
    """A3/A4 with the extended type classes (Long numeric, timestamps temporal)."""
    return _profile_out(P.profile(table(spark, sf_dir, "orders"), mode="extended"))


def _enriched_sql(src: str, cols) -> str:
    parts = []
    for name, _t, _s, _e in cols:
        parts.append(
            f"SELECT '{name}' AS name, count(*) AS nRows, count(*) - count({name}) AS nullCount, "
            f"(SELECT count(*) FROM (SELECT DISTINCT {name} FROM t)) AS nbDistinctValues, "
            f"round((SELECT count(*) FROM (SELECT DISTINCT {name} FROM t))::DOUBLE / count(*), 6) AS uniqueRatio, "
            f"(SELECT CAST({name} AS VARCHAR) FROM t WHERE {name} IS NOT NULL GROUP BY {name} "
            f"ORDER BY count(*) DESC, {name} ASC LIMIT 1) AS mostFrequentValue, "
            f"(SELECT max(c) FROM (SELECT count(*) AS c FROM t WHERE {name} IS NOT NULL GROUP BY {name})) AS frequency "
            f"FROM t"
        )
    return f"WITH t AS {src} " + " UNION ALL ".join(parts)


@query("profile_enriched", _enriched_sql(DOCS_LABELS_SQL, DOCS_LABELS_COLUMNS))
def profile_enriched(spark, sf_dir):
    """A5: null count, unique ratio, modal non-null value and its frequency."""
    prof = P.profile(docs_with_labels(spark, sf_dir), enriched=True)
    return prof.select(
        "name",
        "nRows",
        "nullCount",
        "nbDistinctValues",
        r6("uniqueRatio").alias("uniqueRatio"),
        "mostFrequentValue",
        "frequency",
    )


@query(
    "class_distribution",
    """
    SELECT quality, count(*) AS n,
           round(count(*)::DOUBLE / sum(count(*)) OVER (), 6) AS share,
           round(max(count(*)) OVER ()::DOUBLE / min(count(*)) OVER (), 6) AS imbalance_ratio
    FROM labels GROUP BY quality
    """,
)
def class_distribution(spark, sf_dir):
    """A2: rows per class, share and majority/minority ratio."""
    d = P.class_distribution(table(spark, sf_dir, "labels"), "quality")
    return d.select("quality", "n", r6("share").alias("share"), r6("imbalance_ratio").alias("imbalance_ratio"))


@query(
    "completeness_band",
    "WITH t AS " + DOCS_LABELS_SQL + " "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS name, round(count({c})::DOUBLE / count(*), 6) AS compRatio, "
        f"CASE WHEN count({c})::DOUBLE / count(*) >= 1.0 THEN 'perfect' "
        f"WHEN count({c})::DOUBLE / count(*) >= 0.9 THEN 'very good' "
        f"WHEN count({c})::DOUBLE / count(*) >= 0.7 THEN 'average' "
        f"WHEN count({c})::DOUBLE / count(*) >= 0.5 THEN 'problematic' ELSE 'critical' END AS band FROM t"
        for c, *_ in DOCS_LABELS_COLUMNS
    ),
)
def completeness_band(spark, sf_dir):
    """Completeness band per column."""
    prof = P.profile(docs_with_labels(spark, sf_dir))
    return prof.select("name", r6("compRatio").alias("compRatio"), P.completeness_band(prof).alias("band"))


@query(
    "describe_part",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 6) AS mean, "
        f"round(stddev_samp({c}), 6) AS stddev, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max FROM part"
        for c in ("p_size", "p_retailprice")
    ),
)
def describe_part(spark, sf_dir):
    """Typed describe of part's numeric columns in one pass."""
    d = P.describe(table(spark, sf_dir, "part"), ["p_size", "p_retailprice"])
    return d.select("column", "count", r6("mean").alias("mean"), r6("stddev").alias("stddev"), "min", "max")


@query(
    "mean_text_cardinality",
    "WITH t AS " + DOCS_LABELS_SQL + " SELECT round(avg(d)::DOUBLE, 6) AS avgCardinality FROM ("
    + " UNION ALL ".join(f"SELECT (SELECT count(*) FROM (SELECT DISTINCT {c} FROM t)) AS d" for c in ("text", "lang", "source"))
    + ")",
)
def mean_text_cardinality(spark, sf_dir):
    """Mean distinct count of the text columns."""
    m = P.mean_text_cardinality(P.profile(docs_with_labels(spark, sf_dir)))
    return m.select(r6("avgCardinality").alias("avgCardinality"))


@query(
    "distinct_flags",
    "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem",
)
def distinct_flags(spark, sf_dir):
    """Distinct rows of a projection."""
    return table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus").distinct()


@query(
    "embedding_slot_distinct",
    """
    SELECT CAST(i - 1 AS INTEGER) AS slot, count(DISTINCT v) AS nbDistinctValues
    FROM (SELECT unnest(embedding) AS v, unnest(generate_series(1, len(embedding))) AS i FROM embeddings)
    GROUP BY i
    """,
)
def embedding_slot_distinct(spark, sf_dir):
    """A10: distinct values per vector slot, distributed (no driver collect)."""
    return P.slot_distinct_counts(table(spark, sf_dir, "embeddings"), "embedding")


@query(
    "embedding_summary",
    """
    SELECT CAST(i - 1 AS INTEGER) AS slot, round(avg(v::DOUBLE), 6) AS mean, round(stddev_samp(v::DOUBLE), 6) AS std
    FROM (SELECT unnest(embedding) AS v, unnest(generate_series(1, len(embedding))) AS i FROM embeddings)
    GROUP BY i
    """,
)
def embedding_summary(spark, sf_dir):
    """Mean and std per slot with Spark ML's Summarizer."""
    from pyspark.ml.functions import array_to_vector

    emb = table(spark, sf_dir, "embeddings").select(array_to_vector("embedding").alias("features"))
    s = P.vector_summary(emb, "features")
    return s.select("slot", r6("mean").alias("mean"), r6("std").alias("std"))


# ---------------------------------------------------------------- selection


ORDERS_CUSTOMER_SQL = (
    "(SELECT o.*, c.c_name, c.c_nationkey, c.c_acctbal, c.c_mktsegment "
    "FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey)"
)
ORDERS_CUSTOMER_TEXT = ["o_orderstatus", "o_orderpriority", "c_name", "c_mktsegment"]


def _orders_customer(spark, sf_dir):
    cust = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
    return table(spark, sf_dir, "orders").join(cust, "o_custkey", "left")


@query(
    "select_text_lt32",
    "WITH t AS " + ORDERS_CUSTOMER_SQL + " SELECT name, nbDistinctValues FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS name, (SELECT count(*) FROM (SELECT DISTINCT {c} FROM t)) AS nbDistinctValues"
        for c in ORDERS_CUSTOMER_TEXT
    )
    + ") WHERE nbDistinctValues < 32",
)
def select_text_lt32(spark, sf_dir):
    """Text columns with fewer than 32 distinct values."""
    prof = P.profile(_orders_customer(spark, sf_dir))
    return S.text_columns_df(prof, max_distinct=32).select("name", "nbDistinctValues")


@query(
    "select_text_le40_complete",
    "WITH t AS " + ORDERS_CUSTOMER_SQL + " SELECT name, nbDistinctValues FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS name, (SELECT count(*) FROM (SELECT DISTINCT {c} FROM t)) AS nbDistinctValues, "
        f"(SELECT count({c})::DOUBLE / count(*) FROM t) AS compRatio"
        for c in ORDERS_CUSTOMER_TEXT
    )
    + ") WHERE nbDistinctValues <= 40 AND compRatio > 0.8",
)
def select_text_le40_complete(spark, sf_dir):
    """C3 + C6: text columns with at most 40 values and completeness > .8."""
    prof = P.profile(_orders_customer(spark, sf_dir))
    return S.text_columns_df(prof, max_distinct=40, inclusive=True, min_completeness=0.8).select(
        "name", "nbDistinctValues"
    )


@query(
    "select_numeric",
    "WITH t AS " + DOCS_LABELS_SQL + " "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS name, round(count({c})::DOUBLE / count(*), 6) AS compRatio FROM t"
        for c in ("doc_id", "n_chars", "toxic")
    ),
)
def select_numeric(spark, sf_dir):
    """C4: numeric columns (extended classes) except the target ``quality``."""
    prof = P.profile(docs_with_labels(spark, sf_dir), mode="extended")
    return S.numeric_columns_df(prof, exclude=("quality",)).select("name", r6("compRatio").alias("compRatio"))


@query(
    "select_complete",
    "SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id",
)
def select_complete(spark, sf_dir):
    """Project the table on its complete columns."""
    df = docs_with_labels(spark, sf_dir)
    return S.project_complete(df, P.profile(df))


@query(
    "quality_report",
    "WITH t AS " + DOCS_LABELS_SQL + " SELECT name, round(compRatio, 6) AS compRatio, nbDistinctValues, "
    "compRatio < 0.5 AS incomplete, nbDistinctValues > 100 AS highCardinality FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS name, (SELECT count({c})::DOUBLE / count(*) FROM t) AS compRatio, "
        f"(SELECT count(*) FROM (SELECT DISTINCT {c} FROM t)) AS nbDistinctValues"
        for c, *_ in DOCS_LABELS_COLUMNS
    )
    + ") WHERE compRatio < 0.5 OR nbDistinctValues > 100",
)
def quality_report(spark, sf_dir):
    """Incomplete (< .5) or high-cardinality (> 100) columns."""
    rep = S.quality_report(P.profile(docs_with_labels(spark, sf_dir)))
    return rep.select("name", r6("compRatio").alias("compRatio"), "nbDistinctValues", "incomplete", "highCardinality")


def _identifier_sql(src: str, cols: list[tuple[str, bool]]) -> str:
    """``cols``: names, and whether the type is fractional."""
    tokens = r"regexp_split_to_array(lower(regexp_replace(name, '([\p{Ll}\d])(\p{Lu})', '\1_\2', 'g')), '[^\p{L}\d]+')"
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS name, {fractional} AS fractional, (SELECT count(*) FROM (SELECT DISTINCT {c} FROM t)) AS d, "
        f"(SELECT count(*) FROM t) AS n"
        for c, fractional in cols
    )
    return (
        f"WITH t AS {src}, p AS (SELECT *, list_has_any({tokens}, ['id', 'key']) AS named FROM ({rows})) "
        "SELECT name, round(d::DOUBLE / n, 6) AS uniqueRatio, named AS nameMatch, "
        "(named OR (d::DOUBLE / n > 0.95 AND NOT fractional)) AS isIdentifier FROM p"
    )


def _identifiers_out(df):
    ids = S.identifier_columns(P.profile(df))
    return ids.select("name", r6("uniqueRatio").alias("uniqueRatio"), "nameMatch", "isIdentifier")


@query("detect_identifiers", _identifier_sql("(SELECT * FROM orders)", [(c, c == "o_totalprice") for c, *_ in ORDERS_COLUMNS]))
def detect_identifiers(spark, sf_dir):
    """Identifier columns by name token or uniqueness over rows."""
    return _identifiers_out(table(spark, sf_dir, "orders"))


@query(
    "detect_identifiers_names",
    _identifier_sql(
        "(SELECT doc_id, source AS userKey, lang AS paid_by, n_chars AS width, doc_id AS number, doc_id / 7.0::DOUBLE AS humidity "
        "FROM documents)",
        [("doc_id", False), ("userKey", False), ("paid_by", False), ("width", False), ("number", False), ("humidity", True)],
    ),
)
def detect_identifiers_names(spark, sf_dir):
    """``id`` inside a word (width, paid, humidity) is no name token; a unique measure is no identifier."""
    d = table(spark, sf_dir, "documents")
    return _identifiers_out(
        d.select(
            "doc_id",
            F.col("source").alias("userKey"),
            F.col("lang").alias("paid_by"),
            F.col("n_chars").alias("width"),
            F.col("doc_id").alias("number"),
            (F.col("doc_id") / 7.0).alias("humidity"),
        )
    )


@query(
    "order_profile",
    _profile_sql("(SELECT * FROM lineitem)", LINEITEM_COLUMNS),
)
def order_profile(spark, sf_dir):
    """C11: profile ordered by distinct count desc, class asc (order is not compared)."""
    prof = P.profile(table(spark, sf_dir, "lineitem"))
    return _profile_out(S.order_profile(prof, by="distinct"))


@query(
    "profile_approx",
    None,
)
def profile_approx(spark, sf_dir):
    """A3 with HyperLogLog++ distinct counts: one pass, no per-column shuffle."""
    rows = read_table(spark, sf_dir, "lineitem", spread_to=spark.sparkContext.defaultParallelism)
    prof = P.profile(rows, approx=True)
    return prof.select("name", "colType", r6("compRatio").alias("compRatio"), "nbDistinctValues")


def _state_sql(column: str, number: bool) -> str:
    x = f"{column}::DOUBLE" if number else "NULL::DOUBLE"
    return (
        f"SELECT '{column}' AS name, count(*) AS n_rows, count(*) - count({column}) AS null_count, round(min({x}), 6) AS least, "
        f"round(max({x}), 6) AS greatest, round(sum({x}), 2) AS total, TRUE AS distinct_within, TRUE AS frequency_within, "
        f"TRUE AS same_in_one_slice FROM lineitem"
    )


@query("profile_states", " UNION ALL ".join(_state_sql(c, t in ("LongType", "IntegerType", "DoubleType")) for c, t, _, _ in LINEITEM_COLUMNS))
def profile_states(spark, sf_dir):
    """States of lineitem by ship year, merged: exact counts and
    moments; distinct counts and modal frequencies within their stated bounds
    of the exact profile; distinct counts as of one state of the whole table."""
    rows = table(spark, sf_dir, "lineitem")
    merged = PS.profile_from_states(PS.profile_state(rows, F.year("l_shipdate")))
    whole = PS.profile_from_states(PS.profile_state(rows)).select("name", F.col("nbDistinctNonNull").alias("whole"))
    exact = P.profile(rows, enriched=True).select("name", F.col("nbDistinctNonNull").alias("d"), F.col("frequency").alias("f"))
    return merged.join(exact, "name").join(whole, "name").select(
        "name",
        F.col("nRows").alias("n_rows"),
        F.col("nullCount").alias("null_count"),
        *[r6(c).alias(c) for c in ("least", "greatest")],
        # to cents, as the values are: a rounded mean can fall on a tie
        F.round(F.col("mean") * (F.col("n_rows") - F.col("null_count")), 2).alias("total"),
        (F.abs(F.col("nbDistinctNonNull") - F.col("d")) <= F.ceil(F.col("d") * 4 * PS.DISTINCT_ERROR)).alias("distinct_within"),
        (F.col("f") - F.col("frequency") <= F.ceil(F.col("n_rows") * PS.FREQUENCY_ERROR)).alias("frequency_within"),
        (F.col("nbDistinctNonNull") == F.col("whole")).alias("same_in_one_slice"),
    )


@query(
    "profile_mode_sketch",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS name, count(*) AS n_rows, count(*) - count({c}) AS null_count,
        (SELECT max(n) FROM (SELECT count(*) AS n FROM t WHERE {c} IS NOT NULL GROUP BY {c})) AS frequency FROM t"""
        for c in ("lang", "source", "quality", "toxic")
    ).replace("SELECT '", f"WITH t AS (SELECT * FROM {DOCS_LABELS_SQL}) SELECT '", 1),
)
def profile_mode_sketch(spark, sf_dir):
    """A5 by sketches in one scan: the modal frequency, exact for columns with few values."""
    cols = ["lang", "source", "quality", "toxic"]
    prof = P.profile(docs_with_labels(spark, sf_dir), enriched=True, approx=True, columns=cols)
    return prof.select("name", F.col("nRows").alias("n_rows"), F.col("nullCount").alias("null_count"), "frequency")


FEATURE_CONFIG_SQL = (
    "WITH t AS " + DOCS_LABELS_SQL + ", p AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS name, '{ext}' AS colType, count({c})::DOUBLE / count(*) AS compRatio, "
        f"(SELECT count(*) FROM (SELECT DISTINCT {c} FROM t)) AS d FROM t"
        for c, _t, _s, ext in DOCS_LABELS_COLUMNS
    )
    + """)
    SELECT
      (SELECT string_agg(name, ',' ORDER BY name) FROM p
        WHERE colType = 'textType' AND compRatio > 0.8 AND d <= 20 AND name != 'quality') AS text_cols,
      (SELECT string_agg(name, ',' ORDER BY name) FROM p
        WHERE colType = 'numericType' AND compRatio > 0.7 AND name != 'quality') AS numeric_cols,
      CAST(greatest(10, CAST(floor((SELECT avg(d) FROM p WHERE colType = 'textType')) AS INTEGER) * 2) AS INTEGER)
        AS max_categories,
      CAST(CASE WHEN (SELECT count(*) FROM p WHERE colType = 'textType') > 10 THEN 50 ELSE 20 END AS INTEGER)
        AS adaptive_max_categories,
      CASE WHEN (SELECT count(*) FROM p WHERE compRatio < 0.9) > 0 THEN 'skip' ELSE 'error' END AS handle_invalid
    """
)


@query("feature_config", FEATURE_CONFIG_SQL)
def feature_config(spark, sf_dir):
    """C9 + C10: pipeline settings chosen from the profile, as one row."""
    prof = P.profile(docs_with_labels(spark, sf_dir), mode="extended")
    cfg = S.config_from_profile(prof, target="quality")
    max_cat, handle = S.adaptive_settings(prof)
    return spark.createDataFrame(
        [(",".join(cfg.text_cols), ",".join(cfg.numeric_cols), cfg.max_categories, max_cat, handle)],
        "text_cols string, numeric_cols string, max_categories int, adaptive_max_categories int, handle_invalid string",
    )
