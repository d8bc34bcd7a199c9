"""Cleaning, derivation, target and split queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sylvan.operators import derive as D
from sylvan.operators import score as SC
from sylvan.operators import target as TG
from sylvan.operators.tune import with_folds
from sylvan.plans.registry import docs_with_labels, query, r6, table

# SQL form of the key-hash fraction in sylvan.functions.columns.hash_fraction.
HASH_SQL = "(('0x' || substr(md5('{p}:' || coalesce({k}::VARCHAR, '')), 1, 8))::BIGINT::DOUBLE / 4294967296::DOUBLE)"


@query(
    "date_parts",
    """
    SELECT o_orderkey,
           CAST(day(o_orderdate) AS INTEGER) AS dayofmonth,
           CAST(month(o_orderdate) AS INTEGER) AS month,
           CAST(2000 + year(o_orderdate) % 100 AS INTEGER) AS year
    FROM orders
    """,
)
def date_parts(spark, sf_dir):
    """parse a ``dd/MM/yy`` string into day, month, year.

    The string is the order date written as ``dd/MM/yy`` (the loan data's
    format). Spark's ``yy`` maps two-digit years to 2000-2099, so 95 is
    2095; the oracle states that rule.
    """
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "dd/MM/yy").alias("Lead_Creation_Date")
    )
    return D.with_date_parts(o, "Lead_Creation_Date", fmt="dd/MM/yy")


@query(
    "date_parts_default",
    """
    SELECT l_orderkey, l_linenumber,
           CAST(day(l_shipdate) AS INTEGER) AS dayofmonthSD,
           CAST(month(l_shipdate) AS INTEGER) AS monthSD,
           CAST(year(l_shipdate) AS INTEGER) AS yearSD
    FROM lineitem
    """,
)
def date_parts_default(spark, sf_dir):
    """default date pattern, suffixed outputs, source dropped."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("string").alias("shipped")
    )
    return D.with_date_parts(li, "shipped", suffix="SD")


@query(
    "prefix_int",
    "SELECT doc_id, TRY_CAST(split_part(source, 'src', 2) AS INTEGER) AS source_num FROM documents",
)
def prefix_int(spark, sf_dir):
    """``src7 -> 7`` (the reference strips an ``S`` prefix)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source")
    return D.with_prefix_int(d, "source", out="source_num", sep="src").select("doc_id", "source_num")


@query(
    "bucketize_year",
    """
    SELECT CAST(greatest(least(floor((year(o_orderdate) - 1911) / 10), 10), 0) AS DOUBLE) AS bucket, count(*) AS n
    FROM orders GROUP BY 1
    """,
)
def bucketize_year(spark, sf_dir):
    """decade buckets 1911..2021 (open ends), rows per bucket."""
    o = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"))
    b = D.bucketize(o, "year", "bucket", D.decade_splits())
    return b.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))


@query(
    "range_filter",
    """
    SELECT l_orderkey, l_linenumber FROM lineitem
    WHERE year(l_shipdate) BETWEEN 1995 AND 1999 AND l_extendedprice > 100 AND l_extendedprice <= 17500
    """,
)
def range_filter(spark, sf_dir):
    """T5: range filters as outlier removal (year window, price band)."""
    li = D.year_range_filter(table(spark, sf_dir, "lineitem"), "l_shipdate", 1995, 1999)
    li = D.range_filter(li, "l_extendedprice", 100, 17500, low_inclusive=False)
    return li.select("l_orderkey", "l_linenumber")


@query(
    "sql_filter",
    """
    SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
    WHERE l_quantity BETWEEN 10 AND 20 AND l_returnflag != 'N' AND l_discount <= 0.05
    """,
)
def sql_filter(spark, sf_dir):
    """Filter by SQL text (pushed to the parquet scan)."""
    li = D.where_sql(
        table(spark, sf_dir, "lineitem"), "l_quantity between 10 and 20 and l_returnflag != 'N' and l_discount <= 0.05"
    )
    return li.select("l_orderkey", "l_linenumber", "l_quantity")


def _impute_sql(fill: str) -> str:
    return f"""
    WITH t AS (SELECT d.doc_id, l.quality::DOUBLE AS quality, l.toxic::DOUBLE AS toxic
               FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
    SELECT doc_id,
           round(coalesce(quality, (SELECT {fill.format(c='quality')} FROM t)), 6) AS quality,
           round(coalesce(toxic, (SELECT {fill.format(c='toxic')} FROM t)), 6) AS toxic
    FROM t
    """


def _impute(spark, sf_dir, strategy):
    df = docs_with_labels(spark, sf_dir).select("doc_id", "quality", "toxic")
    out, _ = D.impute(df, ["quality", "toxic"], strategy=strategy)
    return out.select("doc_id", r6("quality").alias("quality"), r6("toxic").alias("toxic"))


@query("impute_mean", _impute_sql("avg({c})"))
def impute_mean(spark, sf_dir):
    """mean imputation of NULLs (labels missing for most documents)."""
    return _impute(spark, sf_dir, "mean")


@query("impute_median", _impute_sql("quantile_disc({c}, 0.5)"))
def impute_median(spark, sf_dir):
    """median imputation (Spark: lower middle value)."""
    return _impute(spark, sf_dir, "median")


@query("impute_mode", _impute_sql("mode({c})"))
def impute_mode(spark, sf_dir):
    """mode imputation."""
    return _impute(spark, sf_dir, "mode")


@query(
    "impute_text_mode",
    """
    WITH t AS (SELECT d.doc_id, CASE WHEN l.quality = 0 THEN d.lang END AS lang_if_low
               FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
    m AS (SELECT lang_if_low AS v FROM t WHERE lang_if_low IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
    SELECT doc_id, coalesce(lang_if_low, (SELECT v FROM m)) AS lang_if_low FROM t
    """,
)
def impute_text_mode(spark, sf_dir):
    """F22 for text: fill NULLs with the modal value (ties: smallest)."""
    df = docs_with_labels(spark, sf_dir).select(
        "doc_id", F.when(F.col("quality") == 0, F.col("lang")).alias("lang_if_low")
    )
    return D.impute_text_mode(df, ["lang_if_low"])


@query(
    "hash_split",
    f"""
    SELECT o_orderkey, CASE WHEN {HASH_SQL.format(p='split', k='o_orderkey')} < 0.7 THEN 'train' ELSE 'test' END AS split
    FROM orders
    """,
)
def hash_split(spark, sf_dir):
    """70/30 split by key hash; disjoint, complete, partitioning-stable."""
    return TG.with_split(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")


@query(
    "hash_split_counts",
    f"""
    SELECT CASE WHEN {HASH_SQL.format(p='split', k='o_orderkey')} < 0.7 THEN 'train' ELSE 'test' END AS split, count(*) AS n
    FROM orders GROUP BY 1
    """,
)
def hash_split_counts(spark, sf_dir):
    """Sizes of the two parts produced by ``hash_split``."""
    train, test = TG.hash_split(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")
    return train.agg(F.count(F.lit(1)).alias("n")).select(F.lit("train").alias("split"), "n").unionByName(
        test.agg(F.count(F.lit(1)).alias("n")).select(F.lit("test").alias("split"), "n")
    )


@query(
    "undersample",
    f"""
    WITH c AS (SELECT quality, count(*) AS n FROM labels GROUP BY 1)
    SELECT l.doc_id, l.quality FROM labels l JOIN c ON l.quality = c.quality
    WHERE {HASH_SQL.format(p='undersample', k='l.doc_id')} < (SELECT min(n) FROM c)::DOUBLE / c.n
    """,
)
def undersample(spark, sf_dir):
    """Undersample every class to the smallest one, by key hash."""
    return TG.undersample(table(spark, sf_dir, "labels"), "quality", "doc_id").select("doc_id", "quality")


@query(
    "undersample_then_split",
    f"""
    WITH c AS (SELECT quality, count(*) AS n FROM labels GROUP BY 1)
    SELECT l.quality, CASE WHEN {HASH_SQL.format(p='split', k='l.doc_id')} < 0.7 THEN 'train' ELSE 'test' END AS split,
           count(*) AS n
    FROM labels l JOIN c ON l.quality = c.quality
    WHERE {HASH_SQL.format(p='undersample', k='l.doc_id')} < (SELECT min(n) FROM c)::DOUBLE / c.n
    GROUP BY ALL
    """,
)
def undersample_then_split(spark, sf_dir):
    """T2 and T3 together: classes per part after undersampling; either choice has a hash of its own."""
    kept = TG.undersample(table(spark, sf_dir, "labels"), "quality", "doc_id")
    return TG.with_split(kept, "doc_id").groupBy("quality", "split").agg(F.count(F.lit(1)).alias("n"))


@query(
    "folds_on_train",
    f"""
    SELECT least(floor({HASH_SQL.format(p='fold', k='o_orderkey')} * 5), 4)::INTEGER AS fold, count(*) AS n
    FROM orders WHERE {HASH_SQL.format(p='split', k='o_orderkey')} < 0.7 GROUP BY ALL
    """,
)
def folds_on_train(spark, sf_dir):
    """T3 and M14 together: fold sizes inside the train part."""
    train, _ = TG.hash_split(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")
    return with_folds(train, "o_orderkey", 5).groupBy("fold").agg(F.count(F.lit(1)).alias("n"))


@query(
    "split_null_keys",
    f"""
    SELECT CASE WHEN {HASH_SQL.format(p='split', k='l.quality')} < 0.7 THEN 'train' ELSE 'test' END AS split, count(*) AS n
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY ALL
    """,
)
def split_null_keys(spark, sf_dir):
    """T3 on a key with NULLs: the parts add up to all rows."""
    parts = TG.hash_split(docs_with_labels(spark, sf_dir).select("quality"), "quality")
    counted = [p.select(F.lit(n).alias("split")) for n, p in zip(("train", "test"), parts)]
    return counted[0].unionByName(counted[1]).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query(
    "class_weights",
    """
    WITH c AS (SELECT quality, count(*) AS n FROM labels GROUP BY 1)
    SELECT l.doc_id, l.quality,
           round((SELECT sum(n) FROM c)::DOUBLE / ((SELECT count(*) FROM c) * c.n), 6) AS weight
    FROM labels l JOIN c ON l.quality = c.quality
    """,
)
def class_weights(spark, sf_dir):
    """Balanced class weights n / (k * n_c) as a weight column."""
    w = TG.with_class_weights(table(spark, sf_dir, "labels"), "quality")
    return w.select("doc_id", "quality", r6("weight").alias("weight"))


@query("randomize_target", None)
def randomize_target(spark, sf_dir):
    """The reference's coin-flip target (a null-model baseline), seeded."""
    lab = TG.randomize_target(table(spark, sf_dir, "labels"), "quality", seed=7)
    return lab.groupBy("quality").agg(F.count(F.lit(1)).alias("n"))


@query("random_split", None)
def random_split(spark, sf_dir):
    """The reference's random 70/30 split, now seeded."""
    train, test = TG.random_split(table(spark, sf_dir, "orders").select("o_orderkey"), (0.7, 0.3), seed=42)
    return train.select(F.lit("train").alias("split"), "o_orderkey").unionByName(
        test.select(F.lit("test").alias("split"), "o_orderkey")
    )


@query(
    "lookup_enrich",
    """
    SELECT o.o_orderkey, c.c_mktsegment, n.n_name
    FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
    LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
    """,
)
def lookup_enrich(spark, sf_dir):
    """Enrich orders with customer segment and nation name.

    nation has a fixed 25 rows and is always broadcast; customer grows
    with the data, and the optimizer chooses by its bytes.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", F.col("c_nationkey").alias("n_nationkey"))
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    out = D.lookup_join(orders, cust, "c_custkey")
    out = D.lookup_join(out, nation, "n_nationkey", assume_small=True)
    return out.select("o_orderkey", "c_mktsegment", "n_name")


@query(
    "lookup_enrich_large",
    """
    SELECT o.o_orderkey, c.c_mktsegment, n.n_name
    FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
    LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
    """,
)
def lookup_enrich_large(spark, sf_dir):
    """J1 on the path for a customer table too large to broadcast: hot
    customer keys apart, all others joined as the optimizer sees fit; same
    result as ``lookup_enrich``."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", F.col("c_nationkey").alias("n_nationkey"))
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    out = D.lookup_join(orders, cust, "c_custkey", split_hot_keys=True)
    out = D.lookup_join(out, nation, "n_nationkey", assume_small=True)
    return out.select("o_orderkey", "c_mktsegment", "n_name")


@query(
    "lookup_enrich_hot",
    """
    SELECT o_orderkey, o.o_orderstatus, top_price
    FROM orders o LEFT JOIN (SELECT o_orderstatus, max(o_totalprice) AS top_price FROM orders
    WHERE o_orderstatus <> 'F' GROUP BY o_orderstatus) s ON o.o_orderstatus = s.o_orderstatus
    """,
)
def lookup_enrich_hot(spark, sf_dir):
    """J1 on keys that each hold a large share of all rows, one of them without a lookup row."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    tops = orders.filter(F.col("o_orderstatus") != "F").groupBy("o_orderstatus").agg(F.max("o_totalprice").alias("top_price"))
    out = D.lookup_join(orders.drop("o_totalprice"), tops, "o_orderstatus", split_hot_keys=True, hot_rows=1000)
    return out.select("o_orderkey", "o_orderstatus", "top_price")


@query(
    "unknown_categories",
    """
    WITH t AS (SELECT o.o_orderdate, o.o_orderstatus, o.o_orderpriority, c.c_name
               FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey),
    pairs AS (
      SELECT 'o_orderstatus' AS "column", o_orderstatus AS value, o_orderdate FROM t
      UNION ALL SELECT 'o_orderpriority', o_orderpriority, o_orderdate FROM t
      UNION ALL SELECT 'c_name', c_name, o_orderdate FROM t
      UNION ALL SELECT 'order_month', strftime(o_orderdate, '%Y-%m'), o_orderdate FROM t),
    train AS (SELECT DISTINCT "column", value FROM pairs WHERE o_orderdate < TIMESTAMP '2000-01-01' AND value IS NOT NULL),
    score AS (SELECT "column", value, count(*) AS n FROM pairs
              WHERE o_orderdate >= TIMESTAMP '2000-01-01' AND value IS NOT NULL GROUP BY 1, 2)
    SELECT s."column", s.value, s.n FROM score s ANTI JOIN train r ON s."column" = r."column" AND s.value = r.value
    """,
)
def unknown_categories(spark, sf_dir):
    """Categories met when scoring (orders from 2000 on) that the
    training rows (orders before 2000) never had."""
    cust = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    df = (
        table(spark, sf_dir, "orders")
        .join(cust, "o_custkey", "left")
        .withColumn("order_month", F.date_format("o_orderdate", "yyyy-MM"))
    )
    cutoff = F.lit("2000-01-01").cast("timestamp_ntz")
    cols = ["o_orderstatus", "o_orderpriority", "c_name", "order_month"]
    return SC.unknown_categories(df.where(F.col("o_orderdate") < cutoff), df.where(F.col("o_orderdate") >= cutoff), cols)


PART_SCHEMA = (
    "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
)


@query("csv_roundtrip", "SELECT * FROM part")
def csv_roundtrip(spark, sf_dir):
    """Write part as CSV to the shared scratch folder, scan it back
    with a header and an explicit schema (one pass, no inference)."""
    from sylvan.session import scratch_path
    from sylvan.sources.tables import read_csv, write_csv

    path = write_csv(table(spark, sf_dir, "part"), scratch_path(spark, "csv"))
    return read_csv(spark, path, schema=PART_SCHEMA)


FILLED_SQL = f"""
    WITH d AS (SELECT d.doc_id, l.quality, CASE WHEN l.toxic IS NULL THEN NULL ELSE d.lang END AS lang_if_labelled
               FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
    train AS (SELECT * FROM d WHERE {HASH_SQL.format(p='split', k='doc_id')} < 0.7),
    m AS (SELECT avg(quality) AS q FROM train),
    t AS (SELECT lang_if_labelled AS v FROM train WHERE lang_if_labelled IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
    SELECT doc_id, round(coalesce(quality, m.q), 6) AS quality, coalesce(lang_if_labelled, t.v) AS lang_if_labelled,
           (quality IS NULL)::INTEGER::DOUBLE AS quality_filled, (lang_if_labelled IS NULL)::INTEGER::DOUBLE AS lang_if_labelled_filled
    FROM d, m, t
"""


@query("impute_fitted", FILLED_SQL)
def impute_fitted(spark, sf_dir):
    """fill values learned on the training part, the model saved and
    loaded, all rows filled with them and marked."""
    from sylvan.operators.impute import FillMissing, FillMissingModel
    from sylvan.session import scratch_path

    d = docs_with_labels(spark, sf_dir).select("doc_id", "quality", F.when(F.col("toxic").isNotNull(), F.col("lang")).alias("lang_if_labelled"))
    train, _ = TG.hash_split(d, "doc_id")
    path = scratch_path(spark, "fill")
    FillMissing(numericCols=["quality"], textCols=["lang_if_labelled"], flagSuffix="_filled").fit(train).write().save(path)
    out = FillMissingModel.load(path).transform(d)
    return out.withColumn("quality", r6("quality"))


@query(
    "undersample_exact",
    """
    WITH l AS (SELECT doc_id, quality, ('0x' || substr(md5('undersample:' || doc_id::VARCHAR), 1, 15))::BIGINT AS h FROM labels WHERE quality IS NOT NULL),
    r AS (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY h, doc_id) AS nth FROM l)
    SELECT doc_id, quality FROM r WHERE nth <= (SELECT min(n) FROM (SELECT count(*) AS n FROM l GROUP BY quality))
    """,
)
def undersample_exact(spark, sf_dir):
    """Every class with exactly as many rows as the smallest, without a sort."""
    return TG.undersample_exact(table(spark, sf_dir, "labels"), "quality", "doc_id").select("doc_id", "quality")


CSV_FAULTS = {7: "bad value in o_orderkey", 11: "too few fields", 13: "too many fields", 17: "bad value in o_totalprice"}


@query(
    "csv_quarantine",
    "SELECT CASE o_orderkey % 50 " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in CSV_FAULTS.items()) + """ ELSE 'clean' END AS reason,
    count(*) AS n, round(sum(CASE WHEN o_orderkey % 50 NOT IN (7, 11, 13, 17) THEN o_totalprice END), 2) AS total FROM orders GROUP BY 1""",
)
def csv_quarantine(spark, sf_dir):
    """Orders written as CSV with four kinds of faults, read back; clean rows and rejected lines by reason."""
    from sylvan.session import scratch_path
    from sylvan.sources.quarantine import read_csv_checked

    o = table(spark, sf_dir, "orders")
    fault = F.col("o_orderkey") % 50
    key, price = F.col("o_orderkey").cast("string"), F.col("o_totalprice").cast("string")
    fields = [F.when(fault == 7, F.concat(F.lit("no"), key)).otherwise(key), F.concat(F.lit('"'), "o_orderpriority", F.lit(', ""so""'), F.lit('"'))]
    line = F.concat_ws(",", *fields, F.when(fault == 17, "1.2.3").when(fault != 11, price), F.when(fault == 13, "extra"))
    path = scratch_path(spark, "csv")
    o.select(line.alias("value")).write.text(path)
    clean, rejected = read_csv_checked(spark, path, "o_orderkey long, o_orderpriority string, o_totalprice double", header=False)
    good = clean.agg(F.lit("clean").alias("reason"), F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    bad = rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.lit(None).cast("double").alias("total"))
    return good.unionByName(bad)
