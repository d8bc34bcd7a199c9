"""Feature-transformer queries (F1-F32, F16)."""

from __future__ import annotations

from pyspark.ml.feature import IndexToString
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from sylvan import names
from sylvan.operators import features as FT
from sylvan.operators import label_dictionary as LD
from sylvan.operators import text as TX
from sylvan.plans.registry import docs_with_labels, documents, labeled_docs, query, r6, table


def _rank_sql(tbl: str, col: str, key: str | None = None) -> str:
    """SQL of StringIndexer(frequencyDesc): count desc, then string asc."""
    v = f"CAST({col} AS VARCHAR)"
    return (
        f"(SELECT {v} AS v, (row_number() OVER (ORDER BY count(*) DESC, {v}) - 1)::DOUBLE AS i "
        f"FROM {tbl} GROUP BY {v})"
    )


def _vi_rank_sql(tbl: str, col: str) -> str:
    """SQL of VectorIndexer's category order: 0 first, then ascending."""
    return (
        f"(SELECT v, (row_number() OVER (ORDER BY CASE WHEN v = 0 THEN 0 ELSE 1 END, v) - 1) AS i "
        f"FROM (SELECT DISTINCT {col}::DOUBLE AS v FROM {tbl}))"
    )


def _vec_cols(df, vec, n, prefix="f", keep=()):
    arr = vector_to_array(F.col(vec))
    return df.select(*keep, *[arr[i].alias(f"{prefix}{i}") for i in range(n)])


@query(
    "string_index",
    f"""
    SELECT p.p_partkey, a.i AS indexed_p_type, b.i AS indexed_p_brand, c.i AS indexed_p_size
    FROM part p
    JOIN {_rank_sql('part', 'p_type')} a ON p.p_type = a.v
    JOIN {_rank_sql('part', 'p_brand')} b ON p.p_brand = b.v
    JOIN {_rank_sql('part', 'p_size')} c ON CAST(p.p_size AS VARCHAR) = c.v
    """,
)
def string_index(spark, sf_dir):
    """multi-column StringIndexer, frequency desc then value asc."""
    part = table(spark, sf_dir, "part")
    cols = ["p_type", "p_brand", "p_size"]
    model = FT.string_indexer(cols).fit(part)
    return model.transform(part).select("p_partkey", *[names.PREFIX + c for c in cols])


@query(
    "label_dictionary",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value, count(*) AS n,
        (row_number() OVER (ORDER BY count(*) DESC, CAST({c} AS VARCHAR)) - 1)::DOUBLE AS "index"
        FROM orders WHERE {c} IS NOT NULL GROUP BY CAST({c} AS VARCHAR)"""
        for c in ("o_orderkey", "o_custkey", "o_orderpriority")
    ),
)
def label_dictionary(spark, sf_dir):
    """labels numbered as a table, one of them a key with a label for every row."""
    return LD.label_dictionary(table(spark, sf_dir, "orders"), ["o_orderkey", "o_custkey", "o_orderpriority"])


@query(
    "label_encode",
    f"""
    WITH d AS (SELECT d.*, CAST(l.quality AS VARCHAR) AS quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
    k AS (SELECT CAST(count(DISTINCT quality) AS DOUBLE) AS unknown FROM d)
    SELECT d.doc_id, a.i AS indexed_lang, b.i AS indexed_source, coalesce(c.i, k.unknown) AS indexed_quality
    FROM d CROSS JOIN k JOIN {_rank_sql('documents', 'lang')} a ON d.lang = a.v JOIN {_rank_sql('documents', 'source')} b ON d.source = b.v
    LEFT JOIN {_rank_sql('labels', 'quality')} c ON d.quality = c.v
    """,
)
def label_encode(spark, sf_dir):
    """three columns encoded by join with their dictionary; NULLs get the index after the last."""
    docs = docs_with_labels(spark, sf_dir).select("doc_id", "lang", "source", "quality")
    cols = ["lang", "source", "quality"]
    out = LD.encode_labels(docs, LD.label_dictionary(docs, cols), cols, handle_invalid="keep")
    return out.select("doc_id", *[names.PREFIX + c for c in cols])


@query(
    "label_maps",
    f"""
    SELECT 'o_orderstatus' AS "column", v AS value, i AS "index" FROM {_rank_sql('orders', 'o_orderstatus')}
    UNION ALL
    SELECT 'o_orderpriority', v, i FROM {_rank_sql('orders', 'o_orderpriority')}
    """,
)
def label_maps(spark, sf_dir):
    """value -> index map of every fitted indexer column."""
    cols = ["o_orderstatus", "o_orderpriority"]
    model = FT.string_indexer(cols).fit(table(spark, sf_dir, "orders"))
    return FT.label_maps_df(spark, model, cols)


@query("index_to_string", "SELECT p_partkey, p_type AS p_type_decoded FROM part")
def index_to_string(spark, sf_dir):
    """index then decode with the fitted labels gives the input back."""
    part = table(spark, sf_dir, "part")
    model = FT.string_indexer(["p_type"]).fit(part)
    idx = model.transform(part)
    dec = IndexToString(inputCol="indexed_p_type", outputCol="p_type_decoded", labels=model.labelsArray[0])
    return dec.transform(idx).select("p_partkey", "p_type_decoded")


def _one_hot_part(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    idx = FT.string_indexer(["p_type"]).fit(part).transform(part)
    return FT.one_hot(idx, ["indexed_p_type"], ["onehot_p_type"], drop_last=False)


@query(
    "one_hot",
    f"""
    SELECT p.p_partkey, CAST((SELECT count(DISTINCT p_type) FROM part) AS INTEGER) AS size,
           CAST(a.i AS BIGINT) AS hot_slot, 1.0::DOUBLE AS total
    FROM part p JOIN {_rank_sql('part', 'p_type')} a ON p.p_type = a.v
    """,
)
def one_hot(spark, sf_dir):
    """one-hot with dropLast=false: one slot per category, one 1.0."""
    arr = vector_to_array(F.col("onehot_p_type"))
    return _one_hot_part(spark, sf_dir).select(
        "p_partkey",
        F.size(arr).alias("size"),
        (F.array_position(arr, 1.0) - 1).alias("hot_slot"),
        F.aggregate(arr, F.lit(0.0), lambda a, x: a + x).alias("total"),
    )


@query(
    "one_hot_valid",
    "SELECT count(*) AS n, count(*) AS n_valid, CAST(0 AS BIGINT) AS n_invalid FROM part",
)
def one_hot_valid(spark, sf_dir):
    """F8: every one-hot vector sums to 1 (SQL aggregate, no UDF)."""
    return FT.one_hot_valid(_one_hot_part(spark, sf_dir), "onehot_p_type")


@query(
    "vector_sizes",
    """
    SELECT CAST(count(DISTINCT l_returnflag) + count(DISTINCT l_linestatus) + 2 AS INTEGER) AS min_size,
           CAST(count(DISTINCT l_returnflag) + count(DISTINCT l_linestatus) + 2 AS INTEGER) AS max_size
    FROM lineitem
    """,
)
def vector_sizes(spark, sf_dir):
    """assembled size = one-hot slots of two text columns + 2 numbers."""
    li = table(spark, sf_dir, "lineitem")
    idx = FT.string_indexer(["l_returnflag", "l_linestatus"]).fit(li).transform(li)
    hot = FT.one_hot(idx, ["indexed_l_returnflag", "indexed_l_linestatus"], ["h1", "h2"])
    vec = FT.assemble(hot, ["h1", "h2", "l_quantity", "l_discount"], "v")
    return FT.vector_sizes(vec, "v")


@query(
    "assemble",
    """
    SELECT l_orderkey, l_linenumber, l_quantity AS f0, l_extendedprice AS f1, l_discount AS f2, l_tax AS f3
    FROM lineitem
    """,
)
def assemble(spark, sf_dir):
    """VectorAssembler keeps inputCols order."""
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    v = FT.assemble(table(spark, sf_dir, "lineitem"), cols, names.FEATURES_VEC)
    return _vec_cols(v, names.FEATURES_VEC, len(cols), keep=("l_orderkey", "l_linenumber"))


VI_COLS = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
VI_MAX_CATEGORIES = 12


def _vector_indexed(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    v = FT.assemble(li, VI_COLS, names.FEATURES_VEC)
    model = FT.vector_indexer(max_categories=VI_MAX_CATEGORIES).fit(v)
    return model, model.transform(v)


@query(
    "vector_index",
    f"""
    SELECT l.l_orderkey, l.l_linenumber, l.l_quantity AS f0, a.i::DOUBLE AS f1, b.i::DOUBLE AS f2, c.i::DOUBLE AS f3
    FROM lineitem l
    JOIN {_vi_rank_sql('lineitem', 'l_discount')} a ON l.l_discount = a.v
    JOIN {_vi_rank_sql('lineitem', 'l_tax')} b ON l.l_tax = b.v
    JOIN {_vi_rank_sql('lineitem', 'l_linenumber')} c ON l.l_linenumber = c.v
    """,
)
def vector_index(spark, sf_dir):
    """slots with <= 12 values become categorical (0 first, then ascending)."""
    _, out = _vector_indexed(spark, sf_dir)
    return _vec_cols(out, names.FEATURES, len(VI_COLS), keep=("l_orderkey", "l_linenumber"))


@query(
    "category_maps",
    " UNION ALL ".join(
        f"SELECT CAST({slot} AS INTEGER) AS slot, round(v, 6) AS value, CAST(i AS INTEGER) AS \"index\" "
        f"FROM {_vi_rank_sql('lineitem', c)}"
        for slot, c in ((1, "l_discount"), (2, "l_tax"), (3, "l_linenumber"))
    ),
)
def category_maps(spark, sf_dir):
    """(slot, value, index) of the fitted VectorIndexer."""
    model, _ = _vector_indexed(spark, sf_dir)
    return FT.category_maps_df(spark, model).select("slot", r6("value").alias("value"), "index")


@query(
    "slot_kinds",
    f"""
    SELECT CAST(sum(CASE WHEN d <= {VI_MAX_CATEGORIES} THEN 1 ELSE 0 END) AS INTEGER) AS categorical,
           CAST(sum(CASE WHEN d > {VI_MAX_CATEGORIES} THEN 1 ELSE 0 END) AS INTEGER) AS continuous
    FROM ({' UNION ALL '.join(f'SELECT count(DISTINCT {c}) AS d FROM lineitem' for c in VI_COLS)})
    """,
)
def slot_kinds(spark, sf_dir):
    """F32: number of categorical and continuous slots."""
    model, _ = _vector_indexed(spark, sf_dir)
    k = FT.slot_kinds(model)
    return spark.createDataFrame([(k["categorical"], k["continuous"])], "categorical int, continuous int")


def _embedding_vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", array_to_vector("embedding").alias("v"))


EMB_UNNEST = (
    "(SELECT vec_id, unnest(embedding)::DOUBLE AS v, CAST(unnest(generate_series(0, len(embedding) - 1)) AS INTEGER) AS slot "
    "FROM embeddings)"
)


@query(
    "standard_scale",
    f"""
    SELECT vec_id, slot, round(CASE WHEN s = 0 THEN 0.0 ELSE v / s END, 6) AS value
    FROM (SELECT vec_id, slot, v, stddev_samp(v) OVER (PARTITION BY slot) AS s FROM {EMB_UNNEST})
    """,
)
def standard_scale(spark, sf_dir):
    """StandardScaler (std only) on embedding vectors, per slot."""
    emb = _embedding_vectors(spark, sf_dir)
    scaled = FT.scaler("v", "scaled").fit(emb).transform(emb)
    return scaled.select("vec_id", F.posexplode(vector_to_array("scaled")).alias("slot", "value")).select(
        "vec_id", "slot", r6("value").alias("value")
    )


@query(
    "slice_vector",
    """
    SELECT vec_id, round(embedding[1]::DOUBLE, 6) AS s0, round(embedding[8]::DOUBLE, 6) AS s1,
           round(embedding[64]::DOUBLE, 6) AS s2
    FROM embeddings
    """,
)
def slice_vector(spark, sf_dir):
    """VectorSlicer keeps slots 0, 7 and 63."""
    emb = _embedding_vectors(spark, sf_dir)
    sl = FT.slicer("v", "s", [0, 7, 63]).transform(emb)
    arr = vector_to_array(F.col("s"))
    return sl.select("vec_id", *[r6(arr[i]).alias(f"s{i}") for i in range(3)])


@query("pca", None)
def pca(spark, sf_dir):
    """PCA of the embeddings to 3 components (signs are not unique)."""
    emb = _embedding_vectors(spark, sf_dir)
    out = FT.pca("v", "pc", 3).fit(emb).transform(emb)
    return _vec_cols(out, "pc", 3, prefix="pc", keep=("vec_id",))


@query(
    "pca_variances",
    f"""
    WITH m AS (SELECT vec_id, slot, v - avg(v) OVER (PARTITION BY slot) AS c FROM {EMB_UNNEST}),
         cov AS (SELECT a.slot AS i, b.slot AS j, sum(a.c * b.c) / (count(*) - 1) AS s
                 FROM m a JOIN m b ON a.vec_id = b.vec_id GROUP BY a.slot, b.slot)
    SELECT count(*) FILTER (i = j) AS n_components, round(sum(s) FILTER (i = j), 6) AS total_variance,
           round(sum(s * s), 6) AS sum_sq_variance, true AS descending
    FROM cov
    """,
)
def pca_variances(spark, sf_dir):
    """F20, whatever the signs: variances of all principal components.

    Their sum is the trace of the covariance matrix and the sum of their
    squares that of all its entries; both hold only for a rotation that
    leaves the components uncorrelated. The SQL takes them from the matrix.
    """
    emb = _embedding_vectors(spark, sf_dir)
    size = F.size(vector_to_array("v"))
    k = emb.agg(F.max(size)).first()[0]
    pc = FT.pca("v", "pc", k).fit(emb).transform(emb).select(F.posexplode(vector_to_array("pc")).alias("slot", "value"))
    by_slot = pc.groupBy("slot").agg(F.var_samp("value").alias("var"))  # one row a component
    inorder = F.transform(F.array_sort(F.collect_list(F.struct("slot", "var"))), lambda x: x["var"])
    falls = F.forall(F.sequence(F.lit(1), F.size("vars") - 1), lambda i: F.get("vars", i - 1) >= F.get("vars", i) - 1e-9) if k > 1 else F.lit(True)
    total = by_slot.agg(
        F.count(F.lit(1)).alias("n_components"), r6(F.sum("var")).alias("total_variance"),
        r6(F.sum(F.col("var") * F.col("var"))).alias("sum_sq_variance"), inorder.alias("vars"),
    )
    return total.withColumn("descending", falls).drop("vars")


@query(
    "auto_features_classification",
    f"""
    WITH t AS (SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id)
    SELECT t.doc_id, a.i AS f0, b.i AS f1, t.n_chars::DOUBLE AS f2, q.i AS label
    FROM t JOIN {_rank_sql('t', 'lang')} a ON t.lang = a.v
    JOIN {_rank_sql('t', 'source')} b ON t.source = b.v
    JOIN {_rank_sql('t', 'quality')} q ON CAST(t.quality AS VARCHAR) = q.v
    """,
)
def auto_features_classification(spark, sf_dir):
    """F24 + F28: index text and target, assemble, vector-index, encode."""
    df = labeled_docs(spark, sf_dir).select("doc_id", "lang", "source", "n_chars", "quality")
    auto = FT.auto_pipeline(["lang", "source"], ["n_chars"], "quality", "classification", max_categories=32)
    model = auto.pipeline.fit(df)
    out = model.transform(df).select("doc_id", names.FEATURES, F.col(auto.indexed_target).alias(names.LABEL))
    return _vec_cols(out, names.FEATURES, 3, keep=("doc_id", names.LABEL))


@query(
    "auto_features_regression",
    f"""
    SELECT p.p_partkey, a.i AS f0, b.i AS f1, p.p_size::DOUBLE AS f2, p.p_retailprice AS label
    FROM part p JOIN {_rank_sql('part', 'p_type')} a ON p.p_type = a.v
    JOIN {_rank_sql('part', 'p_brand')} b ON p.p_brand = b.v
    """,
)
def auto_features_regression(spark, sf_dir):
    """F25 + F28: regression pipeline (target not indexed), maxCategories 40."""
    part = table(spark, sf_dir, "part")
    auto = FT.auto_pipeline(["p_type", "p_brand"], ["p_size"], "p_retailprice", "regression", max_categories=40)
    model = auto.pipeline.fit(part)
    out = model.transform(part).select("p_partkey", names.FEATURES, F.col("p_retailprice").alias(names.LABEL))
    return _vec_cols(out, names.FEATURES, 3, keep=("p_partkey", names.LABEL))


@query(
    "token_counts",
    r"""
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_tokens, CAST(len(list_distinct(w)) AS BIGINT) AS n_distinct_tokens
    FROM (SELECT doc_id, string_split_regex(regexp_replace(lower(text), '\s+$', ''), '\s') AS w FROM documents)
    """,
)
def token_counts(spark, sf_dir):
    """F16: Tokenizer over whole texts; tokens and distinct tokens per text."""
    return TX.token_counts(documents(spark, sf_dir), "doc_id")


@query(
    "saved_features_regression",
    f"""
    SELECT p.p_partkey, a.i AS f0, b.i AS f1, p.p_size::DOUBLE AS f2, p.p_retailprice AS label
    FROM part p JOIN {_rank_sql('part', 'p_type')} a ON p.p_type = a.v
    JOIN {_rank_sql('part', 'p_brand')} b ON p.p_brand = b.v
    """,
)
def saved_features_regression(spark, sf_dir):
    """Save the *fitted* feature pipeline, load it, encode with it."""
    from sylvan.session import scratch_path
    from sylvan.sources.persist import load_model, save_model

    part = table(spark, sf_dir, "part")
    auto = FT.auto_pipeline(["p_type", "p_brand"], ["p_size"], "p_retailprice", "regression", max_categories=40)
    path = save_model(auto.pipeline.fit(part), scratch_path(spark, "pipelines"))
    out = load_model(path).transform(part).select("p_partkey", names.FEATURES, F.col("p_retailprice").alias(names.LABEL))
    return _vec_cols(out, names.FEATURES, 3, keep=("p_partkey", names.LABEL))


@query(
    "hashing_tf_totals",
    r"""
    SELECT doc_id, CAST(len(w) AS DOUBLE) AS tf_total
    FROM (SELECT doc_id, string_split_regex(regexp_replace(lower(text), '\s+$', ''), '\s') AS w FROM documents)
    """,
)
def hashing_tf_totals(spark, sf_dir):
    """HashingTF(1000) term counts over whole texts; the counts of a
    document add up to its number of tokens (slot positions are Spark's
    own hash and are not compared)."""
    from pyspark.ml.feature import HashingTF

    words = TX.tokens(documents(spark, sf_dir).select("doc_id", "text"), "text", "words")
    tf = HashingTF(inputCol="words", outputCol="tf", numFeatures=1000).transform(words)
    arr = vector_to_array(F.col("tf"))
    return tf.select("doc_id", F.aggregate(arr, F.lit(0.0), lambda a, x: a + x).alias("tf_total"))
