"""The registered query of each operator, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sylvan.llm import hard_negatives, jaccard, language_id, licenses, line_dedup, mixing, packing, periodic_runs, piece_codec, pivot_search, secrets, toxicity, vp_search
from sylvan.llm.common import table
from sylvan.llm.sql import SQL

TOKENIZER = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.train(docs, ~language_id.labelled_part())
    out = language_id.predict(docs.select("doc_id", "text"), model, keep=("doc_id",))
    return out.select("_row.doc_id", "lang_pred", "score").select("doc_id", language_id.labelled_part().alias("held_out"), "lang_pred", "score")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("_row.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_vp_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vp_search.cosine_neighbours(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents"))[0]
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("repeats")).alias("taken"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_groups(table(spark, sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = licenses.scan_licences(table(spark, sf_dir, "documents"))
    found = F.array_join(F.transform("found", lambda f: F.concat_ws(":", f["pos"].cast("string"), f["family"])), ",")
    return out.select("doc_id", "n_paragraphs", "n_licence", "families", found.alias("found"))


def op8_pivot_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_search.inner_product_top(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, k=10)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    out = toxicity.score(docs.select("doc_id", "text"), model, keep=("doc_id",))
    return out.select("_row.doc_id", "score", "predicted").select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(secrets.span_text("base_spans"), 256).alias("base_sha256"), secrets.span_text("spans").alias("spans"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return periodic_runs.run_report(periodic_runs.find_runs(periodic_runs.with_loops(docs)))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", label), F.col("id") % 100 == 0)


def op13_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = piece_codec.encode_texts(docs, public_tokenizers.path(PIECES))
    digest = F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), digest.alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_language_id, op2_line_dedup, op3_vp_search, op4_best_fit_packing, op5_source_mix,
        op6_jaccard_join, op7_license_scan, op8_pivot_search, op9_toxicity, op10_secret_scan,
        op11_periodic_runs, op12_hard_negatives, op13_piece_codec,
    )
}
ORACLE: dict[str, str] = {k: v for k, v in SQL.items() if k in QUERIES}
