"""The corpus pipeline: language ID, line dedup, near duplicates, source mix, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and reread as the next stage's ``docs``. All stages but
the last return the columns of ``docs``.

* ``language_id`` drops documents whose language is ``und`` (no letter in them) or not told clearly; the others stay as they are.
* ``line_dedup`` drops lines that five documents hold, but for one document.
* ``near_duplicates`` keeps one document (the smallest id) of each group.
* ``source_mix`` takes each document as often as its source's target asks: not at all, once, or up to three times.
* ``packing`` tokenises and packs what is left: one row per piece with its sequence and offset.

Stages that hand texts to Python bound the session's Arrow batches by bytes.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sylvan.llm import jaccard, language_id, line_dedup, mixing, packing
from sylvan.llm.common import small_batches, table, written
from sylvan.llm.queries import TOKENIZER


def stage_language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return language_id.known_language(docs)


def stage_line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_documents(docs)


def stage_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return jaccard.one_per_group(docs)


def stage_source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs)


def stage_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language_id", stage_language_id),
    ("line_dedup", stage_line_dedup),
    ("near_duplicates", stage_near_duplicates),
    ("source_mix", stage_source_mix),
    ("packing", stage_packing),
]

#: SQL cannot express language ID, the tokenizer or packing; the stages are held against brute force in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
