"""Line dedup: drop lines that many documents repeat, keep them in one document.

Method: explode normalised lines, hash, count distinct documents per hash,
drop lines over the threshold, reassemble by position. DataFrame functions
only.

Defined cases: a null or empty text is one empty line (kept text ''). Rows
that share a ``doc_id`` are one document for the count; each row is
reassembled on its own, equal rows alike. A null ``doc_id`` never counts as
a document and never keeps a line that is over the threshold. An empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylvan.llm.common import LOWER, SPACE, UPPER, join_counted, unpack, whole_row, written


def line_key(line):
    """The key of a line: white space stripped at both ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(SPACE)), UPPER, LOWER)


def line_dedup(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """``_row`` (the input columns), ``n_lines``, ``n_dropped``, ``kept_text`` for each input row.

    Lines travel as 16-byte digests with their positions, never as text;
    only documents meet their dropped positions again in one join.
    """
    base = docs.select(
        whole_row(docs).alias("_row"),
        F.col("doc_id").alias("_doc"),
        F.xxhash64(F.col("text")).alias("_rid"),
        F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1).alias("_lines"),
    )
    long_lines = (
        base.select("_doc", "_rid", F.posexplode("_lines").alias("_pos", "_line"))
        .withColumn("_line", F.btrim("_line", F.lit(SPACE)))
        .filter(F.char_length("_line") >= min_chars)
        .select("_doc", "_rid", "_pos", F.unhex(F.md5(line_key(F.col("_line")))).alias("_h"))
    )
    long_lines = written(long_lines, "lines")
    hot = (
        long_lines.groupBy("_h")
        .agg(F.countDistinct("_doc").alias("_docs"), F.count(F.lit(1)).alias("_n"), F.max("_doc").alias("_keeper"))
        .filter(F.col("_docs") >= min_docs)
    )
    hot = written(hot, "hot-lines")
    drops = (
        join_counted(long_lines, hot, ["_h"], "_n", long_lines.count())
        .filter(~F.col("_doc").eqNullSafe(F.col("_keeper")))
        .groupBy(F.col("_doc").alias("_d"), F.col("_rid").alias("_r"))
        .agg(F.collect_set("_pos").alias("_drop"))
    )
    joined = base.join(drops, F.col("_doc").eqNullSafe(F.col("_d")) & (F.col("_rid") == F.col("_r")), "left")
    keep = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_drop"))
    lines = F.col("_lines")
    rest = F.array_join(F.transform(keep, lambda i: F.element_at(lines, i + 1)), "\n")
    return joined.select(
        "_row",
        F.size("_lines").cast("long").alias("n_lines"),
        F.when(F.col("_drop").isNull(), F.lit(0)).otherwise(F.size("_drop")).cast("long").alias("n_dropped"),
        F.when(F.col("_drop").isNull(), F.coalesce(F.col("_row.text"), F.lit(""))).otherwise(rest).alias("kept_text"),
    )


def dedup_documents(docs: DataFrame, **params) -> DataFrame:
    """The documents with their repeated lines dropped (a null text becomes '').

    A column ``n_chars``, where there is one, is counted anew.
    """
    out = line_dedup(docs, **params)
    changed = {"text": F.col("kept_text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.char_length("kept_text").cast(docs.schema["n_chars"].dataType)
    return unpack(out, **changed)
