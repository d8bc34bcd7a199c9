"""Mixing sources to target weights without sorting documents.

Method: hash-threshold histograms. Sizes are summed by source and hash
bucket; the running sum over a source's buckets finds the bucket in which
the budget ends; only that bucket is refined by the next hash bits, until
it holds one document. The final threshold is a plain filter on the hash.
DataFrame functions only.

Targets: sources by code point (null last) weigh 1, 2, 3, repeating, and
share all words; a target stops at ``max_repeat`` times its source's size
and the excess is shared anew by weight until none is above.

Each document is taken floor(target / size) times; the documents whose hash
lies below the source's threshold once more. The threshold includes the
document in which the budget ends if that comes nearer to the target.

Defined cases: a null text has size 0; documents with the same id and text
share a hash and are taken alike; a source without words has target 0; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sylvan.llm.common import HOT_SHARE, WORD, unpack, whole_row, written

HASH_BITS = 60
LEVEL_BITS = 12


def source_targets(sizes: DataFrame, max_repeat: int = 3) -> DataFrame:
    """``source, size, docs`` to ``source, docs, source_size, target``.

    One row per source; the windows over all rows see sources, not
    documents. The water level is the closed form of capping and sharing
    anew: sources sorted by cap per weight, capped while the level of the
    rest lies at or above theirs.
    """
    everything = Window.partitionBy()
    by_name = Window.partitionBy().orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.partitionBy().orderBy("_ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest_w = F.col("_weights") - F.coalesce(F.sum("_w").over(before), F.lit(0))
    rest_t = F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0))
    return (
        sizes.withColumn("_w", ((F.row_number().over(by_name) - 1) % 3 + 1).cast("long"))
        .withColumn("_cap", F.col("size") * max_repeat)
        .withColumn("_ratio", F.col("_cap").cast("double") / F.col("_w"))
        .withColumn("_total", F.sum("size").over(everything))
        .withColumn("_weights", F.sum("_w").over(everything))
        .withColumn("_rank", F.row_number().over(by_ratio))
        .withColumn("_level", rest_t.cast("double") / rest_w.cast("double"))
        .withColumn("_capped", F.col("_level") >= F.col("_ratio"))
        .withColumn("_k", F.sum(F.col("_capped").cast("int")).over(everything))
        .withColumn("_water", F.max(F.when(F.col("_rank") == F.col("_k") + 1, F.col("_level"))).over(everything))
        .select(
            "source",
            "docs",
            F.col("size").alias("source_size"),
            F.when(F.col("_capped"), F.col("_cap").cast("double")).otherwise(F.col("_water") * F.col("_w")).alias("target"),
        )
    )


def _thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """``source``, whole repeats ``_m`` and hash threshold ``_theta`` for each source."""
    m = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = F.col("target") - F.col("_m") * F.col("source_size")
    state = targets.select("source", "docs", "source_size", "target", m.alias("_m")).select(
        "*", rest.alias("_rest"), F.lit(0).cast("long").alias("_prefix"), F.when(rest <= 0, F.lit(0)).cast("long").alias("_theta")
    )
    state = written(state, "mix-state")
    shift = HASH_BITS
    while True:
        step = min(LEVEL_BITS, shift)
        outer, shift = shift, shift - step
        active = state.filter(F.col("_theta").isNull()).select(F.col("source").alias("_s"), F.col("_prefix").alias("_p"), "_rest")
        if outer == HASH_BITS:
            inside = sized.withColumn("_b", F.shiftright("_hash", shift))
        else:
            # source and prefix together: a hot source is spread over its buckets before it meets its row
            inside = (
                sized.withColumn("_b", F.shiftright("_hash", shift))
                .join(active.select("_s", "_p"), F.col("source").eqNullSafe(F.col("_s")) & (F.shiftright("_hash", outer) == F.col("_p")))
                .drop("_s", "_p")
            )
        hist = inside.groupBy("source", "_b").agg(F.sum("size").alias("_sum"), F.count(F.lit(1)).alias("_n"))
        w = Window.partitionBy("source").orderBy("_b")
        cross = (
            hist.withColumn("_cum", F.sum("_sum").over(w))
            .join(active, F.col("source").eqNullSafe(F.col("_s")))
            .filter((F.col("_cum") > F.col("_rest")) & (F.col("_cum") - F.col("_sum") <= F.col("_rest")))
            .select(F.col("_s").alias("_xs"), F.col("_b"), F.col("_sum"), F.col("_cum"), F.col("_n"))
        )
        last = (F.col("_n") == 1) | F.lit(shift == 0)
        left = F.col("_rest") - (F.col("_cum") - F.col("_sum"))
        nearer = F.col("_sum") - left < left
        edge = F.shiftleft(F.col("_b") + F.when(nearer, 1).otherwise(0), shift)
        state = (
            state.join(cross, F.col("source").eqNullSafe(F.col("_xs")), "left")
            .withColumn(
                "_theta",
                F.when(F.col("_theta").isNotNull(), F.col("_theta"))
                .when(F.col("_b").isNull(), F.lit(1 << HASH_BITS))  # the budget takes all documents
                .when(last, edge),
            )
            .withColumn("_prefix", F.coalesce(F.col("_b"), F.col("_prefix")))
            .withColumn("_rest", F.coalesce(left, F.col("_rest")))
            .drop("_xs", "_b", "_sum", "_cum", "_n")
        )
        state = written(state, "mix-state")
        if shift == 0 or state.filter(F.col("_theta").isNull()).isEmpty():
            return state.select("source", "docs", "source_size", "target", "_m", "_theta")


def _hash():
    """60 bits of a digest of id and text."""
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.coalesce(F.col("text"), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("long")


def _join_plan(rows: DataFrame, plan: DataFrame, total: int) -> DataFrame:
    """Rows with their source's plan. At most HOT_SHARE sources hold 1/HOT_SHARE of the rows
    each: those are broadcast, the rest cannot skew a shuffle."""
    hot = F.col("docs") >= max(total // HOT_SHARE, 100_000)
    on = F.col("source").eqNullSafe(F.col("_s"))
    plan = plan.withColumnRenamed("source", "_s")
    return rows.join(F.broadcast(plan.filter(hot)), on).unionByName(rows.join(plan.filter(~hot), on))


def mix(docs: DataFrame, max_repeat: int = 3) -> tuple[DataFrame, DataFrame]:
    """The mix: one row per document (``doc_id, source, size, source_size, target, repeats``) and the plan per source."""
    text = F.coalesce(F.col("text"), F.lit(""))
    measured = docs.select("doc_id", "source", F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), _hash().alias("_hash"))
    sized = written(measured, "mix-sizes")
    sources = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("docs"))
    plan = _thresholds(sized, source_targets(written(sources, "mix-sources"), max_repeat))
    joined = _join_plan(sized, plan, sized.count())
    extra = (F.col("_hash") < F.col("_theta")).cast("long")
    return joined.select("doc_id", "source", "size", "source_size", "target", (F.col("_m") + extra).alias("repeats")), plan


def mix_documents(docs: DataFrame, **params) -> DataFrame:
    """The mixed documents: each row as often as the mix takes it."""
    plan = mix(docs, **params)[1]
    rows = docs.select(whole_row(docs).alias("_row"), F.col("source"), _hash().alias("_hash"))
    times = (F.col("_m") + (F.col("_hash") < F.col("_theta")).cast("long")).cast("int")
    picked = _join_plan(rows, plan, docs.count()).select("_row", times.alias("_t")).filter(F.col("_t") > 0)
    return unpack(picked.select("_row", F.explode(F.array_repeat(F.lit(0), F.col("_t")))))
