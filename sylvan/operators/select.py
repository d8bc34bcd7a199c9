"""Column selection over a profile.

A profile has one row per column of the profiled table, so every list
collected here is bounded by the schema width, not by the data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylvan import names
from sylvan.functions.columns import safe_ratio


def _names(prof: DataFrame) -> list[str]:
    return [r["name"] for r in prof.select("name").collect()]


def text_columns_df(
    prof: DataFrame,
    max_distinct: int | None = None,
    inclusive: bool = False,
    min_completeness: float | None = None,
    exclude: tuple[str, ...] = (),
) -> DataFrame:
    """Profile rows of text columns, optionally bounded in cardinality."""
    cond = F.col("colType") == names.TEXT
    if max_distinct is not None:
        d = F.col("nbDistinctValues")
        cond &= (d <= max_distinct) if inclusive else (d < max_distinct)
    if min_completeness is not None:
        cond &= F.col("compRatio") > min_completeness
    if exclude:
        cond &= ~F.col("name").isin(list(exclude))
    return prof.where(cond)


def text_columns(prof: DataFrame, *args, **kwargs) -> list[str]:
    return sorted(_names(text_columns_df(prof, *args, **kwargs)))


def numeric_columns_df(
    prof: DataFrame,
    exclude: tuple[str, ...] = (),
    min_completeness: float | None = None,
) -> DataFrame:
    """Profile rows of numeric columns except the target.

    Exclusion is by exact name: the reference drops any column whose name
    merely *contains* the target name.
    """
    cond = F.col("colType") == names.NUMERIC
    if exclude:
        cond &= ~F.col("name").isin(list(exclude))
    if min_completeness is not None:
        cond &= F.col("compRatio") > min_completeness
    return prof.where(cond)


def numeric_columns(prof: DataFrame, *args, **kwargs) -> list[str]:
    return sorted(_names(numeric_columns_df(prof, *args, **kwargs)))


def complete_columns(prof: DataFrame) -> list[str]:
    """Names of columns without NULLs."""
    return _names(prof.where(F.col("compRatio") == 1.0))


def project_complete(df: DataFrame, prof: DataFrame) -> DataFrame:
    """Keep only the complete columns of ``df``, in table order."""
    keep = set(complete_columns(prof))
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c in keep])


def quality_report(prof: DataFrame, min_completeness: float = 0.5, max_distinct: int = 100) -> DataFrame:
    """Incomplete or high-cardinality columns with the reason."""
    incomplete = F.col("compRatio") < min_completeness
    wide = F.col("nbDistinctValues") > max_distinct
    return prof.where(incomplete | wide).select(
        "name",
        "compRatio",
        "nbDistinctValues",
        incomplete.alias("incomplete"),
        wide.alias("highCardinality"),
    )


# Name tokens that mark an identifier column, and the ratio.
ID_NAME_TOKENS = ("id", "key")
ID_UNIQUE_RATIO = 0.95
FRACTIONAL_TYPES = ("FloatType", "DoubleType", "DecimalType")


def identifier_columns(prof: DataFrame, total_rows: int | None = None) -> DataFrame:
    """Flag identifier columns: a token of the name is id/key, or distinct/rows > 0.95.

    Tokens are cut at ``_``, other separators and a lower/upper case change
    (``userId``); ``humidity`` has no such token. Fractional columns are
    measures: their uniqueness says nothing and marks none of them.

    The uniqueness is distinct values over *rows* (the reference divides by
    the completeness ratio, which flags every column). Uses the profile's
    ``nRows`` (or ``total_rows`` for a profile without it).
    """
    rows = F.col("nRows") if "nRows" in prof.columns else F.lit(total_rows)
    tokens = F.split(F.lower(F.regexp_replace("name", r"([\p{Ll}\d])(\p{Lu})", "$1_$2")), r"[^\p{L}\d]+")
    name_hit = F.arrays_overlap(tokens, F.array(*[F.lit(t) for t in ID_NAME_TOKENS]))
    fractional = F.col("origType").isin(*FRACTIONAL_TYPES)
    ratio = safe_ratio("nbDistinctValues", rows)
    return prof.select(
        "name",
        ratio.alias("uniqueRatio"),
        name_hit.alias("nameMatch"),
        (name_hit | (F.coalesce(ratio > ID_UNIQUE_RATIO, F.lit(False)) & ~fractional)).alias("isIdentifier"),
    )


@dataclass(frozen=True)
class PipelineConfig:
    text_cols: list[str]
    numeric_cols: list[str]
    max_categories: int
    handle_invalid: str


def config_from_profile(
    prof: DataFrame,
    target: str,
    min_text_completeness: float = 0.8,
    max_text_distinct: int = 20,
    min_numeric_completeness: float = 0.7,
) -> PipelineConfig:
    """Pipeline settings derived from a profile.

    Text columns with completeness > .8 and at most 20 values, numeric
    columns with completeness > .7 (target excluded by exact name), and
    maxCategories = max(10, 2 * mean text cardinality).
    """
    text = text_columns(
        prof, max_distinct=max_text_distinct, inclusive=True, min_completeness=min_text_completeness, exclude=(target,)
    )
    numeric = numeric_columns(prof, exclude=(target,), min_completeness=min_numeric_completeness)
    avg = prof.where(F.col("colType") == names.TEXT).agg(F.avg("nbDistinctValues")).first()[0]
    max_cat = max(10, int(avg or 0) * 2)
    return PipelineConfig(text, numeric, max_cat, "skip")


def adaptive_settings(prof: DataFrame) -> tuple[int, str]:
    """maxCategories 50 if more than 10 text columns else 20; ``skip`` when
    any column is under .9 complete, else ``error`` (C10)."""
    row = prof.agg(
        F.sum(F.when(F.col("colType") == names.TEXT, 1).otherwise(0)).alias("n_text"),
        F.sum(F.when(F.col("compRatio") < 0.9, 1).otherwise(0)).alias("n_incomplete"),
    ).first()
    max_cat = 50 if (row["n_text"] or 0) > 10 else 20
    handle = "skip" if (row["n_incomplete"] or 0) > 0 else "error"
    return max_cat, handle


def order_profile(prof: DataFrame, by: str = "completeness") -> DataFrame:
    """Completeness desc, or distinct desc then class asc (C11)."""
    if by == "completeness":
        return prof.orderBy(F.col("compRatio").desc(), F.col("name"))
    return prof.orderBy(F.col("nbDistinctValues").desc(), F.col("colType"), F.col("name"))
