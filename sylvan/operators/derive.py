"""Cleaning and derived columns.

All derivations are column expressions added with one ``withColumns``
call (one Project node) so Catalyst can collapse and push them; the only
fitted step is imputation, whose fitted state is one value per column.
"""

from __future__ import annotations

import functools
import operator

from pyspark.ml.feature import Bucketizer, Imputer, ImputerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sylvan.functions.columns import date_parts, prefix_int

# Keys with more rows are hot; at most so many of them are broadcast with their lookup rows.
HOT_KEY_ROWS = 1_000_000
HOT_KEYS = 1000


def with_date_parts(
    df: DataFrame,
    col: str,
    suffix: str = "",
    fmt: str | None = None,
    drop_source: bool = True,
    names: tuple[str, str, str] = ("dayofmonth", "month", "year"),
) -> DataFrame:
    """Parse ``col`` as a date and add day/month/year columns."""
    out = df.withColumns(date_parts(col, suffix=suffix, fmt=fmt, names=names))
    return out.drop(col) if drop_source else out


def with_prefix_int(df: DataFrame, col: str, out: str | None = None, sep: str = "S") -> DataFrame:
    """Replace ``S123``-style codes by their integer part."""
    return df.withColumns({out or col: prefix_int(col, sep)})


def decade_splits(start: int = 1911, stop: int = 2021, step: int = 10) -> list[float]:
    """Bucket edges ``start, start+step, ..., stop`` (12 edges for 1911..2021)."""
    return [float(x) for x in range(start, stop + 1, step)]


def bucketize(
    df: DataFrame,
    col: str,
    out: str,
    splits: list[float],
    open_ends: bool = True,
    handle_invalid: str = "error",
) -> DataFrame:
    """Bucket a numeric column with Spark ML's Bucketizer.

    With ``open_ends`` the first and last buckets extend to -inf / +inf, so
    values outside the edges land in the end buckets instead of failing
    the job (Spark raises on out-of-range values even with ``keep``).
    Bucket numbers are unchanged for in-range values.
    """
    edges = list(splits)
    if open_ends:
        edges = [float("-inf")] + edges[1:-1] + [float("inf")]
    src = F.col(col).cast("double")
    tmp = f"__{col}_d"
    b = Bucketizer(splits=edges, inputCol=tmp, outputCol=out, handleInvalid=handle_invalid)
    return b.transform(df.withColumn(tmp, src)).drop(tmp)


def range_filter(
    df: DataFrame,
    col: str,
    low: float | None = None,
    high: float | None = None,
    low_inclusive: bool = True,
    high_inclusive: bool = True,
) -> DataFrame:
    """Keep rows with ``low <(=) col <(=) high``; NULL rows are dropped (T5).

    A plain predicate, so it reaches the parquet scan as a pushed filter.
    """
    c = F.col(col)
    cond = F.lit(True)
    if low is not None:
        cond &= (c >= low) if low_inclusive else (c > low)
    if high is not None:
        cond &= (c <= high) if high_inclusive else (c < high)
    return df.where(cond)


def year_range_filter(df: DataFrame, col: str, first_year: int, last_year: int) -> DataFrame:
    """Keep rows whose date/timestamp falls in years first..last (T5).

    Written as literal bounds on the column itself rather than on
    ``year(col)``, so the predicate reaches the parquet scan and row groups
    outside the range are skipped.
    """
    dt = df.schema[col].dataType
    kind = "timestamp_ntz" if isinstance(dt, T.TimestampNTZType) else (
        "date" if isinstance(dt, T.DateType) else "timestamp"
    )
    lo = F.lit(f"{first_year:04d}-01-01").cast(kind)
    hi = F.lit(f"{last_year + 1:04d}-01-01").cast(kind)
    return df.where((F.col(col) >= lo) & (F.col(col) < hi))


def where_sql(df: DataFrame, predicate: str) -> DataFrame:
    """Filter by SQL text, e.g. ``"y between 1911 and 2019"``."""
    return df.where(predicate)


def impute(
    df: DataFrame,
    cols: list[str],
    strategy: str = "mean",
    suffix: str = "",
    relative_error: float = 0.001,
) -> tuple[DataFrame, ImputerModel]:
    """Fill NULL and NaN in numeric columns with mean / median / mode.

    Columns are cast to DOUBLE first (Spark's Imputer keeps integer types,
    which truncates a mean). Median follows Spark: approximate quantile,
    the lower middle value for an even count.
    """
    tmp = {c: f"__imp_{c}" for c in cols}
    staged = df.withColumns({tmp[c]: F.col(c).cast("double") for c in cols})
    imp = Imputer(
        strategy=strategy,
        inputCols=[tmp[c] for c in cols],
        outputCols=[f"{c}{suffix}" if suffix else f"__out_{c}" for c in cols],
        relativeError=relative_error,
    )
    model = imp.fit(staged)
    out = model.transform(staged).drop(*tmp.values())
    if not suffix:
        out = out.drop(*cols).withColumnsRenamed({f"__out_{c}": c for c in cols})
    return out, model


def impute_text_mode(df: DataFrame, cols: list[str]) -> DataFrame:
    """Fill NULL text with each column's most frequent value (ties: smallest).

    One small aggregate per column; the fill values are scalars.
    """
    fills = {}
    for c in cols:
        counts = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("cnt"))
        row = counts.agg(F.min_by(F.col(c), F.struct(-F.col("cnt"), F.col(c))).alias("m")).first()
        if row is not None and row["m"] is not None:
            fills[c] = row["m"]
    return df.fillna(fills) if fills else df


def check_unique(lookup: DataFrame, keys: list[str]) -> None:
    """Raise when a key of ``lookup`` occurs twice: an enrichment must not multiply rows (NULL keys match nothing)."""
    twice = lookup.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1")
    if not twice.isEmpty():
        raise ValueError(f"the lookup has several rows for one value of {', '.join(keys)}")


def lookup_join(
    df: DataFrame,
    lookup: DataFrame,
    on: str | list[str],
    how: str = "left",
    assume_small: bool = False,
    split_hot_keys: bool = False,
    hot_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """Enrich ``df`` with columns of ``lookup`` (J1), whose keys must be unique.

    The optimizer broadcasts the lookup by its bytes or shuffles; a hint is
    given only for tables the caller knows to be of fixed size
    (``assume_small``, e.g. a 25-row nation table). ``split_hot_keys`` is for
    lookups too large to broadcast whole: see :func:`hot_key_join`.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"lookup_join keeps the left side only, not {how!r}")
    if how in ("left_semi", "left_anti"):
        lookup = lookup.select(*keys).distinct()
    else:
        check_unique(lookup, keys)
    if assume_small:
        return df.join(F.broadcast(lookup), keys, how)
    return hot_key_join(df, lookup, keys, how, hot_rows) if split_hot_keys else df.join(lookup, keys, how)


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """The keys with more than ``hot_rows`` rows, at most the ``HOT_KEYS`` most frequent: no other
    key holds more than 1/``HOT_KEYS`` of the rows. One aggregation, combined map-side."""
    counts = df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > hot_rows)
    top = counts.orderBy(F.desc("__n"), *keys).limit(HOT_KEYS).select(*keys)
    return df.sparkSession.createDataFrame(top.collect(), top.schema)  # at most HOT_KEYS rows


def hot_key_join(df: DataFrame, lookup: DataFrame, keys: list[str], how: str, hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """Equi-join with a lookup of unique keys in which hot keys never meet in one task; exact.

    The hot keys are at most ``HOT_KEYS``, and so are their lookup rows:
    these are broadcast, and the rows of ``df`` with such a key stay where
    they are, as do those with a NULL key, which match nothing. All other
    rows are joined as the optimizer sees fit; none of their keys is hot.
    """
    hot = hot_keys(df, keys, hot_rows)
    marked = df.join(F.broadcast(hot.withColumn("__hot", F.lit(True))), keys, "left")
    null_key = functools.reduce(operator.or_, [F.col(c).isNull() for c in keys])
    apart = F.col("__hot").isNotNull() | null_key
    stay = marked.filter(apart).drop("__hot").join(F.broadcast(lookup.join(F.broadcast(hot), keys, "left_semi")), keys, how)
    return stay.unionByName(marked.filter(~apart).drop("__hot").join(lookup, keys, how))
