"""Column expressions: dates, prefixes, hashes, vectors.

Everything here returns a ``Column`` built from ``pyspark.sql.functions``
so it stays inside whole-stage codegen; there are no Python UDFs.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

# Range of the 32 bits that a key hash takes.
HASH_MODULUS = 4294967296  # 2**32


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """``num / den`` as DOUBLE; NULL when the denominator is 0 (ANSI-safe)."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


def date_parts(
    c: str | Column,
    suffix: str = "",
    fmt: str | None = None,
    names: tuple[str, str, str] = ("dayofmonth", "month", "year"),
) -> dict[str, Column]:
    """Day of month, month and year of a date string or timestamp.

    Parsing uses ``try_to_date`` so malformed input gives NULL instead of
    failing the job under ANSI mode. With pattern ``yy`` Spark maps
    two-digit years to 2000-2099.
    """
    src = _col(c)
    d = F.try_to_date(src, fmt) if fmt else F.try_to_date(src)
    day, month, year = names
    return {
        f"{day}{suffix}": F.dayofmonth(d),
        f"{month}{suffix}": F.month(d),
        f"{year}{suffix}": F.year(d),
    }


def prefix_int(c: str | Column, sep: str = "S") -> Column:
    """Integer after a prefix, e.g. ``"S123" -> 123`` (F15); NULL if absent."""
    return F.get(F.split(_col(c), sep), 1).try_cast("int")


def hash_fraction(key: str | Column, purpose: str) -> Column:
    """Deterministic value in [0, 1) from a key of any type; stable under repartitioning.

    The first 32 bits of ``md5(purpose:key)``, which plain SQL can
    reproduce. Fractions of different purposes (split, undersample, folds)
    are independent of each other. A NULL key hashes like an empty text, so
    its rows land somewhere.
    """
    text = F.concat(F.lit(f"{purpose}:"), F.coalesce(_col(key).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long").cast("double") / F.lit(float(HASH_MODULUS))


def letter_share(text: str | Column, n_chars: str | Column | None = None) -> Column:
    """Share of Unicode letters in a text (a simple quality signal)."""
    t = _col(text)
    total = F.length(t) if n_chars is None else _col(n_chars)
    letters = F.length(F.regexp_replace(t, r"[^\p{L}]", ""))
    return safe_ratio(letters, total)


def vector_item(v: str | Column, i: int) -> Column:
    """One slot of an ML vector (F18) without a UDF."""
    return vector_to_array(_col(v))[i]


def vector_size(v: str | Column) -> Column:
    return F.size(vector_to_array(_col(v)))


def array_sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x)


def max_probability(prob: str | Column) -> Column:
    """Largest class probability of a prediction row."""
    return F.array_max(vector_to_array(_col(prob)))
