"""Column expressions shared by the operators (all JVM-side built-ins)."""

from sylvan.functions.columns import (
    array_sum,
    date_parts,
    hash_fraction,
    letter_share,
    max_probability,
    prefix_int,
    safe_ratio,
    vector_item,
    vector_size,
)

__all__ = [
    "array_sum",
    "date_parts",
    "hash_fraction",
    "letter_share",
    "max_probability",
    "prefix_int",
    "safe_ratio",
    "vector_item",
    "vector_size",
]
