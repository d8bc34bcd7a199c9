"""Fixtures of these tests. Not a conftest: its name would hide the one above."""

import pytest
from pyspark.sql import types as T

DOC = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # extra columns named like those that operators add
    *[T.StructField(n, T.StringType()) for n in ("size", "score", "rank", "_row", "n_lines", "id", "a.b", "uid")],
])
SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"
VEC = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("score", T.StringType())])


@pytest.fixture(scope="session")
def docs(spark):
    """docs([(doc_id, text, lang, source), ...]): a documents table with clashing extra columns."""

    def make(rows):
        full = [(d, t, la, s, None if t is None else len(t), *["x"] * 8) for d, t, la, s in rows]
        return spark.createDataFrame(full, DOC).repartition(3)

    return make


@pytest.fixture(scope="session")
def vectors(spark):
    def make(rows):
        return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "x") for i, v in rows], VEC).repartition(3)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and blank texts, repeated rows, a null id, a long text."""
    long = " ".join(f"word{i % 977} and{i % 31}" for i in range(30_000))
    return [
        (1, None, None, None), (2, "", "en", "s1"), (3, " \t\x0b\n \r", "en", "s1"), (4, "one", "en", None), (5, "one two", None, "s2"),
        (6, "same text here\nand more", "en", "s1"), (6, "same text here\nand more", "en", "s1"), (7, "first", "en", "s1"), (7, "second text", "en", "s1"),
        (None, "no id at all, but words", "en", "s2"), (None, None, None, None), (8, long, "en", "s1"), (9, "漢字 ñandú ÀÉ", "es", "s3"),
        (10, "12345 !!! ---", "en", "s3"),
    ]


def columns(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)
