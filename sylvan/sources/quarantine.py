"""CSV scans that set bad rows apart.

The plain reader turns a bad field into NULL, or fails the job. Here a row
that does not fit the schema goes to a table of rejected lines with its file
and a reason, and only whole rows reach the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sylvan.session import scratch_path

LINE, FILE, FITS = "_rejected_line", "_file", "_fits"


def read_csv_checked(
    spark: SparkSession, paths: str | list[str], schema: T.StructType | str, header: bool = True, sep: str = ",", escape: str = '"'
) -> tuple[DataFrame, DataFrame]:
    """(rows that fit ``schema``, rejected lines as ``file, line, reason``); one line is one row.

    One permissive scan writes both as Parquet below the shared scratch
    folder: all fields of a row are parsed there, so it is rejected for any
    bad one whatever columns are used later (a CSV scan judges only the
    fields it is asked for). ``escape`` marks a quote inside quotes (default:
    it is doubled).
    """
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if {LINE, FILE, FITS} & set(fields.names):
        raise ValueError(f"{LINE}, {FILE} and {FITS} are taken")
    reader = spark.read.schema(T.StructType(fields.fields + [T.StructField(LINE, T.StringType())]))
    reader = reader.options(header=header, sep=sep, escape=escape, mode="PERMISSIVE", columnNameOfCorruptRecord=LINE)
    rows = reader.csv(paths).withColumns({FILE: F.col("_metadata.file_path"), FITS: F.col(LINE).isNull()})
    path = scratch_path(spark, "csv-checked")
    rows.write.partitionBy(FITS).parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)
    clean = rows.where(FITS).select(*[F.col("`" + c.replace("`", "``") + "`") for c in fields.names])
    rejected = rows.where(~F.col(FITS)).select(F.col(FILE).alias("file"), F.col(LINE).alias("line"))
    return clean, rejected.withColumn("reason", _reason(F.col("line"), fields, sep, escape))


def _reason(line: Column, fields: T.StructType, sep: str, escape: str) -> Column:
    """Too few or too many fields, else the first column whose text is not of its type."""
    bare = F.regexp_replace(line, r'"(?:[^"\\]|\\.|"")*"', "")
    found = (F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit("")))) / len(sep) + 1
    texts = F.from_csv(line, ", ".join(f"c{i} string" for i in range(len(fields))), {"sep": sep, "escape": escape, "mode": "PERMISSIVE"})
    reason = F.when(found < len(fields), "too few fields").when(found > len(fields), "too many fields")
    for i, f in enumerate(fields):
        value = texts[f"c{i}"]
        reason = reason.when(value.isNotNull() & value.try_cast(f.dataType).isNull(), f"bad value in {f.name}")
    return reason.otherwise("malformed")


def rejected_counts(rejected: DataFrame) -> DataFrame:
    """Rejected lines per file and reason."""
    return rejected.groupBy("file", "reason").agg(F.count(F.lit(1)).alias("n"))
