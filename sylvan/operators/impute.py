"""Fitted imputation (F22): an estimator whose model fills NULLs with training values.

Fitted on the training part only and saved like any other stage, so rows to
score are filled with what training saw. The model is a projection of
built-in expressions; the fit is two aggregations, whatever the number of
columns.
"""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STRATEGIES = ("mean", "median", "mode")


def _quoted(c: str) -> Column:
    return F.col("`" + c.replace("`", "``") + "`")


def _number(c: str) -> Column:
    """The column as DOUBLE with NaN as NULL."""
    x = _quoted(c).cast("double")
    return F.when(~F.isnan(x), x)


class _FillParams(Params):
    numericCols = Param(Params._dummy(), "numericCols", "numeric columns, filled as DOUBLE", TypeConverters.toListString)
    textCols = Param(Params._dummy(), "textCols", "text columns, filled with the most frequent value", TypeConverters.toListString)
    strategy = Param(Params._dummy(), "strategy", "mean, median or mode of the numeric columns", TypeConverters.toString)
    flagSuffix = Param(Params._dummy(), "flagSuffix", "suffix of 0/1 columns that mark filled rows; empty: none", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(numericCols=[], textCols=[], strategy="mean", flagSuffix="")


class FillMissing(Estimator, _FillParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns a fill value per column: mean, median or mode of numbers, the most frequent text (ties: the least)."""

    @keyword_only
    def __init__(self, *, numericCols=None, textCols=None, strategy=None, flagSuffix=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> FillMissingModel:
        numbers, texts, strategy = (self.getOrDefault(p) for p in (self.numericCols, self.textCols, self.strategy))
        if strategy not in STRATEGIES:
            raise ValueError(f"strategy must be one of {STRATEGIES}")
        fills: dict[str, float | str | None] = {}
        if numbers and strategy != "mode":
            fill = F.avg if strategy == "mean" else lambda x: F.percentile_approx(x, 0.5, 10_000)
            row = df.agg(*[fill(_number(c)).alias(f"f{i}") for i, c in enumerate(numbers)]).first()
            fills |= {c: row[f"f{i}"] for i, c in enumerate(numbers)}
        modal = [(c, True) for c in numbers if strategy == "mode"] + [(c, False) for c in texts]
        if modal:
            fills |= _modes(df, modal)
        model = FillMissingModel()
        model._set(numericCols=numbers, textCols=texts, strategy=strategy, flagSuffix=self.getOrDefault(self.flagSuffix), fills=json.dumps(fills))
        return model._resetUid(self.uid)


def _modes(df: DataFrame, cols: list[tuple[str, bool]]) -> dict:
    """The most frequent value of each (column, is a number), ties to the least: one count of all values, combined map-side."""
    values = F.array(*[
        F.struct(F.lit(i).alias("i"), (_number(c) if number else F.lit(None).cast("double")).alias("x"), (F.lit(None).cast("string") if number else _quoted(c).cast("string")).alias("s"))
        for i, (c, number) in enumerate(cols)
    ])
    counts = df.select(F.explode(values).alias("v")).select("v.*").where("x is not null or s is not null").groupBy("i", "x", "s").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("i").agg(F.min_by(F.struct("x", "s"), F.struct((-F.col("n")).alias("n"), "x", "s")).alias("v")).collect()  # one per column
    found = {r["i"]: r["v"]["x"] if cols[r["i"]][1] else r["v"]["s"] for r in best}
    return {c: found.get(i) for i, (c, _) in enumerate(cols)}


class FillMissingModel(Model, _FillParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fills NULL (and NaN) with the fitted values; a column without any value in training stays as it is."""

    fills = Param(Params._dummy(), "fills", "JSON of column to fill value", TypeConverters.toString)

    def fill_values(self) -> dict:
        return json.loads(self.getOrDefault(self.fills))

    def _transform(self, df: DataFrame) -> DataFrame:
        fills, suffix = self.fill_values(), self.getOrDefault(self.flagSuffix)
        out = {}
        for names, number in ((self.getOrDefault(self.numericCols), True), (self.getOrDefault(self.textCols), False)):
            for c in names:
                value = _number(c) if number else _quoted(c).cast("string")
                out[c] = value if fills.get(c) is None else F.coalesce(value, F.lit(fills[c]))
                if suffix:
                    out[c + suffix] = F.when(value.isNull(), 1.0).otherwise(0.0)
        return df.withColumns(out)
