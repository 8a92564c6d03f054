"""Standardisation with the population standard deviation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Scaler:
    """Mean and divisor of each column; a column that does not vary has divisor 1."""

    columns: list[str]
    mean: list[float]
    scale: list[float]

    def scaled(self, column: str) -> Column:
        i = self.columns.index(column)
        return (F.col(column) - F.lit(self.mean[i])) / F.lit(self.scale[i])

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: self.scaled(c) for c in self.columns})

    def inverse(self, value: Column, column: str) -> Column:
        i = self.columns.index(column)
        return value * F.lit(self.scale[i]) + F.lit(self.mean[i])


def scaler_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """The fitted numbers as a table: one row ``(column, mean, scale)`` per column."""
    stats = []
    for c in columns:
        x = F.col(c).cast("double")
        stats += [
            F.avg(x).alias(f"mean_{c}"),
            F.when(F.min(x) == F.max(x), F.lit(1.0)).otherwise(F.stddev_pop(x)).alias(f"scale_{c}"),
        ]
    rows = [
        F.struct(
            F.lit(c).alias("column"), F.col(f"mean_{c}").alias("mean"), F.col(f"scale_{c}").alias("scale")
        )
        for c in columns
    ]
    return df.agg(*stats).select(F.inline(F.array(*rows)))


def fit_scaler(df: DataFrame, columns: list[str]) -> Scaler:
    fitted = {r["column"]: r for r in scaler_stats(df, columns).collect()}
    return Scaler(
        list(columns), [fitted[c]["mean"] for c in columns], [fitted[c]["scale"] for c in columns]
    )


def standardize(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns scaled with their own mean and deviation."""
    return fit_scaler(df, columns).transform(df)
