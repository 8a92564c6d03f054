"""CSV, Parquet and JSON tables of pairs, features, predictions and results."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairscore.schema import CSV_SOURCE, CSV_TARGET, TARGET, feature_schema

# quotes are doubled inside quoted fields, blanks at the ends are kept
CSV_OPTIONS = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
# line breaks inside texts are allowed; "" is an empty text, nothing at all is NULL
CSV_TEXT_OPTIONS = {**CSV_OPTIONS, "multiLine": True, "nullValue": "\u0000"}


def header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a header CSV, without reading the rows."""
    return spark.read.options(**CSV_OPTIONS).csv(path).columns


def feature_names(columns: list[str], target: str = TARGET) -> list[str]:
    """Every column but the target."""
    if target not in columns:
        raise ValueError(f"no target column {target!r} among {columns}")
    return [c for c in columns if c != target]


def read_features(
    spark: SparkSession, path: str, target: str = TARGET, schema: T.StructType | None = None
) -> tuple[DataFrame, list[str]]:
    """A stored feature table and its feature names, from CSV or Parquet."""
    if path.rstrip("/").endswith(".parquet"):
        df = spark.read.parquet(path)
        return df, feature_names(df.columns, target)
    names = feature_names(header(spark, path), target)
    known = schema or feature_schema(names, target)
    # numbers only: a CSV file without line breaks in fields can be split
    df = spark.read.schema(known).options(header=True, enforceSchema=False).csv(path)
    return df, names


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet if the path says so, else CSV whose columns are all text."""
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    return spark.read.options(**CSV_TEXT_OPTIONS).csv(path)


def read_pairs(
    spark: SparkSession, path: str, source: str = CSV_SOURCE, target: str = CSV_TARGET
) -> DataFrame:
    """A scoring CSV; both text columns are required, others pass through as text.

    Texts may contain line breaks, so one file is one task: give large inputs as
    many files, or as Parquet.
    """
    df = read_table(spark, path)
    missing = [c for c in (source, target) if c not in df.columns]
    if missing:
        raise ValueError(f"the file must have the columns {source!r} and {target!r}")
    return df


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "error") -> None:
    """Parquet by default; ``csv`` writes a header and quotes what needs it."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer.options(**CSV_OPTIONS).csv(path)
    else:
        writer.format(fmt).save(path)


def write_params(
    spark: SparkSession, path: str, model: str, best_params: dict, best_cv_rmse: float
) -> None:
    """The result of a search as one JSON object."""
    found = {"model": model, "best_params": best_params, "best_cv_rmse": float(best_cv_rmse)}
    spark.createDataFrame([(json.dumps(found),)], "value string").coalesce(1).write.text(path)


def read_params(spark: SparkSession, path: str) -> dict:
    """A stored search: ``model``, ``best_params``, ``best_cv_rmse``.

    ``best_params`` is an object; a string that holds one is read as well.
    """
    found = json.loads(spark.read.text(path, wholetext=True).where("trim(value) <> ''").first()["value"])
    params = found["best_params"]
    return {**found, "best_params": json.loads(params) if isinstance(params, str) else params}


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Model metrics as JSON lines ``{model, rmse, mae, r2, ...}``, one per model."""
    metrics.groupBy("model").pivot("metric").agg(F.first("value")).write.json(path)


def read_metrics(spark: SparkSession, path: str, metrics: list[str]) -> DataFrame:
    fields = ", ".join(f"{m} double" for m in metrics)
    wide = spark.read.schema(f"model string, {fields}").json(path)
    return wide.unpivot(["model"], metrics, "metric", "value")
