"""Row selection: training rows, quantile cuts, ranks, previews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairscore.operators.quantiles import quantile_values
from pairscore.schema import FEATURES, TARGET


def head_lines(df: DataFrame, n: int, key: str = "line_no") -> DataFrame:
    """The first n lines, by line number and not by whichever partition answers first."""
    return df.filter(F.col(key) < n)


def select_training(
    df: DataFrame, features: list[str] = FEATURES, target: str = TARGET, keep: list[str] = ()
) -> DataFrame:
    """Features and target only, without rows that lack a value (infinity is a value)."""
    wanted = [*features, target]
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")
    return df.select(*keep, *wanted).na.drop(subset=wanted)


def filter_top_quantile(df: DataFrame, column: str, q: float) -> DataFrame:
    """Rows at or above the q-quantile."""
    return df.filter(F.col(column) >= F.lit(quantile_values(df, {column: [q]})[column, q]))


def filter_above_quantile(df: DataFrame, column: str, q: float) -> DataFrame:
    """Rows strictly above the q-quantile."""
    return df.filter(F.col(column) > F.lit(quantile_values(df, {column: [q]})[column, q]))


def filter_below_quantile(df: DataFrame, column: str, q: float) -> DataFrame:
    """Rows strictly below the q-quantile."""
    return df.filter(F.col(column) < F.lit(quantile_values(df, {column: [q]})[column, q]))


def filter_low_quality(
    df: DataFrame, threshold: float, score: str = "predicted_score"
) -> DataFrame:
    """Drop the pairs whose predicted score lies below the threshold."""
    return df.filter(F.col(score) >= threshold)


def top_k(df: DataFrame, column: str, k: int, key: str = "line_no") -> DataFrame:
    """The k largest values; ties in input order."""
    return df.orderBy(F.col(column).desc_nulls_last(), F.col(key)).limit(k)


def bottom_k(df: DataFrame, column: str, k: int, key: str = "line_no") -> DataFrame:
    """The k smallest values; ties in input order."""
    return df.orderBy(F.col(column).asc_nulls_last(), F.col(key)).limit(k)


def preview(
    df: DataFrame, n: int, width: int, texts: list[str], key: str = "line_no"
) -> DataFrame:
    """First n rows with the texts cut for display."""
    cut = {c: F.substring(c, 1, width) for c in texts}
    return df.orderBy(key).limit(n).withColumns(cut)


def ensure_columns(df: DataFrame, expressions: dict[str, Column]) -> DataFrame:
    """Add the columns that are not there yet; leave the others as they are."""
    return df.withColumns({c: e for c, e in expressions.items() if c not in df.columns})


def fill_signal_defaults(df: DataFrame, defaults: dict[str, float]) -> DataFrame:
    """Stand-ins for missing signals, and ``signals_filled`` = how many a row needed."""
    missing = {c: F.col(c).isNull() | F.isnan(c) for c in defaults}
    filled = sum((m.cast("int") for m in missing.values()), F.lit(0))
    # the count reads the old values, so it comes in the same projection
    return df.withColumns(
        {
            "signals_filled": filled,
            **{c: F.when(missing[c], F.lit(v)).otherwise(F.col(c)) for c, v in defaults.items()},
        }
    )
