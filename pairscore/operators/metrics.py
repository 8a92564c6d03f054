"""Metrics of predictions and the tables made from them.

Long form throughout: one row ``(model, split, metric, value)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairscore.operators.profile import pearson
from pairscore.operators.ranks import spearman, spearman_by

REGRESSION_METRICS = ["mae", "rmse", "r2"]


def regression_aggregates(y: Column, pred: Column) -> dict[str, Column]:
    """MAE, RMSE and R2 as aggregate expressions of one pass.

    R2 of a constant target is 1 for perfect predictions and 0 otherwise.
    """
    error = pred - y
    squared = F.sum(error * error)
    total = F.var_pop(y) * F.count(y)
    r2 = (
        F.when(F.min(y) < F.max(y), F.lit(1.0) - squared / F.nullif(total, F.lit(0.0)))
        .when(squared == 0, F.lit(1.0))
        .otherwise(F.lit(0.0))
    )
    return {
        "mae": F.avg(F.abs(error)),
        "rmse": F.sqrt(F.avg(error * error)),
        "r2": r2,
    }


def regression_metrics(df: DataFrame, y: str, pred: str) -> DataFrame:
    """One row with mae, rmse and r2."""
    aggs = regression_aggregates(F.col(y), F.col(pred))
    return df.agg(*[e.alias(m) for m, e in aggs.items()])


def rank_metrics(df: DataFrame, y: str, pred: str) -> DataFrame:
    """One row with the Pearson and the Spearman correlation."""
    linear = df.agg(pearson(F.col(y), F.col(pred)).alias("pearson"))
    ranked = spearman(df, y, pred)
    return linear.select("pearson", ranked.select("spearman").scalar().alias("spearman"))


def metrics_by_split(
    df: DataFrame, y: str, predictions: dict[str, str], split: str = "split"
) -> DataFrame:
    """Metrics of several models per split, with correlations for the test split.

    ``predictions`` maps a model name to its prediction column.  All models and
    splits come out of one aggregation over the data, and one rank pass.
    """
    aggs = [
        e.alias(f"{model}:{m}")
        for model, pred in predictions.items()
        for m, e in regression_aggregates(F.col(y), F.col(pred)).items()
    ]
    wide = df.groupBy(split).agg(*aggs)
    names = [f"{model}:{m}" for model in predictions for m in REGRESSION_METRICS]
    long = wide.unpivot([split], names, "name", "value")
    parts = F.split("name", ":")
    result = long.select(
        parts[0].alias("model"), F.col(split).alias("split"), parts[1].alias("metric"), "value"
    )
    test = df.filter(F.col(split) == "test")
    linear = test.agg(*[pearson(F.col(y), F.col(pred)).alias(model) for model, pred in predictions.items()])
    linear = linear.unpivot([], list(predictions), "model", "pearson")
    # all models are ranked together, as one long table
    each = [F.struct(F.lit(m).alias("model"), F.col(p).cast("double").alias("pred")) for m, p in predictions.items()]
    long = test.select(F.col(y).alias("y"), F.explode(F.array(*each)).alias("m")).select("m.model", "y", "m.pred")
    ranked = linear.join(spearman_by(long, "model", "y", "pred"), "model", "left")
    correlations = ranked.unpivot(["model"], ["pearson", "spearman"], "metric", "value")
    result = result.unionByName(correlations.select("model", F.lit("test").alias("split"), "metric", "value"))
    return result


def best_model(
    metrics: DataFrame, order: Sequence[str], metric: str = "mae", split: str = "test"
) -> DataFrame:
    """The model with the smallest value; the first in ``order`` wins a tie."""
    ordinal = F.array_position(F.array(*[F.lit(m) for m in order]), F.col("model"))
    rows = metrics.filter((F.col("metric") == metric) & (F.col("split") == split))
    return rows.agg(
        F.min_by("model", F.struct("value", ordinal)).alias("model"), F.min("value").alias("value")
    )


def sort_metrics(metrics: DataFrame, metric: str = "mae", split: str = "test") -> DataFrame:
    """Comparison table: one row per model, sorted by one of its metrics."""
    wide = (
        metrics.filter(F.col("split") == split)
        .groupBy("model")
        .pivot("metric", [*REGRESSION_METRICS, "pearson", "spearman"])
        .agg(F.first("value"))
    )
    return wide.orderBy(metric, "model")


def metrics_transpose(
    metrics: DataFrame, models: Sequence[str], split: str = "test"
) -> DataFrame:
    """Metrics as rows and models as columns."""
    return (
        metrics.filter(F.col("split") == split)
        .groupBy("metric")
        .pivot("model", list(models))
        .agg(F.first("value"))
    )


def fold_average(folds: DataFrame, by: str = "params") -> DataFrame:
    """Mean RMSE and MAE over the folds of each parameter set."""
    return folds.groupBy(by).agg(
        F.avg("rmse").alias("mean_rmse"), F.avg("mae").alias("mean_mae"), F.count("*").alias("folds")
    )


def system_compare(
    scored: DataFrame, system: str = "system", score: str = "predicted_score"
) -> DataFrame:
    """Average predicted score and number of pairs per translation system."""
    return scored.groupBy(system).agg(
        F.avg(score).alias("mean_score"), F.count(F.lit(1)).alias("pairs")
    )


def split_sizes(df: DataFrame, split: str = "split") -> DataFrame:
    return df.groupBy(split).agg(F.count(F.lit(1)).alias("rows"))


def training_summary(
    df: DataFrame, features: Sequence[str], metrics: DataFrame, order: Sequence[str]
) -> DataFrame:
    """Size, features, split sizes, test metrics and best model as ``(item, value, text)``."""

    def row(item: Column, value: Column, text: Column) -> list[Column]:
        return [item.alias("item"), value.cast("double").alias("value"), text.alias("text")]

    nothing = F.lit(None).cast("string")
    sizes = split_sizes(df)
    test = metrics.filter(F.col("split") == "test")
    winner = best_model(metrics, order)
    return (
        sizes.agg(F.sum("rows").alias("n"))
        .select(*row(F.lit("dataset size"), F.col("n"), nothing))
        .union(
            df.sparkSession.createDataFrame(
                [("features", float(len(features)), None)],
                "item string, value double, text string",
            )
        )
        .union(
            sizes.select(*row(F.concat(F.lit("split "), "split"), F.col("rows"), nothing))
        )
        .union(test.select(*row(F.concat("model", F.lit(" "), "metric"), F.col("value"), nothing)))
        .union(winner.select(*row(F.lit("best model"), F.col("value"), F.col("model"))))
    )
