"""Scoring new pairs and evaluating models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairscore.operators import signals
from pairscore.operators.filters import fill_signal_defaults
from pairscore.operators.metrics import metrics_by_split, regression_aggregates, system_compare
from pairscore.operators.ranks import rank_within
from pairscore.operators.regress import with_interval
from pairscore.plans.features import derived_features, signal_features, text_features
from pairscore.schema import PAIRS, SCORING_DEFAULTS, TARGET, PairColumns
from pairscore.session import materialize


def score_pairs(
    df: DataFrame,
    pipeline,
    cols: PairColumns = PAIRS,
    keep_features: bool = False,
    **loaders,
) -> DataFrame:
    """``df`` with predicted score and interval, by the feature code used in training.

    One lazy plan without a shuffle: everything fitted enters as a literal or a
    broadcast.  A row whose signals are missing gets the scoring defaults and
    ``signals_filled`` > 0.
    """
    with_signals = signal_features(df, pipeline.lm, cols, **loaders)
    filled = fill_signal_defaults(with_signals, SCORING_DEFAULTS)
    made = derived_features(text_features(filled, cols)).withColumn(
        "length_ratio_normalized", pipeline.ratio_range.normalized()
    )
    scored = with_interval(pipeline.fitted.predict(made))
    if keep_features:
        return scored
    added = ["signals_filled", "predicted_score", "confidence_lower", "confidence_upper"]
    return scored.select(*df.columns, *added)


def evaluate(df: DataFrame, models: dict, target: str = TARGET) -> DataFrame:
    """``df`` with ``pred_<name>`` and ``err_<name>`` for every model."""
    for name, model in models.items():
        df = model.predict(df, f"pred_{name}")
        df = df.withColumn(f"err_{name}", F.col(f"pred_{name}") - F.col(target))
    return df


def evaluation_metrics(evaluated: DataFrame, names: list[str], target: str = TARGET) -> DataFrame:
    """``(model, metric, value)`` for rmse, mae and r2 of every model, in one pass."""
    aggs = [
        e.alias(f"{name}:{m}")
        for name in names
        for m, e in regression_aggregates(F.col(target), F.col(f"pred_{name}")).items()
    ]
    wide = evaluated.agg(*aggs)
    long = wide.unpivot([], wide.columns, "name", "value")
    parts = F.split("name", ":")
    return long.select(parts[0].alias("model"), parts[1].alias("metric"), "value")


def evaluate_splits(df: DataFrame, models: dict, target: str = TARGET) -> DataFrame:
    """Metrics of every model on every split of ``df``; the models run once."""
    predictions = {m: f"pred_{m}" for m in models}
    evaluated = evaluate(df, models, target).select("split", target, *predictions.values())
    return metrics_by_split(materialize(evaluated, "evaluated"), target, predictions)


def compare_systems(
    outputs: DataFrame,
    pipeline,
    cols: PairColumns = PAIRS,
    system: str = "system",
    group: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Mean score per system, and the systems ranked for each source; scored once."""
    scored = materialize(score_pairs(outputs, pipeline, cols), "system-scores")
    ranked = rank_within(scored, group or cols.source, "predicted_score", system)
    return system_compare(scored, system), ranked


def evaluate_translator(
    sources: DataFrame, loader, pipeline, cols: PairColumns = PAIRS
) -> DataFrame:
    """Translate every source with a user function and score the pairs."""
    translated = signals.apply_translator(sources, loader, cols.source, cols.target)
    return score_pairs(translated, pipeline, cols)
