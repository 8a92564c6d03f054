"""Numeric expressions derived from lengths, signals and predictions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Guards, weights and band limits.
EPSILON = 1e-8
COMPOSITE_WEIGHTS = (0.6, 0.4)
INTERVAL_SHARE = 0.1
INTERVAL_Z = 1.96
SCORE_BANDS = [(1.20, "strong"), (1.15, "good"), (1.10, "moderate")]
CORR_BANDS = [(0.7, "strong"), (0.5, "moderate")]


def interaction_features(
    embedding: Column, labse: Column, perplexity: Column, length_ratio: Column, target_length: Column
) -> dict[str, Column]:
    """The row-wise features built from the three signals and the lengths."""
    return {
        "chinese_fluency": F.lit(1.0) / (perplexity + F.lit(1.0)),
        "embedding_labse_interaction": embedding * labse,
        "similarity_avg": (embedding + labse) / F.lit(2.0),
        "similarity_diff": F.abs(embedding - labse),
        "embedding_similarity_squared": embedding * embedding,
        "labse_similarity_squared": labse * labse,
        "similarity_ratio": embedding / F.nullif(labse + F.lit(EPSILON), F.lit(0.0)),
        "length_similarity_interaction": length_ratio * embedding,
        "length_perplexity_interaction": target_length * perplexity,
        "length_perplexity_ratio": target_length
        / F.nullif(perplexity + F.lit(EPSILON), F.lit(0.0)),
    }


def guarded_minmax(x: Column, low: Column, high: Column) -> Column:
    """(x - min) / (max - min + epsilon): never divides by zero."""
    return (x - low) / (high - low + F.lit(EPSILON))


def minmax(x: Column, low: Column, high: Column) -> Column:
    """(x - min) / (max - min), NULL when max = min."""
    return (x - low) / F.nullif((high - low).cast("double"), F.lit(0.0))


def composite(a: Column, b: Column, weights: tuple[float, float] | None = None) -> Column:
    """Mean of two normalised scores, or their weighted sum."""
    if weights is None:
        return (a + b) / F.lit(2.0)
    return F.lit(weights[0]) * a + F.lit(weights[1]) * b


def interval(prediction: Column) -> tuple[Column, Column]:
    """Lower and upper end of the rough 95 % interval around a prediction."""
    spread = F.lit(INTERVAL_Z) * (F.lit(INTERVAL_SHARE) * F.abs(prediction))
    return prediction - spread, prediction + spread


def _band(value: Column, bands: list[tuple[float, str]], otherwise: str) -> Column:
    expr = F.when(value > bands[0][0], bands[0][1])
    for limit, name in bands[1:]:
        expr = expr.when(value > limit, name)
    return expr.otherwise(otherwise)


def score_band(score: Column) -> Column:
    return _band(score, SCORE_BANDS, "lower")


def corr_band(rho: Column) -> Column:
    return _band(F.abs(rho), CORR_BANDS, "weak")


def r2_verdict(r2: Column) -> Column:
    return F.when(r2 > 0, "better than mean").otherwise("worse than mean")
