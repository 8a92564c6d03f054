"""Exploration of a scored corpus: composite scores, disagreement, and a report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairscore.functions.derived import COMPOSITE_WEIGHTS, composite, minmax
from pairscore.operators import profile
from pairscore.operators.joins import scalar
from pairscore.operators.quantiles import quantile_values, quantiles
from pairscore.schema import PAIRS, PairColumns

# The quantiles of the score report.
REPORT_QUANTILES = [0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99]


def composite_scores(
    df: DataFrame, score: str = "score", similarity: str = "embedding_similarity"
) -> DataFrame:
    """Both scores on [0, 1], their mean, their weighted sum, and how far they disagree.

    The four bounds come from one pass, read as scalar subqueries.
    """
    bounds = df.agg(
        F.min(score).alias("score_low"),
        F.max(score).alias("score_high"),
        F.min(similarity).alias("sim_low"),
        F.max(similarity).alias("sim_high"),
    )
    normal = df.withColumns(
        {
            "ccmatrix_normalized": minmax(
                F.col(score), scalar(bounds, "score_low"), scalar(bounds, "score_high")
            ),
            "embedding_normalized": minmax(
                F.col(similarity), scalar(bounds, "sim_low"), scalar(bounds, "sim_high")
            ),
        }
    )
    a, b = F.col("ccmatrix_normalized"), F.col("embedding_normalized")
    return normal.withColumns(
        {
            "composite_quality_score": composite(a, b),
            "composite_quality_score_weighted": composite(a, b, COMPOSITE_WEIGHTS),
            "metric_disagreement": F.abs(a - b),
        }
    )


def corpus_report(df: DataFrame, cols: PairColumns = PAIRS, bins: int = 50) -> dict[str, DataFrame]:
    """The tables of a first look at a corpus, by name."""
    lengths = df.withColumns(
        {
            "hindi_length": F.length(cols.source),
            "chinese_length": F.length(cols.target),
            "length_ratio": F.length(cols.source) / (F.length(cols.target) + F.lit(1)),
        }
    )
    numbers = [cols.score, "hindi_length", "chinese_length", "length_ratio"]
    texts = [cols.source, cols.target]
    return {
        "describe": profile.describe(lengths, numbers),
        "missing": profile.null_counts(df, [*texts, cols.score]),
        "empty": profile.empty_counts(df, texts),
        "duplicates": profile.duplicate_counts(df, *texts),
        "issues": profile.issue_counts(df, *texts),
        "range": profile.value_range(df, cols.score),
        "quantiles": quantiles(df, cols.score, REPORT_QUANTILES),
        "histogram": profile.histogram(df, cols.score, bins),
        "correlations": profile.corr_matrix(lengths, numbers),
    }


def disagreement_report(scored: DataFrame) -> dict[str, DataFrame]:
    """Thresholds, share and distribution of the disagreement of two metrics."""
    limits = quantile_values(scored, {"metric_disagreement": [0.95, 0.99]})
    high = F.col("metric_disagreement") > F.lit(limits["metric_disagreement", 0.95])
    return {
        "describe": profile.describe(scored, ["metric_disagreement"]),
        "thresholds": scored.sparkSession.createDataFrame(
            [(q, v) for (_, q), v in limits.items()], "q double, value double"
        ),
        "share": profile.share(scored, high),
        "cases": scored.filter(high),
    }
