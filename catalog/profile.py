"""Profiling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.derived import PREDICTIONS, similar_pairs, simple_predictions
from catalog.views import (
    DOC_PAIRS,
    SCRIPT_PAIRS,
    SIMILARITY_CTES,
    conv_pairs,
    CONV_PAIRS,
    doc_pairs,
    rounded,
    script_pairs,
    table,
    with_sql,
)
from pairscore.operators import profile
from pairscore.operators.quantiles import quantiles
from pairscore.plans.explore import REPORT_QUANTILES, composite_scores


def lengths(spark, sf_dir):
    pairs = doc_pairs(spark, sf_dir)
    return pairs.select(
        "line_no",
        "score",
        F.length("source").alias("hindi_length"),
        F.length("target").alias("chinese_length"),
        (F.length("source") / (F.length("target") + 1)).alias("length_ratio"),
    )


LENGTHS = """lengths AS (
  SELECT line_no, score, length(source) AS hindi_length, length(target) AS chinese_length,
         length(source) / (length(target) + 1) AS length_ratio FROM doc_pairs)"""
NUMBERS = ["score", "hindi_length", "chinese_length", "length_ratio"]


def describe(spark, sf_dir):
    return rounded(profile.describe(lengths(spark, sf_dir), NUMBERS))


def score_quantiles(spark, sf_dir):
    return rounded(quantiles(doc_pairs(spark, sf_dir), "score", REPORT_QUANTILES), skip=("q",))


def events_quantiles(spark, sf_dir):
    """Quantiles of a column with many distinct values, from wide brackets of a small sketch, ranked in many ranges."""
    from pairscore.operators.quantiles import quantile_values

    events = table(spark, sf_dir, "events")
    values = quantile_values(events, {"value": REPORT_QUANTILES}, sketch=100, per_bucket=200)
    rows = [(q, values["value", q]) for q in REPORT_QUANTILES]
    return rounded(spark.createDataFrame(rows, "q double, value double"), skip=("q",))


def null_counts(spark, sf_dir):
    """Documents with their labels, which most lack."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = docs.join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return profile.null_counts(both, ["doc_id", "text", "quality", "toxic"])


def empty_counts(spark, sf_dir):
    return profile.empty_counts(doc_pairs(spark, sf_dir), ["source", "target"])


def empty_counts_scripts(spark, sf_dir):
    """Empty texts among pairs of which some have them."""
    return profile.empty_counts(script_pairs(spark, sf_dir), ["source", "target"])


def duplicate_counts(spark, sf_dir):
    return profile.duplicate_counts(doc_pairs(spark, sf_dir))


def value_range(spark, sf_dir):
    return rounded(profile.value_range(doc_pairs(spark, sf_dir), "score"))


def issue_counts(spark, sf_dir):
    return profile.issue_counts(conv_pairs(spark, sf_dir))


def histogram(spark, sf_dir):
    return rounded(profile.histogram(doc_pairs(spark, sf_dir), "score", 50))


def histogram_lengths(spark, sf_dir):
    return rounded(profile.histogram(lengths(spark, sf_dir), "hindi_length", 50))


def score_length_corr(spark, sf_dir):
    made = lengths(spark, sf_dir)
    both = made.agg(
        profile.pearson(F.col("score"), F.col("hindi_length")).alias("hindi"),
        profile.pearson(F.col("score"), F.col("chinese_length")).alias("chinese"),
    )
    return rounded(both)


def corr_matrix(spark, sf_dir):
    made = composite_scores(similar_pairs(spark, sf_dir))
    names = ["score", "embedding_similarity", "composite_quality_score"]
    return rounded(profile.corr_matrix(made, names))


def share(spark, sf_dir):
    return rounded(profile.share(doc_pairs(spark, sf_dir), F.col("score") > 1.15))


def prediction_range(spark, sf_dir):
    """Range and mean of actual and predicted values, one row each."""
    made = simple_predictions(spark, sf_dir)
    return rounded(profile.describe(made, ["score", "pred_ratio", "pred_overlap"])).select(
        "column", "min", "max", "mean"
    )


def _describe_sql(c: str) -> str:
    return f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
  round(min({c})::DOUBLE, 6) AS min, round(quantile_cont({c}::DOUBLE, 0.25), 6) AS p25,
  round(quantile_cont({c}::DOUBLE, 0.5), 6) AS p50, round(quantile_cont({c}::DOUBLE, 0.75), 6) AS p75,
  round(max({c})::DOUBLE, 6) AS max"""


def _quantile_sql(relation: str, column: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {q}::DOUBLE AS q, round(quantile_cont({column}, {q}), 6) AS value FROM {relation}"
        for q in REPORT_QUANTILES
    )


def _histogram_sql(relation: str, column: str, bins: int) -> str:
    return f"""stats AS (SELECT min({column})::DOUBLE AS low, max({column})::DOUBLE AS high, count(*) AS n,
  (max({column})::DOUBLE - min({column})::DOUBLE) / {bins} AS step FROM {relation}),
guessed AS (
  SELECT {column}::DOUBLE AS x, low, step,
         least(floor(({column} - low) / (high - low) * {bins}), {bins} - 1)::BIGINT AS g FROM {relation}, stats),
placed AS (
  SELECT CASE WHEN x < low + g * step THEN g - 1 WHEN g < {bins} - 1 AND x >= low + (g + 1) * step THEN g + 1 ELSE g END AS bin
  FROM guessed),
counted AS (SELECT bin, count(*) AS found FROM placed GROUP BY bin)"""


def _histogram_select(bins: int) -> str:
    return f"""SELECT b.bin, round(low + b.bin * step, 6) AS bin_start, coalesce(found, 0) AS count,
  round(coalesce(found, 0) / (n * step), 6) AS density
FROM (SELECT unnest(range({bins})) AS bin) b LEFT JOIN counted USING (bin), stats"""


def _corr_sql(names: list[str], relation: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM {relation}"
        for a in names
        for b in names
    )


ENTRIES = {
    "describe": (
        describe,
        with_sql(
            DOC_PAIRS,
            LENGTHS,
            select=" UNION ALL ".join(f"{_describe_sql(c)} FROM lengths" for c in NUMBERS),
        ),
    ),
    "quantiles": (score_quantiles, with_sql(DOC_PAIRS, select=_quantile_sql("doc_pairs", "score"))),
    "quantiles_bracketed": (events_quantiles, _quantile_sql("events", "value")),
    "null_counts": (
        null_counts,
        with_sql(
            "b AS (SELECT d.doc_id, d.text, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))",
            select=" UNION ALL ".join(
                f"""SELECT '{c}' AS "column", count(*) - count({c}) AS missing FROM b"""
                for c in ("doc_id", "text", "quality", "toxic")
            ),
        ),
    ),
    "empty_counts": (
        empty_counts,
        with_sql(
            DOC_PAIRS,
            select=" UNION ALL ".join(
                f"""SELECT '{c}' AS "column", count(*) FILTER ({c} = '') AS empty FROM doc_pairs"""
                for c in ("source", "target")
            ),
        ),
    ),
    "empty_counts_scripts": (
        empty_counts_scripts,
        with_sql(
            DOC_PAIRS,
            SCRIPT_PAIRS,
            select=" UNION ALL ".join(
                f"""SELECT '{c}' AS "column", count(*) FILTER ({c} = '') AS empty FROM script_pairs"""
                for c in ("source", "target")
            ),
        ),
    ),
    "duplicate_counts": (
        duplicate_counts,
        with_sql(
            DOC_PAIRS,
            select="SELECT count(*) - count(DISTINCT source) AS duplicate_source, "
            "count(*) - count(DISTINCT target) AS duplicate_target, "
            "count(*) - count(DISTINCT (source, target)) AS duplicate_pairs FROM doc_pairs",
        ),
    ),
    "value_range": (
        value_range,
        with_sql(
            DOC_PAIRS,
            select="SELECT round(min(score), 6) AS min, round(max(score), 6) AS max, "
            "round(max(score) - min(score), 6) AS range FROM doc_pairs",
        ),
    ),
    "issue_counts": (
        issue_counts,
        with_sql(
            CONV_PAIRS,
            "l AS (SELECT length(source) AS s, length(target) AS t, length(source) / (length(target) + 1) AS r FROM conv_pairs)",
            select="SELECT count(*) FILTER (r > 3) + count(*) FILTER (r < 0.33) AS very_different_lengths, "
            "count(*) FILTER (s < 10) + count(*) FILTER (t < 10) AS very_short, "
            "count(*) FILTER (s > 500) + count(*) FILTER (t > 500) AS very_long FROM l",
        ),
    ),
    "histogram": (
        histogram,
        with_sql(
            DOC_PAIRS, _histogram_sql("doc_pairs", "score", 50), select=_histogram_select(50)
        ),
    ),
    "histogram_lengths": (
        histogram_lengths,
        with_sql(
            DOC_PAIRS,
            LENGTHS,
            _histogram_sql("lengths", "hindi_length", 50),
            select=_histogram_select(50),
        ),
    ),
    "corr": (
        score_length_corr,
        with_sql(
            DOC_PAIRS,
            LENGTHS,
            select="SELECT round(corr(score, hindi_length), 6) AS hindi, round(corr(score, chinese_length), 6) AS chinese FROM lengths",
        ),
    ),
    "corr_matrix": (
        corr_matrix,
        with_sql(
            *SIMILARITY_CTES,
            """n AS (
  SELECT score, e.sim AS embedding_similarity,
         ((score - min(score) OVER ()) / (max(score) OVER () - min(score) OVER ())
          + (e.sim - min(e.sim) OVER ()) / (max(e.sim) OVER () - min(e.sim) OVER ())) / 2 AS composite_quality_score
  FROM doc_pairs p JOIN embedding_sim e USING (line_no))""",
            select=_corr_sql(["score", "embedding_similarity", "composite_quality_score"], "n"),
        ),
    ),
    "share": (
        share,
        with_sql(
            DOC_PAIRS,
            select='SELECT count(*) FILTER (score > 1.15::DOUBLE) AS "rows", '
            "round(count(*) FILTER (score > 1.15::DOUBLE) * 100.0::DOUBLE / count(*), 6) AS percent FROM doc_pairs",
        ),
    ),
    "prediction_range": (
        prediction_range,
        with_sql(
            *PREDICTIONS,
            select=" UNION ALL ".join(
                f"""SELECT '{c}' AS "column", round(min({c}), 6) AS min, round(max({c}), 6) AS max, round(avg({c}), 6) AS mean FROM predictions"""
                for c in ("score", "pred_ratio", "pred_overlap")
            ),
        ),
    ),
}
