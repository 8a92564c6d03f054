"""Derived numbers, bands, filters and previews."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.views import (
    DOC_PAIRS,
    SIMILARITY_CTES,
    doc_pairs,
    rounded,
    table,
    text_features_sql,
    with_sql,
)
from pairscore.functions import derived
from pairscore.operators import filters, signals
from pairscore.operators.joins import scalar
from pairscore.operators.metrics import regression_aggregates
from pairscore.operators.profile import corr, share
from pairscore.operators.regress import with_interval
from pairscore.plans.explore import composite_scores
from pairscore.plans.features import ratio_bounds, text_features
from pairscore.schema import SCORING_DEFAULTS
from pairscore.session import materialize


def text_pairs(spark, sf_dir):
    """Pairs with their length features only: lengths, words and characters."""
    return text_features(doc_pairs(spark, sf_dir))


def similar_pairs(spark, sf_dir):
    """Written once, so that the passes that follow do not run the encoder again."""
    pairs = signals.similarity(doc_pairs(spark, sf_dir))
    return materialize(pairs.select("line_no", "score", "embedding_similarity"), "similar-pairs")


def simple_predictions(spark, sf_dir):
    """Two plain predictors of the score, so that metrics can be checked in SQL."""
    pairs = text_features(doc_pairs(spark, sf_dir))
    return pairs.select(
        "line_no",
        "score",
        (F.lit(1.06) + F.lit(0.18) * F.least("length_ratio", F.lit(1.0))).alias("pred_ratio"),
        (F.lit(1.06) + F.lit(0.18) * F.col("char_alignment")).alias("pred_overlap"),
    )


PREDICTIONS = (
    DOC_PAIRS,
    text_features_sql("doc_pairs"),
    """predictions AS (
  SELECT line_no, score, 1.06::DOUBLE + 0.18::DOUBLE * least(length_ratio, 1.0::DOUBLE) AS pred_ratio,
         1.06::DOUBLE + 0.18::DOUBLE * char_alignment AS pred_overlap FROM text_features)""",
)


def length_ratio_normalized(spark, sf_dir):
    pairs = doc_pairs(spark, sf_dir)
    low, high = ratio_bounds(pairs)
    ratio = F.length("source") / (F.length("target") + 1)
    return pairs.select(
        "line_no", derived.guarded_minmax(ratio, low, high).alias("length_ratio_normalized")
    )


def scalar_attach(spark, sf_dir):
    """Global minimum, maximum and mean next to every score."""
    pairs = doc_pairs(spark, sf_dir)
    stats = pairs.agg(
        F.min("score").alias("low"), F.max("score").alias("high"), F.avg("score").alias("mean")
    )
    return rounded(
        pairs.select("line_no", *[scalar(stats, c).alias(c) for c in ("low", "high", "mean")])
    )


def minmax_normalize(spark, sf_dir):
    pairs = doc_pairs(spark, sf_dir)
    stats = pairs.agg(F.min("score").alias("low"), F.max("score").alias("high"))
    normal = derived.minmax(F.col("score"), scalar(stats, "low"), scalar(stats, "high"))
    return rounded(pairs.select("line_no", normal.alias("normalized")))


def composite_quality_score(spark, sf_dir):
    return rounded(
        composite_scores(similar_pairs(spark, sf_dir)).select(
            "line_no", "composite_quality_score", "composite_quality_score_weighted"
        )
    )


def metric_disagreement(spark, sf_dir):
    return rounded(
        composite_scores(similar_pairs(spark, sf_dir)).select("line_no", "metric_disagreement")
    )


def high_disagreement(spark, sf_dir):
    """Cases above the 95th percentile, with the share they make."""
    made = composite_scores(similar_pairs(spark, sf_dir))
    return rounded(
        filters.filter_above_quantile(made, "metric_disagreement", 0.95).select(
            "line_no", "metric_disagreement"
        )
    )


def high_disagreement_share(spark, sf_dir):
    made = composite_scores(similar_pairs(spark, sf_dir))
    limit = filters.quantile_values(made, {"metric_disagreement": [0.95]})
    return rounded(share(made, F.col("metric_disagreement") > limit["metric_disagreement", 0.95]))


def top_disagreement(spark, sf_dir):
    made = composite_scores(similar_pairs(spark, sf_dir))
    return rounded(
        filters.top_k(made, "metric_disagreement", 30).select("line_no", "metric_disagreement")
    )


def lowest_similarity(spark, sf_dir):
    """The first ten pairs strictly below the 5th percentile of normalised similarity."""
    made = composite_scores(similar_pairs(spark, sf_dir))
    low = filters.filter_below_quantile(made, "embedding_normalized", 0.05)
    return rounded(low.orderBy("line_no").limit(10).select("line_no", "embedding_normalized"))


def prediction_error(spark, sf_dir):
    made = simple_predictions(spark, sf_dir)
    return made.select(
        "line_no",
        (F.col("pred_ratio") - F.col("score")).alias("err_ratio"),
        (F.col("pred_overlap") - F.col("score")).alias("err_overlap"),
    )


def score_interval(spark, sf_dir):
    made = with_interval(simple_predictions(spark, sf_dir), "pred_ratio")
    return made.select("line_no", "pred_ratio", "confidence_lower", "confidence_upper")


def score_band(spark, sf_dir):
    bands = doc_pairs(spark, sf_dir).select("line_no", derived.score_band(F.col("score")).alias("band"))
    return bands


def corr_band(spark, sf_dir):
    made = simple_predictions(spark, sf_dir)
    return (
        corr(made, "score", "pred_ratio", "rho")
        .select(derived.corr_band(F.col("rho")).alias("band"), F.round("rho", 6).alias("rho"))
    )


def r2_verdict(spark, sf_dir):
    """Whether two simple predictors beat the mean."""
    made = simple_predictions(spark, sf_dir)
    names = ["pred_ratio", "pred_overlap"]
    r2 = [regression_aggregates(F.col("score"), F.col(n))["r2"].alias(n) for n in names]
    long = made.agg(*r2).unpivot([], names, "model", "r2")
    return long.select("model", F.round("r2", 6).alias("r2"), derived.r2_verdict(F.col("r2")).alias("verdict"))


def fill_signal_defaults(spark, sf_dir):
    """Similarity kept for labelled documents only, the other signals missing throughout."""
    labelled = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("line_no"), "quality")
    signals_of = similar_pairs(spark, sf_dir).join(labelled, "line_no", "left")
    seen = F.col("quality").isNotNull()
    holes = signals_of.select(
        "line_no",
        F.when(seen, F.col("embedding_similarity")).alias("embedding_similarity"),
        F.when(F.col("quality") == 1, F.col("embedding_similarity")).alias("labse_similarity"),
        F.lit(None).cast("double").alias("chinese_perplexity"),
    )
    return rounded(filters.fill_signal_defaults(holes, SCORING_DEFAULTS))


def ensure_columns(spark, sf_dir):
    pairs = doc_pairs(spark, sf_dir)
    lengths = {"source_length": F.length("source"), "score": F.lit(0.0)}
    return rounded(
        filters.ensure_columns(pairs, lengths).select("line_no", "source_length", "score")
    )


def preview(spark, sf_dir):
    pairs = doc_pairs(spark, sf_dir).select("line_no", "source", "target")
    return filters.preview(pairs, 10, 200, ["source", "target"])


def head_lines(spark, sf_dir):
    return rounded(filters.head_lines(doc_pairs(spark, sf_dir), 100).select("line_no", "score"))


def filter_top_quantile(spark, sf_dir):
    pairs = doc_pairs(spark, sf_dir)
    return rounded(filters.filter_top_quantile(pairs, "score", 0.95).select("line_no", "score"))


def filter_below_quantile(spark, sf_dir):
    pairs = doc_pairs(spark, sf_dir)
    return rounded(filters.filter_below_quantile(pairs, "score", 0.05).select("line_no", "score"))


def filter_low_quality(spark, sf_dir):
    made = simple_predictions(spark, sf_dir)
    return filters.filter_low_quality(made, 1.15, "pred_ratio").select("line_no", "pred_ratio")


def top_k(spark, sf_dir):
    return rounded(filters.top_k(doc_pairs(spark, sf_dir), "score", 10).select("line_no", "score"))


def bottom_k(spark, sf_dir):
    return rounded(
        filters.bottom_k(doc_pairs(spark, sf_dir), "score", 10).select("line_no", "score")
    )


COMPOSITE = (
    *SIMILARITY_CTES,
    """normalized AS (
  SELECT p.line_no, (score - min(score) OVER ()) / (max(score) OVER () - min(score) OVER ()) AS a,
         (e.sim - min(e.sim) OVER ()) / (max(e.sim) OVER () - min(e.sim) OVER ()) AS b
  FROM doc_pairs p JOIN embedding_sim e USING (line_no)),
composite AS (
  SELECT *, (a + b) / 2 AS composite_quality_score, 0.6::DOUBLE * a + 0.4::DOUBLE * b AS composite_quality_score_weighted,
         abs(a - b) AS metric_disagreement FROM normalized)""",
)

ENTRIES = {
    "length_ratio_normalized": (
        length_ratio_normalized,
        with_sql(
            DOC_PAIRS,
            "r AS (SELECT line_no, length(source) / (length(target) + 1) AS x FROM doc_pairs)",
            select="SELECT line_no, (x - min(x) OVER ()) / (max(x) OVER () - min(x) OVER () + 1e-8::DOUBLE) "
            "AS length_ratio_normalized FROM r",
        ),
    ),
    "scalar_attach": (
        scalar_attach,
        with_sql(
            DOC_PAIRS,
            select="SELECT line_no, round(min(score) OVER (), 6) AS low, round(max(score) OVER (), 6) AS high, "
            "round(avg(score) OVER (), 6) AS mean FROM doc_pairs",
        ),
    ),
    "minmax_normalize": (
        minmax_normalize,
        with_sql(
            DOC_PAIRS,
            select="SELECT line_no, round((score - min(score) OVER ()) / nullif(max(score) OVER () - min(score) OVER (), 0), 6) "
            "AS normalized FROM doc_pairs",
        ),
    ),
    "composite_quality_score": (
        composite_quality_score,
        with_sql(
            *COMPOSITE,
            select="SELECT line_no, round(composite_quality_score, 6) AS composite_quality_score, "
            "round(composite_quality_score_weighted, 6) AS composite_quality_score_weighted FROM composite",
        ),
    ),
    "metric_disagreement": (
        metric_disagreement,
        with_sql(
            *COMPOSITE,
            select="SELECT line_no, round(metric_disagreement, 6) AS metric_disagreement FROM composite",
        ),
    ),
    "high_disagreement": (
        high_disagreement,
        with_sql(
            *COMPOSITE,
            select="SELECT line_no, round(metric_disagreement, 6) AS metric_disagreement FROM composite "
            "WHERE metric_disagreement > (SELECT quantile_cont(metric_disagreement, 0.95) FROM composite)",
        ),
    ),
    "high_disagreement_share": (
        high_disagreement_share,
        with_sql(
            *COMPOSITE,
            select='SELECT count(*) FILTER (metric_disagreement > q) AS "rows", '
            "round(count(*) FILTER (metric_disagreement > q) * 100.0::DOUBLE / count(*), 6) AS percent "
            "FROM composite, (SELECT quantile_cont(metric_disagreement, 0.95) AS q FROM composite)",
        ),
    ),
    "top_disagreement": (
        top_disagreement,
        with_sql(
            *COMPOSITE,
            select="SELECT line_no, round(metric_disagreement, 6) AS metric_disagreement FROM composite "
            "ORDER BY composite.metric_disagreement DESC, line_no LIMIT 30",
        ),
    ),
    "lowest_similarity": (
        lowest_similarity,
        with_sql(
            *COMPOSITE,
            select="SELECT line_no, round(b, 6) AS embedding_normalized FROM composite "
            "WHERE b < (SELECT quantile_cont(b, 0.05) FROM composite) ORDER BY line_no LIMIT 10",
        ),
    ),
    "prediction_error": (
        prediction_error,
        with_sql(
            *PREDICTIONS,
            select="SELECT line_no, pred_ratio - score AS err_ratio, pred_overlap - score AS err_overlap FROM predictions",
        ),
    ),
    "score_interval": (
        score_interval,
        with_sql(
            *PREDICTIONS,
            select="SELECT line_no, pred_ratio, pred_ratio - 1.96::DOUBLE * (0.1::DOUBLE * abs(pred_ratio)) AS confidence_lower, "
            "pred_ratio + 1.96::DOUBLE * (0.1::DOUBLE * abs(pred_ratio)) AS confidence_upper FROM predictions",
        ),
    ),
    "score_band": (
        score_band,
        with_sql(
            DOC_PAIRS,
            select="SELECT line_no, CASE WHEN score > 1.20::DOUBLE THEN 'strong' WHEN score > 1.15::DOUBLE THEN 'good' "
            "WHEN score > 1.10::DOUBLE THEN 'moderate' ELSE 'lower' END AS band FROM doc_pairs",
        ),
    ),
    "corr_band": (
        corr_band,
        with_sql(
            *PREDICTIONS,
            select="SELECT round(corr(score, pred_ratio), 6) AS rho, CASE WHEN abs(corr(score, pred_ratio)) > 0.7 THEN 'strong' "
            "WHEN abs(corr(score, pred_ratio)) > 0.5 THEN 'moderate' ELSE 'weak' END AS band FROM predictions",
        ),
    ),
    "r2_verdict": (
        r2_verdict,
        with_sql(
            *PREDICTIONS,
            select="""SELECT model, round(r2, 6) AS r2, CASE WHEN r2 > 0 THEN 'better than mean' ELSE 'worse than mean' END AS verdict
FROM (SELECT 'pred_ratio' AS model, 1 - sum(power(score - pred_ratio, 2)) / (var_pop(score) * count(*)) AS r2 FROM predictions
  UNION ALL SELECT 'pred_overlap', 1 - sum(power(score - pred_overlap, 2)) / (var_pop(score) * count(*)) FROM predictions)""",
        ),
    ),
    "fill_signal_defaults": (
        fill_signal_defaults,
        with_sql(
            *SIMILARITY_CTES,
            select="""SELECT p.line_no,
  round(CASE WHEN l.quality IS NULL THEN 0.5::DOUBLE ELSE e.sim END, 6) AS embedding_similarity,
  round(CASE WHEN l.quality = 1 THEN e.sim ELSE 0.5::DOUBLE END, 6) AS labse_similarity,
  30.0::DOUBLE AS chinese_perplexity,
  (1 + (l.quality IS NULL)::INTEGER + (l.quality IS DISTINCT FROM 1)::INTEGER)::INTEGER AS signals_filled
FROM doc_pairs p JOIN embedding_sim e USING (line_no) LEFT JOIN labels l ON l.doc_id = p.line_no""",
        ),
    ),
    "ensure_columns": (
        ensure_columns,
        with_sql(
            DOC_PAIRS,
            select="SELECT line_no, length(source)::INTEGER AS source_length, round(score, 6) AS score FROM doc_pairs",
        ),
    ),
    "preview": (
        preview,
        with_sql(
            DOC_PAIRS,
            select="SELECT line_no, substr(source, 1, 200) AS source, substr(target, 1, 200) AS target "
            "FROM doc_pairs ORDER BY line_no LIMIT 10",
        ),
    ),
    "head_lines": (
        head_lines,
        with_sql(
            DOC_PAIRS,
            select="SELECT line_no, round(score, 6) AS score FROM doc_pairs WHERE line_no < 100",
        ),
    ),
    "filter_top_quantile": (
        filter_top_quantile,
        with_sql(
            DOC_PAIRS,
            select="SELECT line_no, round(score, 6) AS score FROM doc_pairs "
            "WHERE doc_pairs.score >= (SELECT quantile_cont(score, 0.95) FROM doc_pairs)",
        ),
    ),
    "filter_below_quantile": (
        filter_below_quantile,
        with_sql(
            DOC_PAIRS,
            select="SELECT line_no, round(score, 6) AS score FROM doc_pairs "
            "WHERE doc_pairs.score < (SELECT quantile_cont(score, 0.05) FROM doc_pairs)",
        ),
    ),
    "filter_low_quality": (
        filter_low_quality,
        with_sql(
            *PREDICTIONS,
            select="SELECT line_no, pred_ratio FROM predictions WHERE pred_ratio >= 1.15::DOUBLE",
        ),
    ),
    "top_k": (
        top_k,
        with_sql(
            DOC_PAIRS,
            select="SELECT line_no, round(score, 6) AS score FROM doc_pairs ORDER BY doc_pairs.score DESC, line_no LIMIT 10",
        ),
    ),
    "bottom_k": (
        bottom_k,
        with_sql(
            DOC_PAIRS,
            select="SELECT line_no, round(score, 6) AS score FROM doc_pairs ORDER BY doc_pairs.score, line_no LIMIT 10",
        ),
    ),
}
