"""Sources and sinks: every query writes the pairs and reads them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.derived import PREDICTIONS, simple_predictions
from catalog.models import TEXT_COLUMNS, TEXT_TABLE, text_table
from catalog.views import DOC_PAIRS, doc_pairs, rounded, with_sql
from pairscore.plans.scoring import evaluation_metrics
from pairscore.schema import TARGET
from pairscore.session import work_folder
from pairscore.sources.aligned import read_aligned, read_lines, write_aligned
from pairscore.sources.tables import (
    read_features,
    read_metrics,
    read_pairs,
    write_metrics,
    write_table,
)


def _aligned_files(spark, sf_dir):
    folder = work_folder(spark, "aligned")
    paths = [f"{folder}/{side}" for side in ("source", "target", "scores")]
    write_aligned(doc_pairs(spark, sf_dir), *paths)
    return paths


def aligned_round_trip(spark, sf_dir):
    """Three aligned text files, joined by line number again."""
    return rounded(read_aligned(spark, *_aligned_files(spark, sf_dir)))


def line_numbers(spark, sf_dir):
    """Numbered lines of one side."""
    lines, _ = read_lines(spark, _aligned_files(spark, sf_dir)[0])
    return lines.select("line_no", F.length("value").alias("length"))


def feature_csv_round_trip(spark, sf_dir):
    path = work_folder(spark, "features-csv")
    write_table(text_table(spark, sf_dir).drop("line_no"), path, "csv")
    df, names = read_features(spark, path)
    return df.select(*names, TARGET)


def pairs_csv_round_trip(spark, sf_dir):
    """Texts with line breaks and quotes, through the scoring CSV."""
    path = work_folder(spark, "pairs-csv")
    pairs = doc_pairs(spark, sf_dir).select(
        F.col("source").alias("hindi"),
        F.concat(F.lit('"«, '), F.col("target")).alias("chinese"),
        F.col("line_no").cast("string").alias("line_no"),
    )
    write_table(pairs, path, "csv")
    return read_pairs(spark, path)


def metrics_json_round_trip(spark, sf_dir):
    path = work_folder(spark, "metrics-json")
    made = simple_predictions(spark, sf_dir)
    write_metrics(evaluation_metrics(made, ["ratio", "overlap"], "score"), path)
    return rounded(read_metrics(spark, path, ["rmse", "mae", "r2"]))


_CLEAN = "trim(regexp_replace({0}, '[\\r\\n]+', ' ', 'g'))"

ENTRIES = {
    "aligned_round_trip": (
        aligned_round_trip,
        with_sql(
            DOC_PAIRS,
            select=f"SELECT line_no, {_CLEAN.format('source')} AS source, {_CLEAN.format('target')} AS target, "
            "round(score, 6) AS score FROM doc_pairs",
        ),
    ),
    "line_numbers": (
        line_numbers,
        with_sql(
            DOC_PAIRS,
            select="SELECT line_no, length(regexp_replace(source, '[\\r\\n]+', ' ', 'g'))::INTEGER AS length FROM doc_pairs",
        ),
    ),
    "feature_csv_round_trip": (
        feature_csv_round_trip,
        with_sql(*TEXT_TABLE, select=f"SELECT {', '.join([*TEXT_COLUMNS, TARGET])} FROM text_table"),
    ),
    "pairs_csv_round_trip": (
        pairs_csv_round_trip,
        with_sql(
            DOC_PAIRS,
            select="SELECT source AS hindi, '\"«, ' || target AS chinese, line_no::VARCHAR AS line_no FROM doc_pairs",
        ),
    ),
    "metrics_json_round_trip": (
        metrics_json_round_trip,
        with_sql(
            *PREDICTIONS,
            """w AS (
  SELECT model, avg(abs(pred - score)) AS mae, sqrt(avg((pred - score) ** 2)) AS rmse,
         1 - sum((pred - score) ** 2) / (var_pop(score) * count(*)) AS r2
  FROM predictions, LATERAL (VALUES ('ratio', pred_ratio), ('overlap', pred_overlap)) m(model, pred) GROUP BY model)""",
            select="SELECT model, metric, round(value, 6) AS value FROM (UNPIVOT w ON mae, rmse, r2 INTO NAME metric VALUE value)",
        ),
    ),
}
