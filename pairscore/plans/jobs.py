"""The jobs as they are submitted: explore, features, search, fit, evaluate, explain, score, compare, translate, stream.

Each reads stored tables and writes stored tables, so they can run on their own.
"""

from __future__ import annotations

import importlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairscore.operators import shapley, signals
from pairscore.operators.regress import ESTIMATORS
from pairscore.operators.sampling import holdout, sample_n
from pairscore.operators.tuning import fit_kind, grid_search
from pairscore.plans.explore import composite_scores, corpus_report, disagreement_report
from pairscore.plans.features import RatioRange, build_features, fitting_rows
from pairscore.plans.scoring import (
    compare_systems,
    evaluate,
    evaluate_translator,
    evaluation_metrics,
    score_pairs,
)
from pairscore.schema import CSV_SOURCE, CSV_TARGET, PAIRS, TARGET, PairColumns
from pairscore.session import materialize
from pairscore.sources.aligned import read_aligned
from pairscore.sources.store import ScoringPipeline, load_pipeline, save_pipeline
from pairscore.sources.tables import (
    read_pairs,
    read_params,
    read_table,
    write_metrics,
    write_params,
    write_table,
)
from pairscore.streaming.scoring import read_pair_stream, score_stream

KEY = PAIRS.key
SPLIT = "split"


def feature_names(table: DataFrame) -> list[str]:
    """Every column but the key, the split and the target."""
    return [c for c in table.columns if c not in (KEY, SPLIT, TARGET)]


def run_explore(spark: SparkSession, source: str, target: str, scores: str, out: str, bins: int = 50) -> list[str]:
    """Aligned text files in; the tables of a first look, and of how far score and similarity disagree, out."""
    pairs = materialize(read_aligned(spark, source, target, scores), "pairs")
    tables = corpus_report(pairs, bins=bins)
    scored = materialize(composite_scores(signals.similarity(pairs)), "composite")
    tables |= {f"disagreement_{name}": table for name, table in disagreement_report(scored).items()}
    for name, table in tables.items():
        write_table(table, f"{out}/{name}")
    return list(tables)


def run_features(
    spark: SparkSession,
    source: str,
    target: str,
    scores: str,
    out: str,
    sample_size: int | None = None,
    seed: int = 42,
    limit: float = 0.95,
    test_ratio: float = 0.1,
) -> list[str]:
    """Aligned text files in; feature table, language model and ratio range out.

    The pairs are aligned and stored once. The test rows are held out first, so nothing is
    fitted on them; the column ``split`` of the feature table tells them.
    """
    pairs = materialize(read_aligned(spark, source, target, scores), "pairs")
    split = materialize(holdout(sample_n(pairs, sample_size, seed), test_ratio, seed), "split-pairs")
    job = build_features(split, limit=limit, split=SPLIT)
    write_table(job.table, f"{out}/features")
    write_table(job.lm, f"{out}/lm")
    spark.createDataFrame(
        [(job.ratio_range.low, job.ratio_range.high)], "low double, high double"
    ).write.json(f"{out}/ratio_range")
    return job.features


def run_search(
    spark: SparkSession,
    features: str,
    out: str,
    kind: str,
    space: dict | None = None,
    k: int = 5,
    test_ratio: float = 0.1,
    seed: int = 42,
    parallelism: int = 4,
) -> dict:
    """Holds the test rows back, searches on the rest, writes both and the best parameters.

    A feature table that has a split keeps it; ``test_ratio`` is for those without.
    """
    split = spark.read.parquet(features)
    if SPLIT not in split.columns:
        split = materialize(holdout(split, test_ratio, seed), "holdout")
    for part in ("test", "trainval"):
        write_table(split.filter(F.col("split") == part).drop("split"), f"{out}/{part}")
    trainval = spark.read.parquet(f"{out}/trainval")
    found = grid_search(
        trainval, kind, feature_names(trainval), space, k, seed=seed, parallelism=parallelism
    )
    write_table(found.folds, f"{out}/folds_{kind}")
    write_params(spark, f"{out}/best_params_{kind}", kind, found.best_params, found.best_cv_rmse)
    return found.best_params


def run_fit(
    spark: SparkSession, table: str, prepared: str, kind: str, params: dict | str, out: str
) -> None:
    """Fits one model on a feature table and saves it with all that scoring needs.

    ``prepared`` is the output folder of the feature job; ``params`` are the
    parameters or the path of a stored search.
    """
    if isinstance(params, str):
        params = read_params(spark, params)["best_params"]
    df = spark.read.parquet(table)
    df = fitting_rows(df, SPLIT if SPLIT in df.columns else None)
    fitted = fit_kind(df, kind, feature_names(df), TARGET, params)
    bounds = spark.read.json(f"{prepared}/ratio_range").first()
    lm = spark.read.parquet(f"{prepared}/lm")
    pipeline = ScoringPipeline(fitted, lm, RatioRange(bounds["low"], bounds["high"]))
    save_pipeline(spark, pipeline, f"{out}/{kind}")


def run_evaluate(
    spark: SparkSession, table: str, models: str, kinds: list[str], out: str
) -> DataFrame:
    """Predictions and errors of every saved model, and their metrics as JSON."""
    df = spark.read.parquet(table)
    fitted = {kind: load_pipeline(spark, f"{models}/{kind}").fitted for kind in kinds}
    evaluated = materialize(evaluate(df, fitted), "evaluated")
    write_table(evaluated, f"{out}/eval_results", "csv")
    metrics = evaluation_metrics(evaluated, kinds)
    write_metrics(metrics, f"{out}/eval_metrics")
    return metrics


def run_explain(
    spark: SparkSession,
    table: str,
    models: str,
    kind: str,
    out: str,
    sample_size: int = shapley.EXPLAINED_ROWS,
) -> None:
    """Attributions of a saved model for a sample of rows, and its importance table."""
    df = spark.read.parquet(table)
    fitted = load_pipeline(spark, f"{models}/{kind}").fitted
    features, scaler = fitted.features, fitted.feature_scaler
    rows = sample_n(df, sample_size, shapley.SEED)
    background = shapley.background_rows(rows, features, scaler)
    if kind == "linear":
        explained = shapley.linear_shapley(rows, fitted, background)
    else:
        explained = shapley.shapley(rows, fitted.scaled_function(), features, scaler, background)
    stored = materialize(explained, "attributions")
    write_table(stored, f"{out}/shap_values_{kind}")
    write_table(shapley.importance(stored, features).coalesce(1), f"{out}/shap_importance_{kind}", "csv")


def run_score(spark: SparkSession, pairs: str, model: str, out: str) -> None:
    """A scoring CSV (or Parquet) in, the same rows with score and interval out."""
    cols = PairColumns(source=CSV_SOURCE, target=CSV_TARGET)
    df = read_pairs(spark, pairs)
    if cols.key not in df.columns:
        # stored, so that a row keeps its number however often the plan reads it
        df = materialize(df.withColumn(cols.key, F.monotonically_increasing_id()), "numbered")
    scored = score_pairs(df, load_pipeline(spark, model), cols).drop(cols.key, "signals_filled")
    write_table(scored, out, "csv")


def run_compare(
    spark: SparkSession, outputs: str, model: str, out: str, system: str = "system", group: str | None = None
) -> None:
    """Outputs of several systems in; their mean scores, and their ranks for every source, out."""
    cols = PairColumns(source=CSV_SOURCE, target=CSV_TARGET)
    df = read_pairs(spark, outputs)
    for needed in (system, group or cols.source):
        if needed not in df.columns:
            raise ValueError(f"the outputs have no column {needed!r}")
    means, ranked = compare_systems(df, load_pipeline(spark, model), cols, system, group)
    write_table(means, f"{out}/systems", "csv")
    write_table(ranked, f"{out}/ranked")


def named_loader(name: str):
    """The function that ``module:function`` names; send its module with ``--py-files``."""
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def run_translate(spark: SparkSession, sources: str, translator: str, model: str, out: str) -> None:
    """A table with a source column in; its translations by a user's function, with their scores, out."""
    cols = PairColumns(source=CSV_SOURCE, target=CSV_TARGET)
    df = read_table(spark, sources)
    scored = evaluate_translator(df, named_loader(translator), load_pipeline(spark, model), cols)
    write_table(scored.drop("signals_filled"), out)


def run_stream(spark: SparkSession, pairs: str, model: str, out: str, checkpoint: str, once: bool = False) -> None:
    """Pairs scored as their files arrive, until stopped; with ``once`` those that are there."""
    query = score_stream(read_pair_stream(spark, pairs), load_pipeline(spark, model), out, checkpoint, once=once)
    query.awaitTermination()


def parse_space(text: str | None) -> dict | None:
    """A search space given as JSON, ``{"name": [values]}``."""
    return json.loads(text) if text else None


KINDS = [*ESTIMATORS, "mlp", "residual_mlp"]
