"""Splits, scaling, pruning, metrics, models, explanation and scoring."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from catalog.derived import PREDICTIONS, simple_predictions
from catalog.views import (
    DOC_PAIRS,
    FEATURE_CTES,
    SYSTEM_OUTPUTS,
    VEC_PAIRS,
    doc_pairs,
    rounded,
    rounded_feature_sql,
    rounded_features,
    system_outputs,
    text_features_sql,
    vec_pairs,
    with_sql,
)
from pairscore.functions import vectors
from pairscore.operators import bilinear, collinear, foldstats, metrics, ranks, regress, sampling, scaling, shapley
from pairscore.operators.filters import filter_low_quality
from pairscore.operators.network import fit_mlp
from pairscore.operators.tuning import grid_search
from pairscore.plans.features import build_features, text_features
from pairscore.plans.scoring import (
    evaluate,
    evaluate_splits,
    evaluation_metrics,
    evaluate_translator,
    score_pairs,
)
from pairscore.schema import FEATURES, TARGET, PairColumns
from pairscore.session import materialize, work_folder
from pairscore.sources.store import (
    ScoringPipeline,
    load_pipeline,
    load_vector_model,
    save_pipeline,
    save_vector_model,
)
from pairscore.sources.tables import read_params, write_params
from pairscore.streaming.scoring import read_pair_stream, score_stream

MODELS = ["ratio", "overlap"]
PRED = {m: f"pred_{m}" for m in MODELS}
TEXT_COLUMNS = [
    "hindi_length",
    "chinese_length",
    "length_ratio",
    "char_alignment",
    "vocab_diversity_hi",
    "chinese_char_count",
]


# --- splits and scaling -------------------------------------------------------


def sample_n(spark, sf_dir):
    pairs = doc_pairs(spark, sf_dir)
    return rounded(sampling.sample_n(pairs, 100, 42).select("line_no", "score"))


def sample_repeated_keys(spark, sf_dir):
    """A sample by a key that many rows share, and that some rows lack, has its exact size."""
    keyed = doc_pairs(spark, sf_dir).withColumn("k", F.expr("CASE WHEN line_no % 3 > 0 THEN line_no % 7 END"))
    taken = sampling.sample_n(keyed, 110, 42, "k")
    return taken.agg(F.count("*").alias("n"), F.count_distinct("line_no").alias("lines"))


def split_train_val_test(spark, sf_dir):
    return sampling.split_train_val_test(doc_pairs(spark, sf_dir)).select("line_no", "split")


def holdout(spark, sf_dir):
    return sampling.holdout(doc_pairs(spark, sf_dir)).select("line_no", "split")


def kfold(spark, sf_dir):
    return sampling.kfold(doc_pairs(spark, sf_dir)).select("line_no", "fold")


def aligned_split(spark, sf_dir):
    """One split column for the numbers and both vectors of a pair."""
    made = sampling.split_train_val_test(vec_pairs(spark, sf_dir), key="vec_id")
    return made.groupBy("split").agg(
        F.count("a").alias("source_vectors"),
        F.count("b").alias("target_vectors"),
        F.sum("label").alias("labels"),
    )


def text_table(spark, sf_dir):
    made = text_features(doc_pairs(spark, sf_dir))
    return made.select("line_no", *TEXT_COLUMNS, F.col("score").alias(TARGET))


def scaler_stats(spark, sf_dir):
    return rounded(scaling.scaler_stats(text_table(spark, sf_dir), [*TEXT_COLUMNS, TARGET]))


def standardize(spark, sf_dir):
    made = materialize(text_table(spark, sf_dir), "text-table")
    return rounded(scaling.standardize(made, [*TEXT_COLUMNS, TARGET]))


def scale_round_trip(spark, sf_dir):
    """Scaled and scaled back: the target as it was."""
    made = text_table(spark, sf_dir).select("line_no", TARGET)
    scaler = scaling.fit_scaler(made, [TARGET])
    back = scaler.inverse(scaler.scaled(TARGET), TARGET)
    return rounded(made.select("line_no", back.alias(TARGET)))


def fold_scaling(spark, sf_dir):
    """Every validation fold scaled with the numbers of the other folds."""
    made = materialize(
        sampling.kfold(text_table(spark, sf_dir).select("line_no", "length_ratio")), "folds"
    )
    return rounded(foldstats.scale_folds(made, ["length_ratio"]))


def pruned_features(spark, sf_dir):
    job = build_features(doc_pairs(spark, sf_dir))
    return collinear.kept_features(job.table, job.pruned)


def collinear_pairs(spark, sf_dir):
    job = build_features(doc_pairs(spark, sf_dir))
    return rounded(collinear.pruned_pairs(job.table, job.pruned))


def feature_job(spark, sf_dir):
    """The whole feature job; its table in long form, as the kept columns depend on the data."""
    job = build_features(doc_pairs(spark, sf_dir))
    doubles = job.table.select("line_no", *[F.col(c).cast("double").alias(c) for c in job.features])
    return rounded_features(doubles.unpivot(["line_no"], job.features, "feature", "value"))


# --- metrics ------------------------------------------------------------------


def split_predictions(spark, sf_dir):
    made = sampling.split_train_val_test(simple_predictions(spark, sf_dir))
    return materialize(made, "split-predictions")


def regression_metrics(spark, sf_dir):
    made = simple_predictions(spark, sf_dir)
    return rounded(metrics.regression_metrics(made, "score", "pred_ratio"))


def rank_metrics(spark, sf_dir):
    return rounded(metrics.rank_metrics(simple_predictions(spark, sf_dir), "score", "pred_ratio"))


def spearman_ranged(spark, sf_dir):
    """Rank correlation of a tied, skewed column, with the ranks taken range by range."""
    made = text_table(spark, sf_dir)
    return rounded(
        ranks.spearman(made, "hindi_length", "vocab_diversity_hi", "spearman", per_bucket=100)
    )


def metrics_by_split(spark, sf_dir):
    return rounded(metrics.metrics_by_split(split_predictions(spark, sf_dir), "score", PRED))


def best_model(spark, sf_dir):
    made = metrics.metrics_by_split(split_predictions(spark, sf_dir), "score", PRED)
    return rounded(metrics.best_model(made, MODELS))


def sort_metrics(spark, sf_dir):
    made = metrics.metrics_by_split(split_predictions(spark, sf_dir), "score", PRED)
    return rounded(metrics.sort_metrics(made))


def metrics_transpose(spark, sf_dir):
    made = metrics.metrics_by_split(split_predictions(spark, sf_dir), "score", PRED)
    return rounded(metrics.metrics_transpose(made, MODELS))


def fold_average(spark, sf_dir):
    """Fold metrics of both predictors, averaged."""
    made = sampling.kfold(simple_predictions(spark, sf_dir))
    folds = made.unpivot(
        ["fold", "score"], ["pred_ratio", "pred_overlap"], "params", "pred"
    )
    aggs = metrics.regression_aggregates(F.col("score"), F.col("pred"))
    per_fold = folds.groupBy("params", "fold").agg(
        aggs["rmse"].alias("rmse"), aggs["mae"].alias("mae")
    )
    return rounded(metrics.fold_average(per_fold))


def training_summary(spark, sf_dir):
    made = split_predictions(spark, sf_dir)
    by_split = metrics.metrics_by_split(made, "score", PRED)
    return rounded(metrics.training_summary(made, FEATURES, by_split, MODELS))


def evaluation(spark, sf_dir):
    made = simple_predictions(spark, sf_dir)
    return rounded(evaluation_metrics(made, MODELS, "score"))


def system_compare(spark, sf_dir):
    """Systems compared by a plain score of their outputs."""
    return rounded(metrics.system_compare(_scored_systems(spark, sf_dir)))


def _scored_systems(spark, sf_dir):
    made = text_features(system_outputs(spark, sf_dir), PairColumns(source="source_text"))
    scored = made.withColumn("predicted_score", F.lit(1.06) + F.lit(0.18) * F.col("char_alignment"))
    return scored.select("source", "system", "line_no", "predicted_score")


def rank_systems(spark, sf_dir):
    return rounded(
        ranks.rank_within(_scored_systems(spark, sf_dir), "source", "predicted_score", "line_no")
    )


def rank_systems_plain(spark, sf_dir):
    """The same ranking with every source treated as small."""
    made = _scored_systems(spark, sf_dir)
    return rounded(
        ranks.rank_within(made, "source", "predicted_score", "line_no", hot_groups=[])
    )


# --- models -------------------------------------------------------------------


def feature_split(spark, sf_dir):
    job = build_features(doc_pairs(spark, sf_dir))
    return job, materialize(sampling.holdout(job.table), "feature-split")


def _train(table):
    return table.filter(F.col("split") == "trainval")


def _test(table):
    return table.filter(F.col("split") == "test")


def linear_fit(spark, sf_dir):
    """A line through score over length ratio, in the original scales."""
    made = materialize(text_table(spark, sf_dir), "text-table")
    fitted = regress.fit_regressor(made, "linear", ["length_ratio"])
    x, y = fitted.feature_scaler, fitted.target_scaler
    slope = fitted.model.coefficients[0] * y.scale[0] / x.scale[0]
    start = y.mean[0] + fitted.model.intercept * y.scale[0] - slope * x.mean[0]
    return rounded(
        made.select(
            "line_no",
            F.lit(float(slope)).alias("slope"),
            F.lit(float(start)).alias("intercept"),
            (F.lit(float(start)) + F.lit(float(slope)) * F.col("length_ratio")).alias("predicted"),
        )
    )


def _fit_and_evaluate(spark, sf_dir, kind, params=None):
    job, split = feature_split(spark, sf_dir)
    fitted = regress.fit_regressor(_train(split), kind, job.features, params=params)
    return evaluation_metrics(evaluate(_test(split), {kind: fitted}), [kind])


def fit_linear(spark, sf_dir):
    return _fit_and_evaluate(spark, sf_dir, "linear")


def fit_random_forest(spark, sf_dir):
    return _fit_and_evaluate(spark, sf_dir, "random_forest", {"seed": 42})


def fit_gbt(spark, sf_dir):
    return _fit_and_evaluate(spark, sf_dir, "gbt", {"seed": 42})


def evaluation_line(spark, sf_dir):
    """Errors of a line, fitted on the training rows, in all three parts."""
    split = materialize(sampling.split_train_val_test(text_table(spark, sf_dir)), "line-split")
    fitted = regress.fit_regressor(split.where("split = 'train'"), "linear", ["length_ratio"])
    return rounded(evaluate_splits(split, {"linear": fitted}).where("metric <> 'spearman'"))


def _fit_network(spark, sf_dir, residual):
    job, split = feature_split(spark, sf_dir)
    # the published settings: 60 epochs in batches of 128 are the defaults
    fitted = fit_mlp(
        _train(split), job.features, hidden_dim=256, num_layers=3, dropout=0.2, learning_rate=5e-4, residual=residual
    )
    return fitted, split


def fit_network(spark, sf_dir):
    fitted, split = _fit_network(spark, sf_dir, False)
    return evaluation_metrics(evaluate(_test(split), {"mlp": fitted}), ["mlp"])


def fit_residual_network(spark, sf_dir):
    fitted, split = _fit_network(spark, sf_dir, True)
    return fitted.history_table(split)


def fit_embedding_regressor(spark, sf_dir):
    """The label of the first vector, regressed on both vectors."""
    made = sampling.split_train_val_test(vec_pairs(spark, sf_dir), key="vec_id")
    made = made.withColumn("label", F.col("label").cast("double"))
    fitted = regress.fit_embedding_regressor(
        made.filter(F.col("split") == "train"), "a", "b", "label", params={"regParam": 0.1}
    )
    scored = fitted.predict(made.filter(F.col("split") == "test"))
    return metrics.regression_metrics(scored, "label", "predicted_score")


def fit_bilinear(spark, sf_dir):
    """The cosine of two vectors, regressed on both with and without their interaction; models saved and read back."""
    made = vec_pairs(spark, sf_dir).withColumn("similarity", vectors.cosine("a", "b"))
    made = sampling.split_train_val_test(made, key="vec_id")
    train, test = made.filter(F.col("split") == "train"), made.filter(F.col("split") == "test")
    folder = work_folder(spark, "vector-models")
    fits = {
        "linear": regress.fit_embedding_regressor(train, "a", "b", "similarity", params={"regParam": 0.01}),
        "bilinear": bilinear.fit_bilinear(train, "a", "b", "similarity", rank=16, ridge=0.01),
    }
    rows = None
    for name, fitted in fits.items():
        save_vector_model(spark, fitted, f"{folder}/{name}")
        scored = load_vector_model(spark, f"{folder}/{name}").predict(test, "pred")
        own = metrics.regression_metrics(scored, "similarity", "pred").withColumn("model", F.lit(name))
        rows = own if rows is None else rows.unionByName(own)
    return rows


def search(spark, sf_dir):
    job = build_features(doc_pairs(spark, sf_dir))
    space = {"regParam": [0.0, 0.1], "elasticNetParam": [0.0, 0.5]}
    return grid_search(job.table, "linear", job.features, space, k=3).averages


def line_search(spark, sf_dir):
    """A search over lines; centred data make the intercept irrelevant."""
    made = text_table(spark, sf_dir).select("line_no", "length_ratio", TARGET)
    made = materialize(made, "line-search")
    space = {"regParam": [0.0], "fitIntercept": [True, False]}
    return rounded(grid_search(made, "linear", ["length_ratio"], space, k=3).averages)


PENALTIES = {"regParam": [0.0, 0.01, 0.1, 0.5], "elasticNetParam": [0.0, 0.5, 1.0]}


def path_search(spark, sf_dir):
    """Every penalty over five folds from one scan; over one feature SQL can solve it too."""
    made = text_table(spark, sf_dir).select("line_no", "length_ratio", TARGET)
    found = foldstats.search_linear_path(made, ["length_ratio"], *PENALTIES.values())
    return rounded(found.averages)


def path_search_features(spark, sf_dir):
    """The same over all features of the feature job: RMSE by combination and fold."""
    job = build_features(doc_pairs(spark, sf_dir))
    return foldstats.search_linear_path(job.table, job.features, *PENALTIES.values()).folds


def tree_importance(spark, sf_dir):
    job, split = feature_split(spark, sf_dir)
    fitted = regress.fit_regressor(
        _train(split), "random_forest", job.features, params={"seed": 42}
    )
    return regress.tree_importance(fitted, split)


# --- explanation and scoring --------------------------------------------------


def linear_attributions(spark, sf_dir):
    """Exact attributions of a linear model for every pair."""
    job, split = feature_split(spark, sf_dir)
    fitted = regress.fit_regressor(_train(split), "linear", job.features)
    background = shapley.background_rows(_train(split), job.features, fitted.feature_scaler)
    return shapley.linear_shapley(split, fitted, background)


def shapley_importance(spark, sf_dir):
    """Mean absolute attribution of a network's features over the sampled rows."""
    job, split = feature_split(spark, sf_dir)
    train = _train(split)
    # the smallest network of the grid: 200 rows x 2,100 coalitions x 50 background rows go through it
    fitted = fit_mlp(train, job.features, hidden_dim=64, num_layers=2, dropout=0.2, learning_rate=1e-3)
    background = shapley.background_rows(train, job.features, fitted.feature_scaler)
    rows = sampling.sample_n(train, shapley.EXPLAINED_ROWS, shapley.SEED)
    rows = rows.repartition(spark.sparkContext.defaultParallelism, "line_no")
    explained = shapley.shapley(
        rows, fitted.scaled_function(), job.features, fitted.feature_scaler, background
    )
    return shapley.importance(explained, job.features)


def tree_attributions(spark, sf_dir):
    """Exact attributions of boosted trees for the sampled rows."""
    job, split = feature_split(spark, sf_dir)
    train = _train(split)
    fitted = regress.fit_regressor(train, "gbt", job.features, params={"seed": 42})
    background = shapley.background_rows(train, job.features, fitted.feature_scaler)
    rows = sampling.sample_n(train, shapley.EXPLAINED_ROWS, shapley.SEED)
    return shapley.tree_shapley(rows, fitted, background)


def importance(spark, sf_dir):
    """The importance table of given per-row values: here centred text features."""
    made = text_table(spark, sf_dir)
    return rounded(shapley.importance(made, TEXT_COLUMNS))


def fitted_pipeline(spark, sf_dir, kind="linear", params=None):
    job = build_features(doc_pairs(spark, sf_dir))
    fitted = regress.fit_regressor(job.table, kind, job.features, params=params)
    return ScoringPipeline(fitted, job.lm, job.ratio_range)


def scored_pairs(spark, sf_dir):
    pipeline = fitted_pipeline(spark, sf_dir)
    return score_pairs(doc_pairs(spark, sf_dir), pipeline).drop("source", "target")


def line_pipeline(spark, sf_dir):
    """A pipeline whose model is a line over the length ratio, which SQL can fit too."""
    job = build_features(doc_pairs(spark, sf_dir), features=["length_ratio"])
    fitted = regress.fit_regressor(job.table, "linear", job.features)
    return ScoringPipeline(fitted, job.lm, job.ratio_range)


def scored_missing_text(spark, sf_dir):
    """Pairs of which some lack a text: those have no score, the others have theirs."""
    pairs = doc_pairs(spark, sf_dir)
    holes = pairs.withColumn("target", F.expr("CASE WHEN line_no % 7 > 0 THEN target END"))
    scored = score_pairs(holes, line_pipeline(spark, sf_dir))
    return rounded(scored.select("line_no", "predicted_score"))


def scored_by_line(spark, sf_dir):
    scored = score_pairs(doc_pairs(spark, sf_dir), line_pipeline(spark, sf_dir))
    return rounded(
        scored.select("line_no", "predicted_score", "confidence_lower", "confidence_upper")
    )


def reloaded_model_scores(spark, sf_dir):
    """Scores of a pipeline that was saved and loaded again."""
    path = work_folder(spark, "pipeline")
    save_pipeline(spark, line_pipeline(spark, sf_dir), path)
    scored = score_pairs(doc_pairs(spark, sf_dir), load_pipeline(spark, path))
    return rounded(scored.select("line_no", "predicted_score"))


def filtered_corpus(spark, sf_dir):
    """The corpus without the pairs that are scored below a threshold."""
    scored = score_pairs(doc_pairs(spark, sf_dir), line_pipeline(spark, sf_dir))
    return rounded(filter_low_quality(scored, 1.13).select("line_no", "predicted_score"))


def line_attributions(spark, sf_dir):
    """Exact attributions of the line against 50 background rows."""
    job = build_features(doc_pairs(spark, sf_dir), features=["length_ratio"])
    fitted = regress.fit_regressor(job.table, "linear", job.features)
    background = shapley.background_rows(job.table, job.features, fitted.feature_scaler)
    explained = shapley.linear_shapley(job.table, fitted, background)
    return rounded(explained.select("line_no", "length_ratio"))


def scored_stream(spark, sf_dir):
    """Pairs scored as a stream of files, then read back."""
    pipeline = line_pipeline(spark, sf_dir)
    pairs = materialize(doc_pairs(spark, sf_dir), "stream-input")
    folder = work_folder(spark, "stream")
    stream = read_pair_stream(spark, pairs.inputFiles()[0].rsplit("/", 1)[0], pairs.schema)
    query = score_stream(stream, pipeline, f"{folder}/scored", f"{folder}/checkpoint", once=True)
    query.awaitTermination()
    return rounded(spark.read.parquet(f"{folder}/scored").select("line_no", "predicted_score"))


def translated_pairs(spark, sf_dir):
    """Sources translated by a user function, then scored."""
    from catalog.text import lower_case_translator

    sources = doc_pairs(spark, sf_dir).select("line_no", "source")
    scored = evaluate_translator(sources, lower_case_translator, line_pipeline(spark, sf_dir))
    return rounded(scored.select("line_no", "predicted_score"))


def params_round_trip(spark, sf_dir):
    """The result of a search, written and read as JSON."""
    made = text_table(spark, sf_dir).select("line_no", "length_ratio", TARGET)
    made = materialize(made, "line-search")
    space = {"regParam": [0.0], "fitIntercept": [True, False]}
    found = grid_search(made, "linear", ["length_ratio"], space, k=3)
    path = work_folder(spark, "params")
    write_params(spark, path, "linear", found.best_params, found.best_cv_rmse)
    stored = read_params(spark, path)
    return rounded(
        spark.createDataFrame(
            [("linear", json.dumps(stored["best_params"]), stored["best_cv_rmse"])],
            "model string, best_params string, best_cv_rmse double",
        )
    )


def _hash_sql(key: str, salt: str) -> str:
    return f"('0x' || substr(md5({key}::VARCHAR || ':{salt}'), 1, 15))::BIGINT"


def _bucket_sql(key: str, salt: str) -> str:
    return f"(('0x' || substr(md5({key}::VARCHAR || ':{salt}'), 1, 8))::BIGINT % 10000)"


def _split_sql(key: str) -> str:
    b = _bucket_sql(key, "split42")
    return f"CASE WHEN {b} < 7000 THEN 'train' WHEN {b} < 8500 THEN 'val' ELSE 'test' END"


TEXT_TABLE = (
    DOC_PAIRS,
    text_features_sql("doc_pairs"),
    f"text_table AS (SELECT line_no, {', '.join(TEXT_COLUMNS)}, score AS {TARGET} FROM text_features)",
)
_SCALED = [*TEXT_COLUMNS, TARGET]
_SCALE = "CASE WHEN min({0}) OVER () = max({0}) OVER () THEN 1 ELSE stddev_pop({0}) OVER () END"


def _scaler_sql(c: str) -> str:
    return f"""SELECT '{c}' AS "column", round(avg({c}), 6) AS mean,
  round(CASE WHEN min({c}) = max({c}) THEN 1 ELSE stddev_pop({c}) END, 6) AS scale FROM text_table"""


# correlation of every ordered pair of features, and the features that go
CORRELATIONS = (
    *FEATURE_CTES,
    "names AS (SELECT unnest(["
    + ", ".join(f"'{f}'" for f in FEATURES)
    + "]) AS feature, unnest(range(31)) AS ordinal)",
    "numbers AS (SELECT line_no, "
    + ", ".join(f"{f}::DOUBLE AS {f}" for f in FEATURES)
    + " FROM wide)",
    """long_form AS (
  SELECT line_no, n.feature, n.ordinal, value
  FROM (UNPIVOT numbers ON COLUMNS(* EXCLUDE line_no) INTO NAME feature VALUE value) u JOIN names n USING (feature)),
high_pairs AS (
  SELECT a.feature AS earlier, b.feature AS later, abs(corr(a.value, b.value)) AS r
  FROM long_form a JOIN long_form b ON a.line_no = b.line_no AND a.ordinal < b.ordinal
  GROUP BY a.feature, b.feature
  HAVING min(a.value) < max(a.value) AND min(b.value) < max(b.value) AND abs(corr(a.value, b.value)) > 0.95),
kept AS (
  SELECT feature, row_number() OVER (ORDER BY ordinal) - 1 AS ordinal FROM names
  WHERE feature NOT IN (SELECT later FROM high_pairs))""",
)

SPLIT_PREDICTIONS = (
    *PREDICTIONS,
    f"""split_predictions AS (
  SELECT {_split_sql('line_no')} AS split, model, score, pred FROM predictions,
  LATERAL (VALUES ('ratio', pred_ratio), ('overlap', pred_overlap)) m(model, pred))""",
    """ranked AS (
  SELECT *, rank() OVER (PARTITION BY split, model ORDER BY score)
           + (count(*) OVER (PARTITION BY split, model, score) - 1) / 2 AS score_rank,
         rank() OVER (PARTITION BY split, model ORDER BY pred)
           + (count(*) OVER (PARTITION BY split, model, pred) - 1) / 2 AS pred_rank
  FROM split_predictions)""",
    """wide_metrics AS (
  SELECT model, split, avg(abs(pred - score)) AS mae, sqrt(avg((pred - score) * (pred - score))) AS rmse,
         1 - sum((pred - score) * (pred - score)) / (var_pop(score) * count(*)) AS r2,
         corr(score, pred) AS pearson, corr(score_rank, pred_rank) AS spearman
  FROM ranked GROUP BY model, split)""",
    """metrics AS (
  SELECT model, split, metric, value FROM (
    UNPIVOT wide_metrics ON mae, rmse, r2, pearson, spearman INTO NAME metric VALUE value)
  WHERE split = 'test' OR metric IN ('mae', 'rmse', 'r2'))""",
)
LINE = f"""line AS (
  SELECT regr_slope({TARGET}, length_ratio) AS slope, regr_intercept({TARGET}, length_ratio) AS start FROM text_table)"""
LINE_SCORES = (
    *TEXT_TABLE,
    LINE,
    "line_scores AS (SELECT line_no, length_ratio, start + slope * length_ratio AS s FROM text_table, line)",
)
LINE_SEARCH = (
    *TEXT_TABLE,
    f"f AS (SELECT length_ratio AS x, {TARGET} AS y, {_bucket_sql('line_no', 'fold42')} % 3 AS fold FROM text_table)",
    """l AS (SELECT k.fold, regr_slope(y, x) AS slope, regr_intercept(y, x) AS start
  FROM (SELECT DISTINCT fold FROM f) k JOIN f ON f.fold <> k.fold GROUP BY k.fold)""",
    """e AS (SELECT fold, sqrt(avg((start + slope * x - y) ** 2)) AS rmse, avg(abs(start + slope * x - y)) AS mae
  FROM f JOIN l USING (fold) GROUP BY fold)""",
)
BEST = "(SELECT model FROM metrics WHERE metric = 'mae' AND split = 'test' ORDER BY value, model DESC LIMIT 1)"
SYSTEM_SCORES = (
    DOC_PAIRS,
    SYSTEM_OUTPUTS,
    text_features_sql("(SELECT line_no, source_text AS source, target FROM system_outputs)"),
    """scored AS (
  SELECT o.source, o.system, o.line_no, 1.06::DOUBLE + 0.18::DOUBLE * t.char_alignment AS predicted_score
  FROM system_outputs o JOIN text_features t USING (line_no))""",
)
_RANK_SYSTEMS = with_sql(
    *SYSTEM_SCORES,
    select="SELECT source, system, line_no, round(predicted_score, 6) AS predicted_score, "
    "row_number() OVER (PARTITION BY source ORDER BY scored.predicted_score DESC, line_no) AS rank FROM scored",
)

ENTRIES = {
    "sample_n": (
        sample_n,
        with_sql(
            DOC_PAIRS,
            select=f"SELECT line_no, round(score, 6) AS score FROM doc_pairs ORDER BY {_hash_sql('line_no', 'sample42')}, line_no LIMIT 100",
        ),
    ),
    "sample_repeated_keys": (
        sample_repeated_keys,
        with_sql(
            DOC_PAIRS,
            select="SELECT least(110, count(*)) AS n, least(110, count(*)) AS lines FROM doc_pairs",
        ),
    ),
    "split_train_val_test": (
        split_train_val_test,
        with_sql(DOC_PAIRS, select=f"SELECT line_no, {_split_sql('line_no')} AS split FROM doc_pairs"),
    ),
    "holdout": (
        holdout,
        with_sql(
            DOC_PAIRS,
            select=f"""SELECT line_no, CASE WHEN row_number() OVER (ORDER BY {_hash_sql('line_no', 'holdout42')}, line_no)
  <= floor(count(*) OVER () * 0.1) THEN 'test' ELSE 'trainval' END AS split FROM doc_pairs""",
        ),
    ),
    "kfold": (
        kfold,
        with_sql(
            DOC_PAIRS,
            select=f"SELECT line_no, ({_bucket_sql('line_no', 'fold42')} % 5)::INTEGER AS fold FROM doc_pairs",
        ),
    ),
    "aligned_split": (
        aligned_split,
        with_sql(
            VEC_PAIRS,
            select=f"SELECT {_split_sql('vec_id')} AS split, count(a) AS source_vectors, count(b) AS target_vectors, "
            "sum(label)::BIGINT AS labels FROM vec_pairs GROUP BY 1",
        ),
    ),
    "scaler_stats": (
        scaler_stats,
        with_sql(*TEXT_TABLE, select=" UNION ALL ".join(_scaler_sql(c) for c in _SCALED)),
    ),
    "standardize": (
        standardize,
        with_sql(
            *TEXT_TABLE,
            select="SELECT line_no, "
            + ", ".join(
                f"round(({c} - avg({c}) OVER ()) / ({_SCALE.format(c)}), 6) AS {c}" for c in _SCALED
            )
            + " FROM text_table",
        ),
    ),
    "scale_round_trip": (
        scale_round_trip,
        with_sql(DOC_PAIRS, select=f"SELECT line_no, round(score, 6) AS {TARGET} FROM doc_pairs"),
    ),
    "fold_scaling": (
        fold_scaling,
        with_sql(
            *TEXT_TABLE,
            f"f AS (SELECT line_no, length_ratio, ({_bucket_sql('line_no', 'fold42')} % 5)::INTEGER AS fold FROM text_table)",
            """s AS (SELECT k.fold, avg(f.length_ratio) AS m, stddev_pop(f.length_ratio) AS d
  FROM (SELECT DISTINCT fold FROM f) k JOIN f ON f.fold <> k.fold GROUP BY k.fold)""",
            select="SELECT line_no, f.fold, round((length_ratio - m) / d, 6) AS length_ratio FROM f JOIN s USING (fold)",
        ),
    ),
    "pruned_features": (
        pruned_features,
        with_sql(*CORRELATIONS, select="SELECT ordinal, feature FROM kept"),
    ),
    "collinear_pairs": (
        collinear_pairs,
        with_sql(*CORRELATIONS, select="SELECT earlier, later, round(r, 6) AS r FROM high_pairs"),
    ),
    "feature_job": (
        feature_job,
        with_sql(
            *CORRELATIONS,
            select=f"SELECT line_no, feature, {rounded_feature_sql('value')} FROM long_form WHERE feature IN (SELECT feature FROM kept)",
        ),
    ),
    "regression_metrics": (
        regression_metrics,
        with_sql(
            *PREDICTIONS,
            select="SELECT round(avg(abs(pred_ratio - score)), 6) AS mae, round(sqrt(avg((pred_ratio - score) ** 2)), 6) AS rmse, "
            "round(1 - sum((pred_ratio - score) ** 2) / (var_pop(score) * count(*)), 6) AS r2 FROM predictions",
        ),
    ),
    "rank_metrics": (
        rank_metrics,
        with_sql(
            *PREDICTIONS,
            """ranked AS (
  SELECT score, pred_ratio,
         rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS a,
         rank() OVER (ORDER BY pred_ratio) + (count(*) OVER (PARTITION BY pred_ratio) - 1) / 2 AS b FROM predictions)""",
            select="SELECT round(corr(score, pred_ratio), 6) AS pearson, round(corr(a, b), 6) AS spearman FROM ranked",
        ),
    ),
    "spearman_ranged": (
        spearman_ranged,
        with_sql(
            *TEXT_TABLE,
            """ranked AS (
  SELECT rank() OVER (ORDER BY hindi_length) + (count(*) OVER (PARTITION BY hindi_length) - 1) / 2 AS a,
         rank() OVER (ORDER BY vocab_diversity_hi) + (count(*) OVER (PARTITION BY vocab_diversity_hi) - 1) / 2 AS b
  FROM text_table)""",
            select="SELECT round(corr(a, b), 6) AS spearman FROM ranked",
        ),
    ),
    "metrics_by_split": (
        metrics_by_split,
        with_sql(
            *SPLIT_PREDICTIONS,
            select="SELECT model, split, metric, round(value, 6) AS value FROM metrics",
        ),
    ),
    "best_model": (
        best_model,
        with_sql(
            *SPLIT_PREDICTIONS,
            select=f"SELECT model, round(value, 6) AS value FROM metrics WHERE metric = 'mae' AND split = 'test' AND model = {BEST}",
        ),
    ),
    "sort_metrics": (
        sort_metrics,
        with_sql(
            *SPLIT_PREDICTIONS,
            select="SELECT model, round(mae, 6) AS mae, round(rmse, 6) AS rmse, round(r2, 6) AS r2, round(pearson, 6) AS pearson, "
            "round(spearman, 6) AS spearman FROM wide_metrics WHERE split = 'test' ORDER BY wide_metrics.mae, model",
        ),
    ),
    "metrics_transpose": (
        metrics_transpose,
        with_sql(
            *SPLIT_PREDICTIONS,
            select="SELECT metric, round(max(value) FILTER (model = 'ratio'), 6) AS ratio, "
            "round(max(value) FILTER (model = 'overlap'), 6) AS overlap FROM metrics WHERE split = 'test' GROUP BY metric",
        ),
    ),
    "fold_average": (
        fold_average,
        with_sql(
            *PREDICTIONS,
            f"""folds AS (
  SELECT {_bucket_sql('line_no', 'fold42')} % 5 AS fold, params, score, pred FROM predictions,
  LATERAL (VALUES ('pred_ratio', pred_ratio), ('pred_overlap', pred_overlap)) m(params, pred)),
per_fold AS (
  SELECT params, fold, sqrt(avg((pred - score) ** 2)) AS rmse, avg(abs(pred - score)) AS mae FROM folds GROUP BY params, fold)""",
            select="SELECT params, round(avg(rmse), 6) AS mean_rmse, round(avg(mae), 6) AS mean_mae, count(*) AS folds "
            "FROM per_fold GROUP BY params",
        ),
    ),
    "training_summary": (
        training_summary,
        with_sql(
            *SPLIT_PREDICTIONS,
            select=f"""SELECT 'dataset size' AS item, count(*)::DOUBLE AS value, NULL::VARCHAR AS text FROM doc_pairs
UNION ALL SELECT 'features', {len(FEATURES)}::DOUBLE, NULL
UNION ALL SELECT 'split ' || {_split_sql('line_no')}, count(*)::DOUBLE, NULL FROM doc_pairs GROUP BY 1
UNION ALL SELECT model || ' ' || metric, round(value, 6), NULL FROM metrics WHERE split = 'test'
UNION ALL SELECT 'best model', round(value, 6), model FROM metrics WHERE metric = 'mae' AND split = 'test' AND model = {BEST}""",
        ),
    ),
    "evaluation_metrics": (
        evaluation,
        with_sql(
            *PREDICTIONS,
            """w AS (
  SELECT model, avg(abs(pred - score)) AS mae, sqrt(avg((pred - score) ** 2)) AS rmse,
         1 - sum((pred - score) ** 2) / (var_pop(score) * count(*)) AS r2
  FROM predictions, LATERAL (VALUES ('ratio', pred_ratio), ('overlap', pred_overlap)) m(model, pred) GROUP BY model)""",
            select="SELECT model, metric, round(value, 6) AS value FROM (UNPIVOT w ON mae, rmse, r2 INTO NAME metric VALUE value)",
        ),
    ),
    "evaluation_line": (
        evaluation_line,
        with_sql(
            *TEXT_TABLE,
            f"t AS (SELECT {_split_sql('line_no')} AS split, length_ratio AS x, {TARGET} AS y FROM text_table)",
            "fit AS (SELECT regr_slope(y, x) AS slope, regr_intercept(y, x) AS start FROM t WHERE split = 'train')",
            """w AS (SELECT 'linear' AS model, split, avg(abs(p - y)) AS mae, sqrt(avg((p - y) ** 2)) AS rmse,
  1 - sum((p - y) ** 2) / (var_pop(y) * count(*)) AS r2, corr(y, p) AS pearson
  FROM (SELECT split, y, start + slope * x AS p FROM t, fit) GROUP BY split)""",
            select="""SELECT model, split, metric, round(value, 6) AS value FROM (
  UNPIVOT w ON mae, rmse, r2, pearson INTO NAME metric VALUE value) WHERE split = 'test' OR metric <> 'pearson'""",
        ),
    ),
    "system_compare": (
        system_compare,
        with_sql(
            *SYSTEM_SCORES,
            select="SELECT system, round(avg(predicted_score), 6) AS mean_score, count(*) AS pairs FROM scored GROUP BY system",
        ),
    ),
    "rank_systems": (rank_systems, _RANK_SYSTEMS),
    "rank_systems_plain": (rank_systems_plain, _RANK_SYSTEMS),
    "linear_fit": (
        linear_fit,
        with_sql(
            *TEXT_TABLE,
            select=f"""SELECT line_no, round(slope, 6) AS slope, round(intercept, 6) AS intercept,
  round(intercept + slope * length_ratio, 6) AS predicted
FROM text_table, (SELECT regr_slope({TARGET}, length_ratio) AS slope, regr_intercept({TARGET}, length_ratio) AS intercept FROM text_table)""",
        ),
    ),
    "importance": (
        importance,
        with_sql(
            *TEXT_TABLE,
            select=" UNION ALL ".join(
                f"SELECT '{c}' AS feature, round(avg(abs({c})), 6) AS importance FROM text_table"
                for c in TEXT_COLUMNS
            ),
        ),
    ),
    "fit_linear": (fit_linear, None),
    "fit_random_forest": (fit_random_forest, None),
    "fit_gbt": (fit_gbt, None),
    "fit_network": (fit_network, None),
    "fit_residual_network": (fit_residual_network, None),
    "fit_embedding_regressor": (fit_embedding_regressor, None),
    "fit_bilinear": (fit_bilinear, None),
    "grid_search": (search, None),
    "grid_search_path_features": (path_search_features, None),
    "tree_attributions": (tree_attributions, None),
    "tree_importance": (tree_importance, None),
    "grid_search_path": (
        path_search,
        with_sql(
            *TEXT_TABLE,
            f"f AS (SELECT length_ratio AS x, {TARGET} AS y, {_bucket_sql('line_no', 'fold42')} % 5 AS fold FROM text_table)",
            """t AS (SELECT k.fold, avg(x) AS mx, avg(y) AS my, stddev_pop(x) AS dx, stddev_pop(y) AS dy, covar_pop(x, y) AS c
  FROM (SELECT DISTINCT fold FROM f) k JOIN f ON f.fold <> k.fold GROUP BY k.fold)""",
            "p(params, a, b) AS (VALUES "
            + ", ".join(
                f"""('{{"regParam": {r}, "elasticNetParam": {e}}}', {r * e}::DOUBLE, {r * (1 - e)}::DOUBLE)"""
                for r in PENALTIES["regParam"]
                for e in PENALTIES["elasticNetParam"]
            )
            + ")",
            """l AS (SELECT params, fold, mx, my, dy / dx * sign(c) * greatest(abs(c / (dx * dy)) - a, 0) / (1 + b) AS slope FROM t, p)""",
            "e AS (SELECT params, fold, sqrt(avg((my + slope * (x - mx) - y) ** 2)) AS rmse FROM f JOIN l USING (fold) GROUP BY params, fold)",
            select="SELECT params, round(avg(rmse), 6) AS mean_rmse, count(*) AS folds FROM e GROUP BY params",
        ),
    ),
    "linear_attributions": (linear_attributions, None),
    "shapley_importance": (shapley_importance, None),
    "score_pairs": (scored_pairs, None),
    "score_pairs_line": (
        scored_by_line,
        with_sql(
            *LINE_SCORES,
            select="SELECT line_no, round(s, 6) AS predicted_score, round(s - 1.96 * 0.1 * abs(s), 6) AS confidence_lower, "
            "round(s + 1.96 * 0.1 * abs(s), 6) AS confidence_upper FROM line_scores",
        ),
    ),
    "reloaded_model_scores": (
        reloaded_model_scores,
        with_sql(*LINE_SCORES, select="SELECT line_no, round(s, 6) AS predicted_score FROM line_scores"),
    ),
    "score_pairs_missing_text": (
        scored_missing_text,
        with_sql(
            *LINE_SCORES,
            select="SELECT line_no, CASE WHEN line_no % 7 > 0 THEN round(s, 6) END AS predicted_score FROM line_scores",
        ),
    ),
    "score_stream": (
        scored_stream,
        with_sql(*LINE_SCORES, select="SELECT line_no, round(s, 6) AS predicted_score FROM line_scores"),
    ),
    "filtered_corpus": (
        filtered_corpus,
        with_sql(
            *LINE_SCORES,
            select="SELECT line_no, round(s, 6) AS predicted_score FROM line_scores WHERE s >= 1.13::DOUBLE",
        ),
    ),
    "evaluate_translator": (
        translated_pairs,
        with_sql(
            *LINE_SCORES,
            select="SELECT line_no, round(start + slope * (length(source) / (length('» ' || lower(source)) + 1)), 6) AS predicted_score "
            "FROM doc_pairs, line",
        ),
    ),
    "linear_attributions_line": (
        line_attributions,
        with_sql(
            *LINE_SCORES,
            f"""background AS (SELECT avg(length_ratio) AS middle FROM (
  SELECT length_ratio FROM text_table ORDER BY {_hash_sql('line_no', 'samplebackground42')}, line_no LIMIT 50))""",
            select=f"""SELECT line_no, round(slope * (length_ratio - middle) / (SELECT stddev_pop({TARGET}) FROM text_table), 6) AS length_ratio
FROM text_table, line, background""",
        ),
    ),
    "grid_search_line": (
        line_search,
        with_sql(
            *LINE_SEARCH,
            select="""SELECT params, round(avg(rmse), 6) AS mean_rmse, round(avg(mae), 6) AS mean_mae, count(*) AS folds
FROM e, (VALUES ('{"regParam": 0.0, "fitIntercept": true}'), ('{"regParam": 0.0, "fitIntercept": false}')) p(params)
GROUP BY params""",
        ),
    ),
    "params_round_trip": (
        params_round_trip,
        with_sql(
            *LINE_SEARCH,
            select="""SELECT 'linear' AS model, '{"regParam": 0.0, "fitIntercept": true}' AS best_params, round(avg(rmse), 6) AS best_cv_rmse FROM e""",
        ),
    ),
}
