import json
import math
import time
from itertools import combinations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pairscore.operators import bilinear, metrics, network, regress, shapley
from pairscore.operators.network import Shape, fit_mlp
from pairscore.operators.scaling import Scaler
from pairscore.operators.tuning import grid, grid_search
from pairscore.plans.features import RatioRange, all_features, build_features
from pairscore.plans.scoring import compare_systems, evaluate, evaluate_splits, score_pairs
from pairscore.schema import FEATURES
from pairscore.session import work_folder
from pairscore.sources import store
from pairscore.sources.store import ScoringPipeline, load_pipeline, save_pipeline
from pairscore.sources.tables import write_table
from pairscore.streaming.scoring import read_pair_stream, score_stream

NAMES = ["f0", "f1", "f2"]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 3)) * [1.0, 5.0, 0.1] + [0.0, 2.0, 1.0]
    y = 1.1 + 0.02 * x[:, 0] - 0.01 * x[:, 1] + 0.05 * np.abs(x[:, 2] - 1.0)
    frame = pd.DataFrame(x, columns=NAMES).assign(line_no=range(600), ccmatrix_score=y)
    return spark.createDataFrame(frame).repartition(4).cache()


@pytest.fixture(scope="module")
def pairs(spark):
    rng = np.random.default_rng(2)
    words = ["आज", "स्कूल", "किताब", "one", "two", "45%", "है।"]
    signs = list("雨停了商店九点开门河山。, 12a")
    rows = []
    for i in range(120):
        s = " ".join(rng.choice(words, size=rng.integers(1, 12)))
        t = "".join(rng.choice(signs, size=rng.integers(1, 30)))
        rows.append((i, s, t, 1.06 + 0.18 * min(len(s), len(t)) / max(len(s), len(t))))
    return spark.createDataFrame(rows, "line_no long, source string, target string, score double")


def test_linear_model_recovers_least_squares(table):
    frame = table.toPandas().sort_values("line_no")
    fitted = regress.fit_regressor(table, "linear", NAMES)
    got = fitted.predict(table).orderBy("line_no").toPandas()["predicted_score"]
    x = np.column_stack([frame[NAMES], np.ones(len(frame))])
    expected = x @ np.linalg.lstsq(x, frame["ccmatrix_score"], rcond=None)[0]
    assert np.allclose(got, expected, atol=1e-9)
    with pytest.raises(ValueError, match="unknown model"):
        regress.fit_regressor(table, "forest", NAMES)


@pytest.mark.parametrize("residual", [False, True])
def test_gradient_against_differences(residual):
    rng = np.random.default_rng(0)
    shape = Shape(3, 5, 2, residual)
    flat = shape.start(3) + rng.normal(size=shape.size()) * 0.1
    x, y = rng.normal(size=(7, 3)), rng.normal(size=7)
    grad, squared, absolute = shape.gradient(flat, x, y, 0.0, rng)
    error = shape.forward(flat, x) - y
    assert squared == pytest.approx(float(error @ error))
    assert absolute == pytest.approx(float(np.abs(error).sum()))
    for i in range(0, shape.size(), 3):
        step = np.zeros(shape.size())
        step[i] = 1e-6
        up, down = (float(((shape.forward(flat + d, x) - y) ** 2).sum()) for d in (step, -step))
        assert grad[i] == pytest.approx((up - down) / 2e-6, rel=1e-4, abs=1e-5)


@pytest.mark.parametrize("batch_size", [None, 16])
def test_network_does_not_depend_on_partitions(table, batch_size):
    options = dict(
        hidden_dim=8, num_layers=2, dropout=0.2 if batch_size else 0.0, learning_rate=0.01, epochs=4, batch_size=batch_size, shard_rows=60
    )
    one = fit_mlp(table.coalesce(1), NAMES, **options)
    many = fit_mlp(table.repartition(4), NAMES, **options)
    assert np.allclose(one.weights, many.weights, atol=1e-9)
    assert one.history[-1]["loss"] < one.history[0]["loss"]
    assert many.history_table(table).count() == 4


def test_network_stops_early_and_keeps_the_best(table):
    fitted = fit_mlp(
        table, NAMES, hidden_dim=4, num_layers=1, learning_rate=0.5, epochs=30, patience=2, dropout=0.3
    )
    losses = [h["val_loss"] for h in fitted.history]
    assert len(losses) < 30
    got = fitted.predict(table).select("predicted_score").toPandas()["predicted_score"]
    assert got.notna().all()


def _exact_shapley(function, x, background):
    """Attributions by the definition, over all subsets."""
    m = len(x)

    def value(subset):
        mixed = background.copy()
        mixed[:, list(subset)] = x[list(subset)]
        return function(mixed).mean()

    out = np.zeros(m)
    for i in range(m):
        others = [j for j in range(m) if j != i]
        for size in range(m):
            for s in combinations(others, size):
                weight = math.factorial(size) * math.factorial(m - size - 1) / math.factorial(m)
                out[i] += weight * (value((*s, i)) - value(s))
    return out


def test_shapley_against_the_definition(table):
    rows = table.filter("line_no < 5")
    scaler = Scaler(NAMES, [0.0, 2.0, 1.0], [1.0, 5.0, 0.1])
    shape = Shape(3, 6, 2)
    flat = shape.start(5)
    function = lambda x: shape.forward(flat, x)
    background = shapley.background_rows(table, NAMES, scaler, n=10)
    assert background.shape == (10, 3)
    got = shapley.shapley(rows, function, NAMES, scaler, background).collect()
    scaled = {r["line_no"]: np.array(r[1:]) for r in scaler.transform(rows).select("line_no", *NAMES).collect()}
    for r in got:
        x = scaled[r["line_no"]]
        phi = np.array([r[c] for c in NAMES])
        assert phi == pytest.approx(_exact_shapley(function, x, background), abs=1e-8)
        assert phi.sum() == pytest.approx(r["prediction"] - r["base_value"], abs=1e-9)


def test_sampled_shapley_adds_up_and_agrees_for_linear_models(table):
    fitted = regress.fit_regressor(table, "linear", NAMES)
    background = shapley.background_rows(table, NAMES, fitted.feature_scaler)
    weights = fitted.model.coefficients.toArray()
    function = lambda x: x @ weights + fitted_intercept
    fitted_intercept = float(fitted.model.intercept)
    rows = table.filter("line_no < 20")
    sampled = shapley.shapley(rows, function, NAMES, fitted.feature_scaler, background)
    closed = shapley.linear_shapley(rows, fitted, background)
    a, b = (d.orderBy("line_no").toPandas() for d in (sampled, closed))
    assert np.allclose(a[[*NAMES, "prediction"]], b[[*NAMES, "prediction"]], atol=1e-9)
    top = shapley.importance(closed, NAMES).collect()
    assert [r["importance"] for r in top] == sorted((r["importance"] for r in top), reverse=True)


def test_many_features_are_sampled_within_the_budget():
    z, w = shapley.coalitions(20, budget=500)
    assert len(z) <= 500 + 1 and len(z) == len(w)
    assert ((z.sum(axis=1) > 0) & (z.sum(axis=1) < 20)).all()
    linear = np.arange(20.0)
    phi = shapley.solver(z, w) @ (z @ linear - z[:, -1] * linear.sum())
    assert np.allclose([*phi, linear.sum() - phi.sum()], linear)


def test_grid_order_and_first_of_a_tie(table):
    assert grid({"a": [1, 2], "b": [3, 4]}) == [
        {"a": 1, "b": 3},
        {"a": 1, "b": 4},
        {"a": 2, "b": 3},
        {"a": 2, "b": 4},
    ]
    found = grid_search(table, "linear", NAMES, {"regParam": [0.5, 0.0], "maxIter": [10, 20]}, k=3)
    assert found.best_params == {"regParam": 0.0, "maxIter": 10}
    best = found.averages.filter(F.col("params") == json.dumps(found.best_params)).first()
    assert best["mean_rmse"] == pytest.approx(found.best_cv_rmse)
    assert found.folds.count() == 12 and best["folds"] == 3


def test_grid_search_of_a_network(table):
    space = {"hidden_dim": [4], "num_layers": [1], "dropout": [0.0], "learning_rate": [0.05], "epochs": [2]}
    found = grid_search(table, "mlp", NAMES, space, k=2, parallelism=2)
    assert found.best_params["hidden_dim"] == 4 and found.best_cv_rmse > 0


def test_pipeline_round_trip_stream_and_systems(spark, pairs):
    job = build_features(pairs)
    assert set(job.features) | set(job.pruned.dropped) == set(FEATURES)
    assert job.table.columns == ["line_no", *job.features, "ccmatrix_score"]
    fitted = regress.fit_regressor(job.table, "linear", job.features, params={"regParam": 0.01})
    pipeline = ScoringPipeline(fitted, job.lm, job.ratio_range)
    batch = score_pairs(pairs, pipeline)
    expected = {r["line_no"]: r["predicted_score"] for r in batch.collect()}
    assert len(expected) == 120
    # scoring uses the features of training
    trained = {r["line_no"]: r["p"] for r in fitted.predict(job.table, "p").collect()}
    assert all(expected[k] == pytest.approx(trained[k], abs=1e-9) for k in trained)

    path = work_folder(spark, "test-pipeline")
    save_pipeline(spark, pipeline, path)
    loaded = load_pipeline(spark, path)
    again = {r["line_no"]: r["predicted_score"] for r in score_pairs(pairs, loaded).collect()}
    assert again == expected

    folder = work_folder(spark, "test-stream")
    write_table(pairs.filter("line_no < 50"), f"{folder}/in")
    stream = read_pair_stream(spark, f"{folder}/in", pairs.schema)

    def run():
        score_stream(stream, loaded, f"{folder}/out", f"{folder}/state", once=True).awaitTermination()
        return {r["line_no"]: r["predicted_score"] for r in spark.read.parquet(f"{folder}/out").collect()}

    assert run() == {k: v for k, v in expected.items() if k < 50}
    write_table(pairs.filter("line_no >= 50"), f"{folder}/in", mode="append")
    assert run() == expected  # the second run scores only what is new

    outputs = pairs.withColumn("system", F.concat(F.lit("s"), F.col("line_no") % 3)).withColumn(
        "source", F.lit("one source")
    )
    means, ranked = compare_systems(outputs, loaded)
    assert {r["system"]: r["pairs"] for r in means.collect()} == {"s0": 40, "s1": 40, "s2": 40}
    assert sorted(r["rank"] for r in ranked.collect()) == list(range(1, 121))


def test_saved_network_and_missing_parts(spark, table, pairs):
    lm = build_features(pairs, features=["length_ratio"]).lm
    fitted = fit_mlp(table, NAMES, hidden_dim=4, num_layers=2, residual=True, epochs=2)
    path = work_folder(spark, "test-network")
    save_pipeline(spark, ScoringPipeline(fitted, lm, RatioRange(0.1, 2.0)), path)
    loaded = load_pipeline(spark, path)
    assert loaded.ratio_range == RatioRange(0.1, 2.0)
    assert np.array_equal(loaded.fitted.weights, fitted.weights)
    assert loaded.fitted.history == fitted.history
    evaluated = evaluate(table, {"net": loaded.fitted}).first()
    assert evaluated["err_net"] == pytest.approx(evaluated["pred_net"] - evaluated["ccmatrix_score"])
    with pytest.raises(FileNotFoundError):
        load_pipeline(spark, f"{path}/nothing-here")


def test_empty_target_is_scored_with_defaults(spark, pairs):
    job = build_features(pairs, features=["length_ratio", "chinese_perplexity"])
    fitted = regress.fit_regressor(job.table, "linear", job.features)
    odd = spark.createDataFrame([(0, "a b", "")], "line_no long, source string, target string")
    row = score_pairs(odd, ScoringPipeline(fitted, job.lm, job.ratio_range), keep_features=True).first()
    assert row["chinese_perplexity"] == 30.0 and row["signals_filled"] == 1
    assert row["confidence_lower"] < row["predicted_score"] < row["confidence_upper"]


def test_plan_without_fitted_range_equals_fitted(pairs):
    job = build_features(pairs)
    lazy = all_features(pairs, job.lm).select("line_no", "length_ratio_normalized")
    fitted = all_features(pairs, job.lm, job.ratio_range).select("line_no", "length_ratio_normalized")
    assert sorted(map(tuple, lazy.collect())) == sorted(map(tuple, fitted.collect()))


def test_metrics_of_every_split(table):
    from pairscore.operators.sampling import split_train_val_test

    split = split_train_val_test(table)
    fitted = regress.fit_regressor(split.filter("split = 'train'"), "linear", NAMES)
    rows = evaluate_splits(split, {"line": fitted}).collect()
    assert {(r["split"], r["metric"]) for r in rows} == {
        *((s, m) for s in ("train", "val", "test") for m in ("mae", "rmse", "r2")),
        ("test", "pearson"),
        ("test", "spearman"),
    }


def test_embedding_regressor(spark):
    rng = np.random.default_rng(0)
    rows = [(i, v[:2].tolist(), v[2:].tolist(), float(v @ [1, 2, 3, 4])) for i, v in enumerate(rng.normal(size=(50, 4)))]
    df = spark.createDataFrame(rows, "line_no long, a array<float>, b array<float>, ccmatrix_score double")
    fitted = regress.fit_embedding_regressor(df, "a", "b")
    for r in fitted.predict(df).collect():
        assert r["predicted_score"] == pytest.approx(r["ccmatrix_score"], abs=1e-5)


def _interacting(spark, n=600):
    rng = np.random.default_rng(4)
    u, w = rng.normal(2, 3, (n, 6)), rng.normal(-1, 0.5, (n, 5))
    p, q = rng.normal(size=(2, 6)), rng.normal(size=(2, 5))
    y = 3 + u @ np.arange(6) / 9 + ((u - 2) @ p.T * ((w + 1) @ q.T)).sum(axis=1)
    rows = [(i, a.tolist(), b.tolist(), float(v)) for i, (a, b, v) in enumerate(zip(u, w, y))]
    return spark.createDataFrame(rows, "id long, a array<double>, b array<double>, y double").repartition(7)


def test_bilinear_finds_a_product_that_a_line_cannot(spark, tmp_path):
    df = _interacting(spark)
    train, test = df.filter("id < 450"), df.filter("id >= 450")
    line = regress.fit_embedding_regressor(train, "a", "b", "y")
    fitted = bilinear.fit_bilinear(train, "a", "b", "y", rank=2, ridge=1e-9)
    r2 = {m: metrics.regression_metrics(f.predict(test, "p"), "y", "p").first()["r2"] for m, f in (("line", line), ("product", fitted))}
    assert r2["product"] > 0.999 and r2["product"] > r2["line"] + 0.2
    assert all(b <= a + 1e-9 for a, b in zip(fitted.errors, fitted.errors[1:]))
    for name, model in (("line", line), ("product", fitted)):
        store.save_vector_model(spark, model, str(tmp_path / name))
        back = store.load_vector_model(spark, str(tmp_path / name))
        there = {r["id"]: r["p"] for r in back.predict(test, "p").collect()}
        assert there == {r["id"]: pytest.approx(r["p"], rel=1e-12) for r in model.predict(test, "p").collect()}
    with pytest.raises(FileNotFoundError):
        store.load_vector_model(spark, str(tmp_path / "none"))


def test_bilinear_does_not_depend_on_partitions_or_odd_rows(spark):
    df = _interacting(spark, 120)
    odd = spark.createDataFrame(
        [(900, None, [1.0] * 5, 1.0), (901, [1.0] * 6, [1.0] * 4 + [None], 1.0), (902, [float("nan")] * 6, [1.0] * 5, 1.0), (903, [1.0] * 6, [1.0] * 5, None)],
        df.schema,
    )
    one = bilinear.fit_bilinear(df.coalesce(1), "a", "b", "y", rank=2, rounds=3)
    many = bilinear.fit_bilinear(df.repartition(9).unionByName(odd), "a", "b", "y", rank=2, rounds=3)
    wide = spark.createDataFrame([(904, [1.0] * 7, [1.0] * 5, 1.0)], df.schema)
    made = [{r["id"]: r["p"] for r in m.predict(df.unionByName(odd).unionByName(wide), "p").collect()} for m in (one, many)]
    assert [made[0][i] for i in (900, 901, 902, 904)] == [None] * 4 and made[0][903] is not None
    assert made[0] == {i: v if v is None else pytest.approx(v, rel=1e-6) for i, v in made[1].items()}
    with pytest.raises(ValueError, match="several lengths"):
        bilinear.fit_bilinear(df.unionByName(wide), "a", "b", "y")
    with pytest.raises(ValueError, match="no row"):
        bilinear.fit_bilinear(df.limit(0), "a", "b", "y")


def test_tree_importance(table):
    fitted = regress.fit_regressor(table, "random_forest", NAMES, params={"numTrees": 5, "seed": 1})
    rows = regress.tree_importance(fitted, table, 2).collect()
    assert len(rows) == 2 and rows[0]["importance"] >= rows[1]["importance"]


@pytest.mark.parametrize("kind", ["linear", "random_forest", "gbt"])
def test_exported_models_predict_the_same(table, kind):
    params = {"random_forest": {"numTrees": 5, "seed": 1}, "gbt": {"maxIter": 4, "seed": 1}}.get(kind)
    fitted = regress.fit_regressor(table, kind, NAMES, params=params)
    scaled = table.select(*[fitted.feature_scaler.scaled(c).alias(c) for c in NAMES]).toPandas().to_numpy()
    own = fitted.scaled_function()(scaled)
    spread, middle = fitted.target_scaler.scale[0], fitted.target_scaler.mean[0]
    there = np.array([r[0] for r in fitted.predict(table, "p").select("p").collect()])
    assert own * spread + middle == pytest.approx(there, abs=1e-9)


def test_trees_are_explained_by_the_kernel(table):
    fitted = regress.fit_regressor(table, "gbt", NAMES, params={"maxIter": 3, "seed": 1})
    background = shapley.background_rows(table, NAMES, fitted.feature_scaler, n=8)
    rows = table.filter("line_no < 4")
    function = fitted.scaled_function()
    got = shapley.shapley(rows, function, NAMES, fitted.feature_scaler, background).collect()
    scaled = {r["line_no"]: np.array(r[1:]) for r in fitted.feature_scaler.transform(rows).select("line_no", *NAMES).collect()}
    for r in got:
        phi = np.array([r[c] for c in NAMES])
        assert phi == pytest.approx(_exact_shapley(function, scaled[r["line_no"]], background), abs=1e-8)


def test_tree_attributions_equal_the_sum_over_all_coalitions(spark):
    rng = np.random.default_rng(5)
    names = [f"g{i}" for i in range(6)]
    x = rng.normal(size=(300, 6))
    y = x[:, 0] * (x[:, 1] > 0) + np.abs(x[:, 2]) - x[:, 3] * x[:, 4]
    table = spark.createDataFrame(pd.DataFrame(x, columns=names).assign(line_no=range(300), ccmatrix_score=y))
    for kind, params in (("gbt", {"seed": 1, "maxIter": 6, "maxDepth": 4}), ("random_forest", {"seed": 1, "numTrees": 5}), ("gbt", {"maxDepth": 0, "maxIter": 1})):
        fitted = regress.fit_regressor(table, kind, names, params=params)
        function = fitted.scaled_function()
        background = shapley.background_rows(table, names, fitted.feature_scaler, n=12)
        rows = table.filter("line_no < 15").repartition(3)
        got = shapley.tree_shapley(rows, fitted, background).collect()
        scaled = {r["line_no"]: [r[c] for c in names] for r in fitted.feature_scaler.transform(rows).collect()}
        assert len(got) == 15
        for r in got:
            phi = np.array([r[c] for c in names])
            assert phi == pytest.approx(_exact_shapley(function, np.array(scaled[r["line_no"]]), background), abs=1e-9)
            assert phi.sum() == pytest.approx(r["prediction"] - r["base_value"], abs=1e-9)


def test_fold_statistics_merge_to_those_of_the_rows(table):
    from pairscore.operators import foldstats, sampling
    from pairscore.operators.scaling import fit_scaler

    columns = [*NAMES, "ccmatrix_score"]
    folded = sampling.kfold(table, 4)
    scalers = foldstats.fold_scalers(folded.repartition(7), columns)
    for fold, scaler in scalers.items():
        want = fit_scaler(folded.filter(F.col("fold") != fold), columns)
        assert scaler.mean == pytest.approx(want.mean, abs=1e-12) and scaler.scale == pytest.approx(want.scale, abs=1e-12)
    still = folded.withColumn("f0", F.lit(3.0)).withColumn("f1", F.when(F.col("line_no") % 5 > 0, F.col("f1")))
    made = foldstats.fold_moments(still, columns)
    assert sum(m.n for m in made.values()) == 480
    assert made[0].scaler(columns).scale[0] == 1.0
    assert foldstats.fold_moments(folded.limit(0), columns) == {}


@pytest.mark.parametrize("strength, mix", [(0.0, 0.0), (0.1, 0.0), (0.05, 1.0), (0.02, 0.5)])
def test_linear_path_equals_the_fitted_model(table, strength, mix):
    from pairscore.operators import foldstats
    from pairscore.operators.metrics import regression_metrics

    columns = [*NAMES, "ccmatrix_score"]
    whole = foldstats.fold_moments(table.withColumn("fold", F.lit(0)), columns)[0]
    line = foldstats.linear_path(whole, columns, [(1.0, mix), (strength, mix)])[1]
    fitted = regress.fit_regressor(table, "linear", NAMES, params={"regParam": strength, "elasticNetParam": mix, "tol": 1e-10})
    assert line.coefficients == pytest.approx(fitted.model.coefficients.toArray(), abs=1e-6)
    found = regression_metrics(fitted.predict(table, "p"), "ccmatrix_score", "p").first()["rmse"]
    assert (line.squared_error(whole) / whole.n) ** 0.5 == pytest.approx(found, rel=1e-6)


def test_path_search_equals_the_grid_search(table):
    from pairscore.operators import foldstats

    found = foldstats.search_linear_path(table, NAMES, [0.0, 0.2], [0.0], k=3)
    slow = grid_search(table, "linear", NAMES, {"regParam": [0.0, 0.2], "elasticNetParam": [0.0]}, k=3)
    assert found.best_params == slow.best_params
    assert found.best_cv_rmse == pytest.approx(slow.best_cv_rmse, rel=1e-8)
    want = {(json.loads(r["params"])["regParam"], r["fold"]): r["rmse"] for r in slow.folds.collect()}
    assert len(want) == 6
    for r in found.folds.collect():
        assert r["rmse"] == pytest.approx(want[json.loads(r["params"])["regParam"], r["fold"]], rel=1e-8)


def test_mini_batches_beat_a_line_on_a_curve(table):
    from pairscore.plans.scoring import evaluation_metrics

    train, test = table.filter("line_no % 5 > 0"), table.filter("line_no % 5 = 0")
    models = {
        "line": regress.fit_regressor(train, "linear", NAMES),
        "mlp": fit_mlp(train, NAMES, hidden_dim=32, num_layers=2, dropout=0.05, learning_rate=5e-3, batch_size=32, shard_rows=200, epochs=40),
    }
    r2 = {r["model"]: r["value"] for r in evaluation_metrics(evaluate(test, models), list(models)).collect() if r["metric"] == "r2"}
    assert r2["mlp"] > max(r2["line"], 0.8)


def test_many_shards_are_averaged_up_a_tree(table, monkeypatch):
    from pairscore.operators import network

    options = dict(hidden_dim=4, num_layers=1, dropout=0.1, epochs=2, batch_size=8, shard_rows=25)
    flat = fit_mlp(table, NAMES, **options)
    monkeypatch.setattr(network, "FAN_IN", 3)
    assert np.allclose(fit_mlp(table, NAMES, **options).weights, flat.weights, atol=1e-12)


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().toList()
    return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle")}


def test_network_epoch_sends_one_state_and_leaves_no_shuffle(spark, table, monkeypatch):
    """The states of many shards come to the driver added up, and the files of the adding don't pile up by epochs."""
    sent, collect = [], type(table).collect

    def noting(df):
        rows = collect(df)
        sent.append(len(rows))
        return rows

    count, shape = 100, network.Shape(3, 4, 2)
    x = F.array(*NAMES).alias("x")
    rows = table.select("line_no", (F.col("line_no") % 10 == 0).alias("held"), x, F.col("ccmatrix_score").alias("y"))
    packed = network.pack_shards(rows, "line_no", count, 42)
    assert packed.count() <= network.MOST_STATES
    start = network.Optimizer.start(shape.start(1))
    before = _shuffle_files(spark)
    monkeypatch.setattr(type(table), "collect", noting)
    state, made, held = network.run_epoch(packed, count, shape, start, 0, 4, 0.0, 0.01, 42)
    assert sent == [1] and (made[2], held[2]) == (540, 60)
    for _ in range(100):
        if not (left := _shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left
    monkeypatch.undo()
    # the state is the mean of the shards' own, weighted by their rows
    mean, seen = np.zeros(shape.size()), 0
    for row in packed.collect():
        for shard, n, xs, ys in zip(row["shard"], row["rows"], row["x"], row["y"]):
            if shard < count:
                own, rng = network.Optimizer.start(start.weights), np.random.default_rng([42, 0, shard])
                xs, ys, order = np.frombuffer(xs).reshape(n, 3), np.frombuffer(ys), rng.permutation(n)
                for at in range(0, n, 4):
                    mine = order[at : at + 4]
                    own.step(shape.gradient(own.weights, xs[mine], ys[mine], 0.0, rng)[0] / len(mine), 0.01)
                mean, seen = mean + own.weights * n, seen + n
    assert seen == 540 and np.allclose(state.weights, mean / seen, atol=1e-12)


def test_every_part_of_the_shards_is_a_task_of_its_own(spark, table, monkeypatch):
    """Parts that share a file or a task run one after the other while cores wait; the last epoch only judges."""
    from pairscore.session import FILE_COST, task_per_file

    collected, collect = [], type(table).collect
    monkeypatch.setattr(type(table), "collect", lambda df: collected.append(collect(df)) or collected[-1])
    x = F.array(*NAMES).alias("x")
    rows = table.select("line_no", (F.col("line_no") % 10 == 0).alias("held"), x, F.col("ccmatrix_score").alias("y"))
    packed = network.pack_shards(rows, "line_no", 100, 42)
    cost = spark.conf.get(FILE_COST)
    assert packed.count() == len(packed.inputFiles()) == 50
    with task_per_file(spark):
        assert packed.select("part").rdd.getNumPartitions() == 50
    assert spark.conf.get(FILE_COST) == cost
    shape = network.Shape(3, 4, 2)
    start = network.Optimizer.start(shape.start(1))
    after, made, held = network.run_epoch(packed, 100, shape, start, None, 4, 0.0, 0.01, 42)
    assert after is start and made[2] == 0 and held[2] == 60
    assert [len(r["total"]) for r in collected[-1]] == [7 * 8]


@pytest.mark.parametrize("residual", [False, True])
def test_steps_move_weights_in_place_by_the_formula(residual, monkeypatch):
    monkeypatch.setattr(network, "STEP_BLOCK", 7)
    rng = np.random.default_rng(3)
    shape = Shape(3, 5, 2, residual)
    given = [rng.normal(size=shape.size()), rng.normal(size=shape.size()), rng.random(shape.size())]
    weights, first, second = (a.copy() for a in given)
    own = network.Optimizer(*given, 2)
    place = own.weights
    for steps in (3, 4):
        x, y = rng.normal(size=(6, 3)), rng.normal(size=6)
        gradient = shape.gradient(own.weights, x, y, 0.3, rng)[0]
        own.step(gradient, 0.01, 6)
        first = 0.9 * first + (1 - 0.9) * (gradient / 6)
        second = 0.999 * second + (1 - 0.999) * (gradient / 6) * (gradient / 6)
        rate = 0.01 * math.sqrt(1 - 0.999**steps) / (1 - 0.9**steps)
        weights = weights - rate * first / (np.sqrt(second) + 1e-7)
        assert np.allclose(own.weights, weights, atol=1e-14) and own.steps == steps
    assert own.weights is place  # no new arrays of all weights, which took most of a step
    assert own.weights is not given[0] and not np.array_equal(own.weights, given[0])
