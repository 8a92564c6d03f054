import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pairscore.functions import derived, vectors
from pairscore.operators import collinear, filters, joins, metrics, profile, ranks, sampling, scaling
from pairscore.operators import quantiles as quantiles_module
from pairscore.operators.quantiles import quantile_values


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(7)
    frame = pd.DataFrame(
        {
            "line_no": range(5000),
            "x": rng.normal(size=5000),
            # a third of all rows share one value
            "tied": np.where(rng.random(5000) < 0.34, 1.0, rng.integers(0, 50, 5000)),
            "wide": np.exp(rng.normal(scale=8.0, size=5000)),
        }
    )
    return frame, spark.createDataFrame(frame).repartition(5).cache()


PROBS = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99, 1.0]


@pytest.mark.parametrize("options", [{}, {"sketch": 8, "per_bucket": 300}, {"sketch": 400}])
def test_quantiles_match_linear_interpolation(numbers, options):
    frame, df = numbers
    got = quantile_values(df, {c: PROBS for c in ("x", "tied", "wide")}, **options)
    assert len(got) == 3 * len(PROBS)
    for (c, q), value in got.items():
        assert value == pytest.approx(frame[c].quantile(q), rel=1e-9, abs=1e-12), (c, q)


def test_quantiles_skip_missing_values(spark):
    rows = [(1.0,), (None,), (float("nan"),), (3.0,)]
    got = quantile_values(spark.createDataFrame(rows, "x double"), {"x": [0.5]})
    assert got["x", 0.5] == 2.0


def test_a_bracket_that_misses_is_widened(numbers, monkeypatch):
    frame, df = numbers
    wrong = {("_column_0", 0.5): (-math.inf, -1.0), ("_column_0", 0.9): (50.0, 60.0), ("_column_1", 0.2): (7.5, 7.6)}
    monkeypatch.setattr(quantiles_module, "_sketched", lambda *args: wrong)
    got = quantile_values(df, {"x": [0.5, 0.9], "tied": [0.2]})
    assert got == pytest.approx({("x", 0.5): frame["x"].quantile(0.5), ("x", 0.9): frame["x"].quantile(0.9), ("tied", 0.2): frame["tied"].quantile(0.2)})


def test_quantiles_of_few_odd_values(spark):
    inf = float("inf")
    df = spark.createDataFrame([(inf, -0.0, 1, None), (-inf, 0.0, 2, None), (1.0, 0.0, 4, None)], "a double, b double, `_column_0` int, d double")
    got = quantile_values(df.repartition(3), {"a": [0.0, 0.5, 1.0], "b": [0.5], "_column_0": [0.25, 1.0], "d": [0.5]})
    assert got == {("a", 0.0): -inf, ("a", 0.5): 1.0, ("a", 1.0): inf, ("b", 0.5): 0.0, ("_column_0", 0.25): 1.5, ("_column_0", 1.0): 4.0, ("d", 0.5): None}


def test_describe_reads_a_stored_projection(numbers, monkeypatch):
    frame, df = numbers
    reads = []
    kept = quantiles_module.materialize
    monkeypatch.setattr(quantiles_module, "materialize", lambda d, label: reads.append(label) or kept(d, label))
    rows = {r["column"]: r for r in profile.describe(df, ["x", "tied", "wide"]).collect()}
    assert reads == ["quantile-columns"]
    for c, r in rows.items():
        d = frame[c].describe()
        wanted = [d["count"], d["mean"], d["std"], d["min"], d["25%"], d["50%"], d["75%"], d["max"]]
        assert list(r[1:]) == pytest.approx(wanted, rel=1e-9)


def test_quantile_of_nothing(spark):
    empty = spark.createDataFrame([], "x double")
    assert quantile_values(empty, {"x": [0.5]})["x", 0.5] is None


def test_sample_is_exact_and_independent_of_partitions(numbers):
    _, df = numbers
    for n in (1, 37, 2500, 4999):
        a = {r[0] for r in sampling.sample_n(df, n, 3).select("line_no").collect()}
        b = {r[0] for r in sampling.sample_n(df.coalesce(1), n, 3).select("line_no").collect()}
        assert len(a) == n and a == b
    assert sampling.sample_n(df, 6000, 3).count() == 5000
    assert sampling.sample_n(df, None, 3).count() == 5000


def test_holdout_and_folds_cover_the_rows(numbers):
    _, df = numbers
    sizes = {r["split"]: r["count"] for r in sampling.holdout(df, 0.1).groupBy("split").count().collect()}
    assert sizes == {"test": 500, "trainval": 4500}
    folds = sampling.kfold(df, 5).groupBy("fold").count().collect()
    assert {r["fold"] for r in folds} == set(range(5)) and sum(r["count"] for r in folds) == 5000
    parts = sampling.split_train_val_test(df).groupBy("split").count().collect()
    share = {r["split"]: r["count"] / 5000 for r in parts}
    assert share["train"] == pytest.approx(0.7, abs=0.03)
    assert share["val"] == pytest.approx(0.15, abs=0.02)


def test_lookup_with_a_hot_key_and_nulls(spark):
    rows = [(i, "hot" if i % 3 else None if i % 2 else f"k{i}") for i in range(6000)]
    df = spark.createDataFrame(rows, "line_no long, k string")
    table = spark.createDataFrame(
        [("hot", 1), *[(f"k{i}", i) for i in range(0, 6000, 12)]], "k string, v long"
    )
    for how in ("left", "inner"):
        plain = sorted(map(tuple, df.join(table, "k", how).collect()), key=str)
        spread = joins.lookup(df, table, "k", how, broadcast_rows=0)
        assert sorted(map(tuple, spread.collect()), key=str) == plain
        assert "_salt" in spread._jdf.queryExecution().toString()


def test_translate_falls_back(spark):
    df = spark.createDataFrame([(0, "a"), (1, "b"), (2, None)], "line_no long, source string")
    table = spark.createDataFrame([("a", "x")], "source string, translation string")
    got = {r["line_no"]: r["translation"] for r in joins.translate(df, table, "?").collect()}
    assert got == {0: "x", 1: "?", 2: "?"}


@pytest.mark.parametrize("per_bucket", [7, 500_000])
def test_average_ranks(numbers, per_bucket):
    frame, df = numbers
    for c in ("tied", "x"):
        counts = df.groupBy(c).agg(F.count("*").alias("n"))
        got = ranks.value_ranks(counts, c, "n", counts.count(), per_bucket)
        expected = frame[c].rank(method="average").groupby(frame[c]).first()
        for r in got.collect():
            assert r["rank"] == expected[r[c]]


@pytest.mark.parametrize("per_bucket", [10, 500_000])
def test_spearman(numbers, per_bucket):
    frame, df = numbers
    got = ranks.spearman(df, "x", "tied", per_bucket=per_bucket).first()[0]
    assert got == pytest.approx(frame["x"].rank().corr(frame["tied"].rank()), abs=1e-12)


def test_ranks_of_many_series_with_three_values_a_range(spark):
    rng = np.random.default_rng(5)
    frame = pd.DataFrame({"model": rng.choice(["m", "n", "o"], 900), "y": rng.integers(0, 80, 900) / 8.0})
    frame["pred"] = np.where(rng.random(900) < 0.4, 1.0, frame["y"] + rng.normal(0, 2, 900))
    frame.loc[::50, "pred"] = None
    df = spark.createDataFrame(frame).withColumn("pred", F.nanvl("pred", F.lit(None).cast("double")))
    counts = df.groupBy("model", "y").agg(F.count("*").alias("n"))
    got = ranks.value_ranks(counts, "y", "n", counts.count(), 3, ["model"]).collect()
    expected = frame.groupby("model")["y"].rank(method="average").groupby([frame["model"], frame["y"]]).first()
    assert {(r["model"], r["y"]): r["rank"] for r in got} == expected.to_dict()
    whole = frame.dropna()
    for per_bucket in (3, 500_000):
        found = {r["model"]: r["spearman"] for r in ranks.spearman_by(df, "model", "y", "pred", per_bucket=per_bucket).collect()}
        assert found == pytest.approx({m: g["y"].rank().corr(g["pred"].rank()) for m, g in whole.groupby("model")}, abs=1e-12)


def test_starts_of_ranges_need_no_window_over_all_of_them(spark):
    held = spark.range(2_000).selectExpr("id % 2 AS series", "id AS range_no", "id % 7 + 1 AS held")
    found = {(r["series"], r["range_no"]): r["start"] for r in ranks.range_starts(held, 2_000, ["series"]).collect()}
    run = {0: 0, 1: 0}
    for i in range(2_000):
        assert found[i % 2, i] == run[i % 2]
        run[i % 2] += i % 7 + 1


def test_spearman_of_nothing_is_null_and_null_groups_count(spark):
    df = spark.createDataFrame([(None, 1.0, 2.0), (None, 2.0, 1.0), ("a", 1.0, None), ("-", 1.0, 1.0), ("-", 2.0, 3.0)], "g string, a double, b double")
    assert ranks.spearman(df.limit(0), "a", "b").collect() == [(None,)]
    found = {r["g"]: r["spearman"] for r in ranks.spearman_by(df, "g", "a", "b").collect()}
    assert found == pytest.approx({None: -1.0, "-": 1.0})


def test_spearman_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "a double, b double")
    assert ranks.spearman(df, "a", "b").first()[0] is None


def test_rank_within_hot_groups_with_equal_scores(spark):
    rows = [(i, "g" if i % 3 else f"h{i % 7}", 1.0 if i % 2 else float(i % 11)) for i in range(3000)]
    df = spark.createDataFrame(rows, "line_no long, grp string, s double").repartition(6)
    plain = ranks.rank_within(df, "grp", "s", "line_no", hot_groups=[])
    ranged = ranks.rank_within(df, "grp", "s", "line_no")
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, ranged.collect()))


def test_describe_like_pandas(numbers):
    frame, df = numbers
    for r in profile.describe(df, ["x", "tied"]).collect():
        d = frame[r["column"]].describe()
        got = [r["count"], r["mean"], r["std"], r["min"], r["p25"], r["p50"], r["p75"], r["max"]]
        assert got == pytest.approx(list(d), rel=1e-9)


@pytest.mark.parametrize("column", ["x", "tied", "wide"])
def test_histogram_like_numpy(numbers, column):
    frame, df = numbers
    counts, edges = np.histogram(frame[column], bins=50)
    rows = sorted(profile.histogram(df, column, 50).collect(), key=lambda r: r["bin"])
    assert [r["count"] for r in rows] == list(counts)
    assert [r["bin_start"] for r in rows] == pytest.approx(list(edges[:-1]))
    density, _ = np.histogram(frame[column], bins=50, density=True)
    assert [r["density"] for r in rows] == pytest.approx(list(density))


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    rows = sorted(profile.histogram(df, "x", 4).collect(), key=lambda r: r["bin"])
    assert [r["count"] for r in rows] == list(np.histogram([2.0, 2.0], bins=4)[0])


def test_duplicates_count_nulls_as_equal(spark):
    rows = [("a", "x"), ("a", "x"), ("a", "y"), (None, "x"), (None, "x"), ("", "x")]
    df = spark.createDataFrame(rows, "source string, target string")
    frame = pd.DataFrame(rows, columns=["s", "t"])
    got = profile.duplicate_counts(df).first()
    assert got["duplicate_source"] == frame["s"].duplicated().sum()
    assert got["duplicate_target"] == frame["t"].duplicated().sum()
    assert got["duplicate_pairs"] == frame.duplicated().sum()


def test_issue_counts_add_both_sides(spark):
    df = spark.createDataFrame([("ab", "cd"), ("a" * 600, "b" * 700)], "source string, target string")
    got = profile.issue_counts(df).first()
    assert (got["very_short"], got["very_long"]) == (2, 2)


def test_correlation_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(0.1, 1.0), (0.1, 2.0), (0.1, 4.0)], "a double, b double")
    assert profile.corr(df, "a", "b").first()[0] is None
    matrix = {(r["a"], r["b"]): r["r"] for r in profile.corr_matrix(df, ["a", "b"]).collect()}
    assert matrix["a", "b"] is None and matrix["b", "b"] == pytest.approx(1.0)


def test_training_rows_keep_infinity_and_drop_missing(spark):
    rows = [(1.0, 1.0), (float("inf"), 1.0), (float("nan"), 1.0), (None, 1.0), (1.0, None)]
    df = spark.createDataFrame(rows, "f double, ccmatrix_score double")
    assert filters.select_training(df, ["f"]).count() == 2
    with pytest.raises(ValueError, match="not found"):
        filters.select_training(df, ["f", "g"])


def test_top_k_breaks_ties_by_line(spark):
    df = spark.createDataFrame([(3, 1.0), (1, 1.0), (2, 5.0), (0, None)], "line_no long, s double")
    assert [r["line_no"] for r in filters.top_k(df, "s", 2).collect()] == [2, 1]
    assert [r["line_no"] for r in filters.bottom_k(df, "s", 2).collect()] == [1, 3]


def test_signal_defaults_are_flagged(spark):
    df = spark.createDataFrame([(None, 0.2), (float("nan"), None), (0.1, 0.2)], "a double, b double")
    got = [tuple(r) for r in filters.fill_signal_defaults(df, {"a": 0.5, "b": 30.0}).collect()]
    assert got == [(0.5, 0.2, 1), (0.5, 30.0, 2), (0.1, 0.2, 0)]


def test_bands(spark):
    df = spark.createDataFrame([(1.2,), (1.2001,), (1.15,), (1.16,), (1.1,), (1.11,)], "s double")
    got = [r[0] for r in df.select(derived.score_band(F.col("s"))).collect()]
    assert got == ["good", "strong", "moderate", "good", "lower", "moderate"]
    rho = spark.createDataFrame([(-0.8,), (0.7,), (0.5,)], "r double")
    assert [r[0] for r in rho.select(derived.corr_band(F.col("r"))).collect()] == ["strong", "moderate", "weak"]
    assert [r[0] for r in rho.select(derived.r2_verdict(F.col("r"))).collect()][0] == "worse than mean"


def test_minmax_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(2.0,)], "x double")
    x = F.col("x")
    assert df.select(derived.minmax(x, x, x)).first()[0] is None
    assert df.select(derived.guarded_minmax(x, x, x)).first()[0] == 0.0


def test_cosine(spark):
    rows = [([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0]), ([1.0, 2.0], [-1.0, -2.0])]
    df = spark.createDataFrame(rows, "a array<float>, b array<float>")
    got = [r[0] for r in df.select(vectors.cosine(F.col("a"), F.col("b"))).collect()]
    assert got == pytest.approx([math.sqrt(0.5), 0.0, -1.0])


def test_scaler_uses_population_deviation(numbers, spark):
    frame, df = numbers
    scaler = scaling.fit_scaler(df, ["x", "tied"])
    assert scaler.scale == pytest.approx([frame["x"].std(ddof=0), frame["tied"].std(ddof=0)])
    back = scaler.transform(df).select(scaler.inverse(F.col("x"), "x").alias("b"), "line_no")
    got = {r["line_no"]: r["b"] for r in back.collect()}
    assert [got[i] for i in range(5000)] == pytest.approx(list(frame["x"]), abs=1e-12)
    flat = spark.createDataFrame([(0.1,), (0.1,), (0.1,)], "c double")
    assert scaling.fit_scaler(flat, ["c"]).scale == [1.0]


def test_pruning_is_not_greedy():
    nan = float("nan")
    # a ~ b and b ~ c, but not a ~ c: b and c both go; d is undefined
    matrix = [
        [1.0, 0.99, 0.2, nan],
        [0.99, 1.0, -0.97, nan],
        [0.2, -0.97, 1.0, nan],
        [nan, nan, nan, nan],
    ]
    pruned = collinear.prune_from_matrix(["a", "b", "c", "d"], matrix)
    assert pruned.kept == ["a", "d"] and pruned.dropped == ["b", "c"]
    assert pruned.pairs == [("a", "b", 0.99), ("b", "c", 0.97)]
    assert collinear.prune_from_matrix(["a", "b"], [[1, 0.95], [0.95, 1]]).kept == ["a", "b"]


def test_regression_metrics_of_a_constant_target(spark):
    df = spark.createDataFrame([(1.0, 1.0, 2.0), (1.0, 1.0, 3.0)], "y double, p double, q double")
    assert metrics.regression_metrics(df, "y", "p").first()["r2"] == 1.0
    assert metrics.regression_metrics(df, "y", "q").first()["r2"] == 0.0


def test_best_model_takes_the_first_of_a_tie(spark):
    rows = [("b", "test", "mae", 0.1), ("a", "test", "mae", 0.1), ("c", "test", "mae", 0.2)]
    df = spark.createDataFrame(rows, "model string, split string, metric string, value double")
    assert metrics.best_model(df, ["c", "b", "a"]).first()["model"] == "b"


def test_selection_finds_the_place_among_many_keys_and_a_hot_one(spark):
    """A key with a third of the rows beside many others; every place is found without a window."""
    hot = spark.range(30_000).select(F.lit(7).cast("long").alias("k"))
    df = hot.unionByName(spark.range(60_000).select((F.col("id") + 100).alias("k"))).cache()
    h = sampling.key_hash(F.col("k"), 3)
    counts = sorted((r["h"], r["count"]) for r in df.groupBy(h.alias("h")).count().collect())
    edges, total = [], 0
    for value, rows in counts:
        edges.append((total, value, rows))
        total += rows
    at = next(i for i, e in enumerate(edges) if e[2] == 30_000)
    for n in (1, 45_000, 90_000, edges[at][0], edges[at][0] + 1, edges[at][0] + 30_000, edges[at][0] + 30_001):
        want = next((v, n - below, rows) for below, v, rows in edges if below < n <= below + rows)
        assert sampling.boundary(df, h, n, 90_000) == want
    df.unpersist()
