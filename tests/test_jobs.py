"""The jobs end to end, one after the other over files, and the exploration report."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairscore.__main__ import run
from pairscore.operators.signals import similarity
from pairscore.operators.sampling import holdout
from pairscore.plans.explore import composite_scores, corpus_report, disagreement_report
from pairscore.plans.features import build_features
from pairscore.session import job_folder, materialize, work_folder
from pairscore.sources.aligned import write_aligned
from pairscore.sources.tables import read_params, write_table


@pytest.fixture(scope="module")
def pairs(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(150):
        s = " ".join(rng.choice(["यह", "किताब", "one", "2", "है।"], size=rng.integers(1, 15)))
        t = "".join(rng.choice(list("雨停商店九点开门。,1a"), size=rng.integers(1, 40)))
        rows.append((i, s, t, 1.06 + 0.18 * min(len(s), len(t)) / max(len(s), len(t))))
    return spark.createDataFrame(rows, "line_no long, source string, target string, score double")


def test_jobs_one_after_the_other(spark, pairs):
    base = work_folder(spark, "jobs")
    sides = [f"{base}/{side}" for side in ("s", "t", "scores")]
    write_aligned(pairs, *sides)
    run(spark, ["features", "--source", sides[0], "--target", sides[1], "--scores", sides[2],
                "--out", f"{base}/prepared", "--sample-size", "120"])
    table = spark.read.parquet(f"{base}/prepared/features")
    assert table.count() == 120
    run(spark, ["search", "--features", f"{base}/prepared/features", "--out", f"{base}/cv",
                "--kind", "linear", "--kfolds", "2", "--space", '{"regParam": [0.0, 0.01]}'])
    assert spark.read.parquet(f"{base}/cv/test").count() == 12
    assert spark.read.parquet(f"{base}/cv/trainval").count() == 108
    best = read_params(spark, f"{base}/cv/best_params_linear")["best_params"]
    assert best["regParam"] in (0.0, 0.01)
    run(spark, ["fit", "--table", f"{base}/cv/trainval", "--prepared", f"{base}/prepared",
                "--kind", "linear", "--params", f"{base}/cv/best_params_linear", "--out", f"{base}/models"])
    run(spark, ["evaluate", "--table", f"{base}/cv/test", "--models", f"{base}/models",
                "--kinds", "linear", "--out", f"{base}/eval"])
    metrics = spark.read.json(f"{base}/eval/eval_metrics").first()
    assert metrics["model"] == "linear" and metrics["rmse"] > 0
    run(spark, ["explain", "--table", f"{base}/cv/trainval", "--models", f"{base}/models",
                "--kind", "linear", "--out", f"{base}/shap", "--sample-size", "60"])
    assert spark.read.parquet(f"{base}/shap/shap_values_linear").count() == 60
    scoring = pairs.selectExpr("source AS hindi", "target AS chinese", "'x' AS note")
    write_table(scoring, f"{base}/pairs", "csv")
    run(spark, ["score", "--pairs", f"{base}/pairs", "--model", f"{base}/models/linear", "--out", f"{base}/scored"])
    scored = spark.read.options(header=True, inferSchema=True).csv(f"{base}/scored")
    assert scored.columns == ["hindi", "chinese", "note", "predicted_score", "confidence_lower", "confidence_upper"]
    assert scored.count() == 150
    model = ["--model", f"{base}/models/linear"]
    outputs = pairs.selectExpr("source AS hindi", "target AS chinese", "line_no % 10 AS text", "line_no % 3 AS site")
    write_table(outputs, f"{base}/outputs.parquet")
    run(spark, ["compare", "--outputs", f"{base}/outputs.parquet", *model, "--out", f"{base}/compared",
                "--system", "site", "--group", "text"])
    means = spark.read.options(header=True, inferSchema=True).csv(f"{base}/compared/systems")
    assert {r["site"]: r["pairs"] for r in means.collect()} == {0: 50, 1: 50, 2: 50}
    ranked = spark.read.parquet(f"{base}/compared/ranked")
    assert sorted(r["rank"] for r in ranked.where("text = 3").collect()) == list(range(1, 16))
    with pytest.raises(ValueError, match="no column 'system'"):
        run(spark, ["compare", "--outputs", f"{base}/outputs.parquet", *model, "--out", f"{base}/none"])
    write_table(outputs.select("hindi", "text"), f"{base}/sources.parquet")
    run(spark, ["translate", "--sources", f"{base}/sources.parquet", "--translator", "catalog.text:lower_case_translator",
                *model, "--out", f"{base}/translated"])
    made = spark.read.parquet(f"{base}/translated")
    assert made.count() == made.where("chinese = concat('» ', lower(hindi)) AND predicted_score IS NOT NULL").count() == 150
    write_table(pairs, f"{base}/arriving")
    run(spark, ["stream", "--pairs", f"{base}/arriving", *model, "--out", f"{base}/streamed",
                "--checkpoint", f"{base}/places", "--once"])
    assert spark.read.parquet(f"{base}/streamed").where("predicted_score IS NOT NULL").count() == 150


def test_exploration_job_leaves_its_report_only(spark, pairs):
    base = work_folder(spark, "explore")
    sides = [f"{base}/{side}" for side in ("s", "t", "scores")]
    write_aligned(pairs, *sides)
    shared = os.path.dirname(base)
    before = set(os.listdir(shared))
    run(spark, ["explore", "--source", sides[0], "--target", sides[1], "--scores", sides[2], "--out", f"{base}/report",
                "--bins", "7"])
    assert set(os.listdir(shared)) == before
    assert spark.read.parquet(f"{base}/report/histogram").count() == 7
    assert spark.read.parquet(f"{base}/report/disagreement_cases").count() == 8
    assert spark.read.parquet(f"{base}/report/missing").count() == 3


def test_a_failed_job_leaves_nothing_stored(spark, pairs):
    with pytest.raises(RuntimeError):
        with job_folder(spark) as folder:
            kept = materialize(pairs, "inside")
            with job_folder(spark) as inner:
                assert inner == folder
            assert kept.count() == 150 and os.listdir(folder)
            raise RuntimeError
    assert not os.path.exists(folder)
    assert materialize(pairs, "outside").count() == 150


def test_reports(spark, pairs):
    report = corpus_report(pairs, bins=10)
    assert report["describe"].count() == 4 and report["histogram"].count() == 10
    assert report["issues"].first()["very_long"] == 0
    scored = composite_scores(similarity(pairs))
    found = disagreement_report(scored)
    assert found["share"].first()["rows"] == found["cases"].count() == 8
    assert [r["q"] for r in found["thresholds"].collect()] == [0.95, 0.99]


def test_nothing_is_fitted_on_test_rows(spark, pairs):
    split = holdout(pairs, 0.2, 42).withColumn("source", F.col("source"))
    changed = split.withColumn(
        "target", F.when(F.col("split") == "test", F.lit("完全不同的文字 999 !!!")).otherwise(F.col("target"))
    )
    made = [build_features(df, split="split") for df in (split, changed)]
    assert made[0].ratio_range == made[1].ratio_range
    assert made[0].features == made[1].features
    assert sorted(map(tuple, made[0].lm.collect())) == sorted(map(tuple, made[1].lm.collect()))
    assert made[0].table.where("split = 'test'").count() == int(pairs.count() * 0.2)
