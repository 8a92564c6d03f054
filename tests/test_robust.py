"""Results that must not depend on split layout, repeated keys or the size of a model."""

import pytest
from pyspark.sql import functions as F

from catalog.models import line_pipeline
from catalog.views import doc_pairs
from pairscore.operators import sampling, signals
from pairscore.operators.joins import lookup
from pairscore.session import materialize, work_folder
from pairscore.sources.aligned import read_lines
from pairscore.streaming.scoring import read_pair_stream, score_stream

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("before, after", [(("4", "128m"), ("9", "128m")), (("1", "64k"), ("1", "300k"))])
def test_lines_keep_their_numbers_when_the_splits_move(spark, before, after):
    path, names = work_folder(spark, "moving"), ("spark.sql.files.minPartitionNum", "spark.sql.files.maxPartitionBytes")
    old = {n: spark.conf.get(n, None) for n in names}
    spark.range(0, 60_000, 1, 3).select(F.concat(F.lit("line "), F.col("id").cast("string")).alias("value")).write.text(path)
    try:
        for n, v in zip(names, before):
            spark.conf.set(n, v)
        lines, total = read_lines(spark, path)
        for n, v in zip(names, after):
            spark.conf.set(n, v)
        wrong = lines.where(F.col("value") != F.concat(F.lit("line "), F.col("line_no").cast("string")))
        assert (total, lines.count(), wrong.count()) == (60_000, 60_000, 0)
    finally:
        for n, v in old.items():
            spark.conf.set(n, v) if v else spark.conf.unset(n)


def test_empty_file_has_no_lines(spark):
    path = work_folder(spark, "no-lines")
    spark.createDataFrame([], "value string").write.text(path)
    lines, total = read_lines(spark, path)
    assert (lines.count(), total) == (0, 0)


@pytest.mark.parametrize("n", [1, 60, 110, 199])
def test_samples_have_their_size_on_any_keys(spark, n):
    rows = spark.range(200).selectExpr("CASE WHEN id % 2 = 0 THEN id % 5 END AS k", "id % 40 AS v")
    for df in (rows, rows.select("k"), rows.selectExpr("1 AS k"), rows.selectExpr("CAST(NULL AS INT) AS k", "v")):
        taken = sampling.sample_n(df, n, 7, "k")
        assert taken.count() == n
        held = sampling.holdout(df, n / 200, 7, "k")
        assert held.count() == 200 and held.where("split = 'test'").count() == int(200 * (n / 200))
    again = sampling.sample_n(rows.repartition(7), n, 7, "k")
    assert sorted(map(str, again.collect())) == sorted(map(str, sampling.sample_n(rows, n, 7, "k").collect()))


def test_long_values_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr("pairscore.operators.joins.BROADCAST_BYTES", 1000)
    table = spark.createDataFrame([("a", "x" * 2000), ("b", "y")], "k string, v string")
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string").withColumn("n", F.lit(1))
    joined = lookup(df, table, "k")
    assert "BroadcastExchange" not in joined._jdf.queryExecution().sparkPlan().toString()
    assert sorted(len(r["v"] or "") for r in joined.collect()) == [0, 1, 2000]


def test_a_stream_takes_a_large_language_model(spark, monkeypatch):
    pipeline = line_pipeline(spark, SMALL)
    pairs = materialize(doc_pairs(spark, SMALL), "stream-input")
    found = []
    for rows in (2_000_000, 0):
        monkeypatch.setattr(signals, "LM_BROADCAST_ROWS", rows)
        folder = work_folder(spark, "stream")
        stream = read_pair_stream(spark, pairs.inputFiles()[0].rsplit("/", 1)[0], pairs.schema)
        score_stream(stream, pipeline, f"{folder}/scored", f"{folder}/checkpoint", once=True).awaitTermination()
        scored = spark.read.parquet(f"{folder}/scored").select("line_no", "predicted_score")
        found.append(sorted((r[0], round(r[1], 9)) for r in scored.collect()))
    assert found[0] == found[1] and len(found[0]) == pairs.count()
