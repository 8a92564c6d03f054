"""From raw documents to token digests, in five stages over everything the stage before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; the next one reads it back from
Parquet. All but the last return the columns of ``documents``. Expected: doc_id, text, and
optionally others, which pass through. Null texts count as empty; empty tables stay empty.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairscore.llm import decontaminate, near_duplicates, pii, queries, rule_ensemble
from pairscore.llm.columns import free_name
from pairscore.session import materialize, ship_package

HERE = os.path.dirname(os.path.abspath(__file__))
#: Documents below this probability of being good are rejected.
MIN_QUALITY = 0.7
#: Ids that are sent to all executors to filter texts where they lie; beyond it a shuffle does.
BROADCAST_IDS = 500_000


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the rule ensemble, fitted on the labelled ones among them, rejects."""
    model = rule_ensemble.fit(docs, queries.train_labels(spark, sf_dir, "quality", 4, 2))
    # stored before the filter, which would else be pushed below the score and compute every statistic twice
    quality = free_name(docs, "_quality")
    judged = materialize(rule_ensemble.score(docs, model, into=quality), "pipeline-quality")
    return judged.where(F.col(quality) >= MIN_QUALITY).select(*docs.columns)


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id.

    Of rows with equal id and text one stays. Ids are expected to be unique otherwise: an id goes with any of its rows.
    """
    found = materialize(near_duplicates.find_near_duplicates(docs), "pipeline-groups")
    gone = found.where(~F.col("kept")).select("doc_id").distinct()
    few = gone.count() <= BROADCAST_IDS
    left = docs.join(F.broadcast(gone) if few else gone, "doc_id", "left_anti").select(*docs.columns)
    again = found.where("kept AND doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if not again.limit(1).count():
        return left
    repeated = left.join(again, "doc_id", "left_semi").select(*docs.columns)
    once = repeated.dropDuplicates(["doc_id", "text"])
    return left.join(again, "doc_id", "left_anti").select(*docs.columns).unionByName(once)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with a benchmark window."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    found = decontaminate.find_contamination(docs.select(F.struct(*docs.columns).alias("_doc"), "text"), items)
    return found.where(F.size("hits") == 0).select("_doc.*")


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; n_chars follows the text."""
    clean = pii.redact(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of every text's tokens and of what they decode to."""
    return queries.token_digests(docs)


def shipped(stage):
    """The stage, with this code sent to the executors first."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark, HERE, "pairscore")
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("quality", shipped(good)),
    ("near_duplicates", shipped(distinct_texts)),
    ("decontamination", shipped(uncontaminated)),
    ("personal_data", shipped(redacted)),
    ("tokens", shipped(tokenized)),
]

#: Neither the fitted classifier nor the tokens can be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
