"""Scoring as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from pairscore.operators import signals
from pairscore.plans.scoring import score_pairs
from pairscore.schema import PAIR_SCHEMA, PAIRS, PairColumns


def read_pair_stream(
    spark: SparkSession,
    path: str,
    schema: StructType = PAIR_SCHEMA,
    fmt: str = "parquet",
    **options,
) -> DataFrame:
    """Pairs from files as they arrive in a folder."""
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def score_stream(
    pairs: DataFrame,
    pipeline,
    output: str,
    checkpoint: str,
    cols: PairColumns = PAIRS,
    fmt: str = "parquet",
    once: bool = False,
    interval: str = "30 seconds",
) -> StreamingQuery:
    """Append scored pairs to ``output``.

    The plan is the batch plan: with fitted ranges every feature depends on its
    own row, so there is no state, no shuffle and no late data to wait for.
    ``once`` handles what is there and stops.

    A language model beyond the workers' bound is joined, which takes more than one pass:
    then each micro-batch is scored as a batch and replaces ``output/batch=<id>``, so a
    repeated one leaves no second copy.
    """
    trigger = {"availableNow": True} if once else {"processingTime": interval}
    if not signals.fits_workers(pipeline.lm):

        def score_batch(batch: DataFrame, number: int) -> None:
            done = score_pairs(batch, pipeline, cols).write.format(fmt).mode("overwrite")
            done.save(f"{output}/batch={number}")

        writer = pairs.writeStream.foreachBatch(score_batch).trigger(**trigger)
        return writer.option("checkpointLocation", checkpoint).start()
    scored = score_pairs(pairs, pipeline, cols)
    return (
        scored.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start(output)
    )
