"""Average ranks and rank correlation without a window over all rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairscore.operators.joins import hot_keys, lookup
from pairscore.session import materialize

VALUES_PER_BUCKET = 500_000
RUNNING = (Window.unboundedPreceding, Window.currentRow)


def value_ranks(
    counts: DataFrame,
    value: str,
    weight: str,
    values: int,
    per_bucket: int = VALUES_PER_BUCKET,
    series: Sequence[str] = (),
    keep: Sequence[str] = (),
) -> DataFrame:
    """Average rank of every value of a ``(*series, value, weight)`` table, within its series, one row per value, beside columns to ``keep``.

    The distinct ``values`` are sorted into ranges of about ``per_bucket``, however many that takes.  The running count is
    taken inside a range; ranges start where the ranges before them in the series end.  Those starts are
    running counts too, within blocks of ranges and over the blocks, so no task sees all ranges.
    """
    series, kept = list(series), list(keep)
    upto, own = F.col("upto"), F.col(weight)
    rank = (upto - (own - F.lit(1)) / F.lit(2.0)).alias("rank")
    n_ranges = max(1, math.ceil(values / per_bucket))
    if n_ranges == 1:
        # all values together are within the bound of one range
        placed = counts.withColumn("range_no", F.lit(0))
        running = Window.partitionBy(*series, "range_no").orderBy(value).rowsBetween(*RUNNING)
        return placed.withColumn("upto", F.sum(weight).over(running)).select(*series, value, *kept, rank)
    placed = materialize(
        counts.repartitionByRange(n_ranges, *series, value).withColumn("range_no", F.spark_partition_id()),
        "rank-ranges",
    )
    starts = range_starts(placed.groupBy(*series, "range_no").agg(F.sum(weight).alias("held")), n_ranges, series)
    # the window leaves its rows where the join wants them, so only the starts move again
    running = Window.partitionBy(*series, "range_no").orderBy(value).rowsBetween(*RUNNING)
    return (
        placed.withColumn("upto", F.sum(weight).over(running))
        .join(starts, [*series, "range_no"])
        .withColumn("upto", F.col("start") + upto)
        .select(*series, value, *kept, rank)
    )


def range_starts(held: DataFrame, n_ranges: int, series: Sequence[str] = ()) -> DataFrame:
    """``(*series, range_no, start)`` of a ``(*series, range_no, held)`` table: what the ranges before hold."""
    a_block = math.isqrt(n_ranges) + 1
    blocked = held.withColumn("block", F.floor(F.col("range_no") / F.lit(a_block)))
    blocks = blocked.groupBy(*series, "block").agg(F.sum("held").alias("block_held"))
    keys = series or [F.lit(0)]
    over_blocks = Window.partitionBy(*keys).orderBy("block").rowsBetween(*RUNNING)
    blocks = blocks.withColumn("block_start", F.sum("block_held").over(over_blocks) - F.col("block_held"))
    inside = Window.partitionBy(*series, "block").orderBy("range_no").rowsBetween(*RUNNING)
    joined = blocked.withColumn("inside", F.sum("held").over(inside) - F.col("held")).join(blocks, [*series, "block"])
    return joined.select(*series, "range_no", (F.col("block_start") + F.col("inside")).alias("start"))


def spearman_by(
    df: DataFrame, group: str, a: str, b: str, label: str = "spearman", per_bucket: int = VALUES_PER_BUCKET
) -> DataFrame:
    """Spearman correlation of each group, ``(group, label)``, with average ranks for ties.

    All groups and both sides are ranked in one long table.  Equal (a, b) pairs are counted before anything is
    shuffled by value, and the correlation is then taken over the weighted distinct pairs.  A pair with a NULL or
    NaN counts nowhere; a group without pairs has no row, one with a constant side has NULL.
    """
    pairs = materialize(
        df.select(F.col(group).alias("g"), F.col(a).cast("double").alias("a"), F.col(b).cast("double").alias("b"))
        .na.drop(subset=["a", "b"])
        .groupBy("g", "a", "b")
        .agg(F.count(F.lit(1)).alias("w")),
        "rank-pairs",
    )
    long = pairs.unpivot(["g", "w"], ["a", "b"], "side", "value")
    counts = materialize(long.groupBy("g", "side", "value").agg(F.sum("w").alias("n")), "rank-values")
    ranks = value_ranks(counts, "value", "n", counts.count(), per_bucket, ["g", "side"])
    ranks = materialize(ranks, "rank-found")

    def key(*values: str):
        # the printed form of a double is its own; NULL groups are a group as well
        own = F.when(F.col("g").isNull(), "-").otherwise(F.concat(F.lit("+"), F.col("g").cast("string")))
        return F.concat_ws("\x1f", own, *[F.col(v).cast("string") for v in values])

    ranked = pairs
    for side in ("a", "b"):
        mine = ranks.filter(F.col("side") == side).select(key("value").alias("key"), F.col("rank").alias(f"rank_{side}"))
        ranked = lookup(ranked.withColumn("key", key(side)), mine, "key", "inner").drop("key")
    # ranks are about half the size of their group: centred there, the sums lose nothing
    total = pairs.groupBy("g").agg(((F.sum("w") + F.lit(1)) / F.lit(2.0)).alias("middle"))
    total = total.select(key().alias("key"), "middle")
    ranked = lookup(ranked.withColumn("key", key()), total, "key", "inner")
    x, y, w = F.col("rank_a") - F.col("middle"), F.col("rank_b") - F.col("middle"), F.col("w")
    sums = ranked.groupBy("g").agg(F.sum(w * x * y).alias("xy"), F.sum(w * x * x).alias("xx"), F.sum(w * y * y).alias("yy"))
    scale = F.sqrt(F.col("xx")) * F.sqrt(F.col("yy"))
    return sums.select(F.col("g").alias(group), (F.col("xy") / F.nullif(scale, F.lit(0.0))).alias(label))


def spearman(df: DataFrame, a: str, b: str, label: str = "spearman", **options) -> DataFrame:
    """Spearman correlation with average ranks for ties, as a one-row table; NULL without pairs."""
    one = df.select(F.lit(0).alias("g"), F.col(a).alias("a"), F.col(b).alias("b"))
    return spearman_by(one, "g", "a", "b", label, **options).agg(F.max(label).alias(label))


def rank_within(
    df: DataFrame,
    group: str,
    score: str,
    tie: str,
    label: str = "rank",
    hot_groups: list | None = None,
) -> DataFrame:
    """Place of each row among the rows of its group, best score first.

    Most groups fit a window.  A group with more than a 1/1000 share of all rows
    is sorted by range over many tasks instead, even if its scores are all alike:
    rows are numbered inside each range and shifted by the size of the ranges
    before.
    """
    order = [F.col(score).desc(), F.col(tie).asc()]
    hot = hot_keys(df, group) if hot_groups is None else hot_groups
    within = Window.partitionBy(group).orderBy(*order)
    if not hot:
        return df.withColumn(label, F.row_number().over(within).cast("long"))
    # read three times from here on, by the range sort and by both branches
    df = materialize(df, "rank-input")
    is_hot = F.col(group).isin(hot)
    cold = df.filter(~is_hot | F.col(group).isNull()).withColumn(
        label, F.row_number().over(within).cast("long")
    )
    ranged = materialize(
        df.filter(is_hot)
        .repartitionByRange(F.col(group), *order)
        .withColumn("range_no", F.spark_partition_id()),
        "rank-ranges",
    )
    held = ranged.groupBy(group, "range_no").agg(F.count(F.lit(1)).alias("held"))
    before = Window.partitionBy(group).orderBy("range_no").rowsBetween(*RUNNING)
    # a row per range and one more per hot group, of which there are fewer than 1000: small enough to broadcast
    starts = held.select(
        group, "range_no", (F.sum("held").over(before) - F.col("held")).alias("start")
    )
    in_range = Window.partitionBy(group, "range_no").orderBy(*order)
    numbered = (
        ranged.withColumn("place", F.row_number().over(in_range))
        .join(F.broadcast(starts), [group, "range_no"])
        .withColumn(label, (F.col("start") + F.col("place")).cast("long"))
        .drop("start", "place", "range_no")
    )
    return cold.unionByName(numbered)
