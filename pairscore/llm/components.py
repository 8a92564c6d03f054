"""Connected components of a graph that is a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def oriented(links: DataFrame) -> DataFrame:
    """Distinct links from the larger to the smaller node, without loops."""
    return links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()


def large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node around it."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    met = links.join(least, "u")
    return met.select(F.explode(F.array(F.struct(F.col("v").alias("a"), F.col("m").alias("b")), F.struct(F.col("u").alias("a"), F.col("m").alias("b")))).alias("l")).select("l.*")


def connected(links: DataFrame, label: str) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b): the component is its smallest node.

    Stars are merged until nothing changes; each round is stored. A hub is reduced to its smallest
    neighbour before the join, and the join's large side may be split.
    """
    now, mark = materialize(oriented(links), label), None
    while True:
        size = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if size["n"] == 0 or size == mark:
            break
        mark = size
        now = materialize(oriented(small_star(oriented(large_star(now)))), label)
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
