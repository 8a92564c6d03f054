"""Row sampling and splits driven by a hash of the row key.

A row's place depends only on its key and the seed, so results are the same for
any partitioning, after a lost executor, and for any later run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASH_BITS = 60
#: Ranges of the hash that are counted at a time.
RANGES = 4_096
BUCKETS = 10_000


def key_hash(key: Column, seed: int | str) -> Column:
    """60-bit hash of ``key`` and ``seed``, evenly spread."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def bucket(key: Column, seed: int | str) -> Column:
    """Hash bucket 0 .. 9999 of a key."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % BUCKETS


def boundary(df: DataFrame, h: Column, n: int, total: int) -> tuple[int, int, int]:
    """``(value, need, tied)``: the first ``n`` of ``total`` rows by ``h`` are those below
    ``value`` and ``need`` of the ``tied`` rows at it.

    A radix selection: rows are counted in ``RANGES`` equal ranges of the hash, then again
    within the range that holds the n-th place, until that is a single value or holds few
    rows.  Only range counts reach the driver, whatever repeats; a few scans at most.
    """
    low, high, before = 0, 1 << HASH_BITS, 0
    hashed = df.select(h.alias("h"))
    while True:
        width = max((high - low) // RANGES, 1)
        inside = hashed.filter((F.col("h") >= low) & (F.col("h") < high))
        place = F.expr(f"(h - {low}L) DIV {width}L")
        ranges = inside.groupBy(place.alias("place")).agg(
            F.count(F.lit(1)).alias("rows"), F.min("h").alias("first"), F.max("h").alias("last")
        )
        for found in sorted(ranges.collect(), key=lambda r: r["place"]):
            if before + found["rows"] >= n:
                break
            before += found["rows"]
        if found["first"] == found["last"]:
            return found["first"], n - before, found["rows"]
        low, high = found["first"], found["last"] + 1
        if found["rows"] <= RANGES:
            values = hashed.filter((F.col("h") >= low) & (F.col("h") < high)).groupBy("h").count().collect()
            for value, rows in sorted(map(tuple, values)):
                if before + rows >= n:
                    return value, n - before, rows
                before += rows


def mark_first(df: DataFrame, key: str, n: int, total: int, seed: int | str, output: str) -> DataFrame:
    """Adds ``output``: true for exactly the ``n`` rows that come first in hash order.

    The order is by a hash of the key; rows with one key, and rows without a key, by a hash
    of the whole row.  Equal rows cannot be told apart, so of those at the boundary the
    wanted number of copies is marked.
    """
    if n >= total or n <= 0:
        return df.withColumn(output, F.lit(n > 0))
    row = F.xxhash64(*df.columns)
    named = F.coalesce(F.col(key).cast("string"), F.concat(F.lit("row:"), row.cast("string")))
    h, again = key_hash(named, seed), key_hash(row, f"{seed}:row")
    value, need, tied = boundary(df, h, n, total)
    if need == tied:
        return df.withColumn(output, h <= F.lit(value))
    ties = df.filter(h == F.lit(value))
    second, need, tied = boundary(ties, again, need, tied)
    below = (h < F.lit(value)) | ((h == F.lit(value)) & (again < F.lit(second)))
    at = (h == F.lit(value)) & (again == F.lit(second))
    if need == tied:
        return df.withColumn(output, below | at)
    copies = df.filter(at).limit(1).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(tied))))
    copies = copies.withColumn(output, F.col("_copy") <= need).drop("_copy")
    return df.filter(~at).withColumn(output, below).unionByName(copies)


def sample_n(df: DataFrame, n: int | None, seed: int, key: str = "line_no") -> DataFrame:
    """Exactly ``n`` rows without replacement; all rows if there are no more than that."""
    if not n:
        return df
    total = df.count()
    if n >= total:
        return df
    return mark_first(df, key, n, total, f"sample{seed}", "_first").filter("_first").drop("_first")


def split_train_val_test(
    df: DataFrame,
    fractions: tuple[float, float, float] = (0.7, 0.15, 0.15),
    seed: int = 42,
    key: str = "line_no",
) -> DataFrame:
    """Adds ``split`` = train / val / test; the texts, features and vectors of a row stay together."""
    train_end = round(fractions[0] * BUCKETS)
    val_end = round((fractions[0] + fractions[1]) * BUCKETS)
    b = bucket(F.col(key), f"split{seed}")
    return df.withColumn(
        "split", F.when(b < train_end, "train").when(b < val_end, "val").otherwise("test")
    )


def holdout(
    df: DataFrame, ratio: float = 0.1, seed: int = 42, key: str = "line_no"
) -> DataFrame:
    """Adds ``split`` = test for exactly int(rows * ratio) rows, trainval for the rest."""
    total = df.count()
    marked = mark_first(df, key, int(total * ratio), total, f"holdout{seed}", "_first")
    return marked.withColumn("split", F.when(F.col("_first"), "test").otherwise("trainval")).drop("_first")


def kfold(df: DataFrame, k: int = 5, seed: int = 42, key: str = "line_no") -> DataFrame:
    """Adds ``fold`` = 0 .. k-1."""
    return df.withColumn("fold", (bucket(F.col(key), f"fold{seed}") % k).cast("int"))
