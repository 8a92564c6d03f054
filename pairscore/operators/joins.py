"""Joins that keep working when one key holds a large part of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 << 20
HOT_SHARE = 1_000


def scalar(stats: DataFrame, column: str) -> Column:
    """One value of a one-row table, attached to every row without a join."""
    return stats.select(column).scalar()


def lookup(
    df: DataFrame,
    table: DataFrame,
    key: str,
    how: str = "left",
    broadcast_rows: int = BROADCAST_ROWS,
    table_rows: int | None = None,
    hot: list | None = None,
    spread_by: list[str] | None = None,
) -> DataFrame:
    """Join ``df`` with ``table``, which has one row per ``key`` (``table_rows``, if known).

    A table of at most ``broadcast_rows`` rows and ``BROADCAST_BYTES`` of values is
    broadcast.  A larger one is shuffled.  Then the rows of a hot key, one with more than a 1/1000 share, are
    spread over all tasks by a hash of ``spread_by`` (every other column, if not
    given), and its one row of ``table`` is copied to each.  Fewer than 1000 keys
    can be hot, whatever the size of the data.
    """
    if table_rows is None and broadcast_rows:
        # at most one row more than fits is measured
        sizes = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in table.columns]
        measured = table.limit(broadcast_rows + 1).select(sum(sizes[1:], sizes[0]).cast("long").alias("b"))
        table_rows, size = measured.agg(F.count(F.lit(1)), F.coalesce(F.sum("b"), F.lit(0))).first()
        if size > BROADCAST_BYTES:
            table_rows = broadcast_rows + 1
    if broadcast_rows and table_rows <= broadcast_rows:
        return df.join(F.broadcast(table), key, how)
    hot = hot_keys(df, key) if hot is None else hot
    spread_by = spread_by or [c for c in df.columns if c != key]
    if not spread_by:
        return df.join(table, key, how)
    salts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    is_hot = F.col(key).isin(hot) if hot else F.lit(False)
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    # rows without a key match nothing; they are spread as well
    salted = df.withColumn(
        "_salt", F.when(is_hot | F.col(key).isNull(), salt).otherwise(F.lit(0))
    )
    every_salt = F.sequence(F.lit(0), F.lit(salts - 1))
    copied = table.withColumn(
        "_salt", F.explode(F.when(is_hot, every_salt).otherwise(F.array(F.lit(0))))
    )
    return salted.join(copied, [key, "_salt"], how).drop("_salt")


def hot_keys(df: DataFrame, key: str, share: int = HOT_SHARE) -> list:
    """Keys holding more than 1/share of the rows (so fewer than ``share`` of them)."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return [
        row[0] for row in counts.filter(F.col("n") * share > scalar(total, "total")).select(key).collect()
    ]


def translate(
    df: DataFrame,
    table: DataFrame,
    default: str,
    source: str = "source",
    translation: str = "translation",
    **options,
) -> DataFrame:
    """Look up the translation of each source text; ``default`` where there is none."""
    joined = lookup(df, table.select(source, translation), source, "left", **options)
    return joined.withColumn(translation, F.coalesce(F.col(translation), F.lit(default)))


def zip_by_line(sides: list[DataFrame], key: str = "line_no") -> DataFrame:
    """Row i of each side next to row i of the others.

    All sides grow with the corpus, so none is broadcast.  They are hashed on the
    same key, so each is shuffled once and the later joins reuse the partitioning.
    """
    result = sides[0]
    for side in sides[1:]:
        result = result.join(side.hint("merge"), key)
    return result
