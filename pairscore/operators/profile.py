"""Profiling of a pair table: counts, ranges, distributions, correlations."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairscore.operators.joins import scalar
from pairscore.operators.quantiles import quantiles_and_more

QUARTILES = [0.25, 0.5, 0.75]


def number(c: str) -> Column:
    """A column as DOUBLE with NaN turned into NULL, so that aggregates skip it."""
    return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, sample std, min, quartiles, max: one row per column."""
    aggs = {}
    for c in columns:
        x = number(c)
        aggs |= {
            f"count_{c}": F.count(x),
            f"mean_{c}": F.avg(x),
            f"std_{c}": F.stddev_samp(x),
            f"min_{c}": F.min(x),
            f"max_{c}": F.max(x),
        }
    quartiles, row = quantiles_and_more(df, {c: QUARTILES for c in columns}, aggs)
    rows = [
        (
            c,
            row[f"count_{c}"],
            row[f"mean_{c}"],
            row[f"std_{c}"],
            row[f"min_{c}"],
            *[quartiles[c, q] for q in QUARTILES],
            row[f"max_{c}"],
        )
        for c in columns
    ]
    return df.sparkSession.createDataFrame(
        rows,
        "column string, count long, mean double, std double, min double, "
        "p25 double, p50 double, p75 double, max double",
    )


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Missing values per column, one row per column."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return wide.unpivot([], columns, "column", "missing")


def empty_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Empty texts per column, one row per column."""
    wide = df.agg(*[F.count_if(F.col(c) == "").alias(c) for c in columns])
    return wide.unpivot([], columns, "column", "empty")


def duplicate_counts(df: DataFrame, source: str = "source", target: str = "target") -> DataFrame:
    """Rows beyond the first with the same source, target, or pair; NULL equals NULL.

    Texts are compared by their SHA-256, so the shuffle carries 32 bytes per
    text however long it is, and repeats are dropped before it.
    """

    def digest(c: str) -> Column:
        return F.coalesce(F.unhex(F.sha2(F.col(c), 256)), F.unhex(F.lit("00")))

    marked = df.select(digest(source).alias("s"), digest(target).alias("t"))
    n = F.count(F.lit(1))
    return marked.agg(
        (n - F.count_distinct("s")).alias("duplicate_source"),
        (n - F.count_distinct("t")).alias("duplicate_target"),
        (n - F.count_distinct("s", "t")).alias("duplicate_pairs"),
    )


def value_range(df: DataFrame, column: str) -> DataFrame:
    low, high = F.min(column), F.max(column)
    return df.agg(low.alias("min"), high.alias("max"), (high - low).alias("range"))


def issue_counts(df: DataFrame, source: str = "source", target: str = "target") -> DataFrame:
    """Pairs with suspicious lengths.  A row short (or long) on both sides counts twice."""
    sl, tl = F.length(source), F.length(target)
    ratio = sl / (tl + F.lit(1))
    return df.agg(
        (F.count_if(ratio > 3) + F.count_if(ratio < 0.33)).alias("very_different_lengths"),
        (F.count_if(sl < 10) + F.count_if(tl < 10)).alias("very_short"),
        (F.count_if(sl > 500) + F.count_if(tl > 500)).alias("very_long"),
    )


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width bins over [min, max], the last one closed on the right.

    Bins without rows are listed too.  ``density`` is count / (rows * width).
    """
    x = F.col("x")
    values = df.select(number(column).alias("x")).filter(x.isNotNull())
    stats = values.agg(F.min(x).alias("low"), F.max(x).alias("high"), F.count(x).alias("n"))
    flat = F.col("low") == F.col("high")
    stats = stats.select(
        F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
        F.when(flat, F.col("high") + 0.5).otherwise(F.col("high")).alias("high"),
        "n",
    )
    low, high = scalar(stats, "low"), scalar(stats, "high")
    step = (high - low) / F.lit(bins)
    guess = F.least(
        F.floor((x - low) / (high - low) * F.lit(bins)), F.lit(bins - 1)
    )
    placed = values.select(x, guess.alias("g"))
    # the division may land one bin off next to an edge: the edges decide
    g = F.col("g")
    bin_no = (
        F.when(x < low + g * step, g - 1)
        .when((g < bins - 1) & (x >= low + (g + 1) * step), g + 1)
        .otherwise(g)
    )
    counted = placed.groupBy(bin_no.alias("bin")).agg(F.count(F.lit(1)).alias("found"))
    every = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    count = F.coalesce(F.col("found"), F.lit(0)).cast("long")
    return every.join(counted, "bin", "left").select(
        "bin",
        (low + F.col("bin") * step).alias("bin_start"),
        count.alias("count"),
        (count / (scalar(stats, "n") * step)).alias("density"),
    )


def pearson(a: Column, b: Column) -> Column:
    """Pearson correlation as an aggregate expression; NULL for a constant column."""
    varies = (F.min(a) < F.max(a)) & (F.min(b) < F.max(b))
    scale = F.nullif(F.stddev_pop(a) * F.stddev_pop(b), F.lit(0.0))
    return F.when(varies, F.covar_pop(a, b) / scale)


def corr(df: DataFrame, a: str, b: str, label: str = "corr") -> DataFrame:
    both = df.select(number(a).alias("a"), number(b).alias("b")).na.drop()
    return both.agg(pearson(F.col("a"), F.col("b")).alias(label))


def corr_values(df: DataFrame, columns: list[str]):
    """k x k Pearson matrix (numpy); NaN in the rows and columns of a constant."""
    assembled = VectorAssembler(inputCols=columns, outputCol="v", handleInvalid="skip").transform(
        df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    )
    return Correlation.corr(assembled, "v").first()[0].toArray()


def corr_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """The correlation matrix in long form: one row ``(a, b, r)`` per pair of columns."""
    matrix = corr_values(df, columns)
    rows = [
        (a, b, None if matrix[i, j] != matrix[i, j] else float(matrix[i, j]))
        for i, a in enumerate(columns)
        for j, b in enumerate(columns)
    ]
    return df.sparkSession.createDataFrame(rows, "a string, b string, r double")


def share(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition holds, and their percentage."""
    passed = F.count_if(condition)
    total = F.nullif(F.count(F.lit(1)), F.lit(0))
    return df.agg(passed.alias("rows"), (passed * F.lit(100.0) / total).alias("percent"))


def embedding_shape(df: DataFrame, column: str) -> DataFrame:
    size = F.size(column)
    return df.agg(
        F.min(size).alias("min_dim"), F.max(size).alias("max_dim"), F.count(column).alias("rows")
    )
