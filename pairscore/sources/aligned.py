"""Line-aligned text files: line i of each side belongs together."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pairscore.functions.text import strip
from pairscore.operators.joins import BROADCAST_ROWS, zip_by_line
from pairscore.session import materialize
from pairscore.sources.line_index import can_index, list_files, zip_files


class AlignmentError(ValueError):
    """The sides do not have the same number of lines."""


def read_lines(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """``(line_no, value)`` of a text file, and the number of lines.

    A folder counts as one long file, its parts in name order.  The file splits
    are read in parallel and stored with their places, in one scan; a line's
    number is its place in the split plus the stored lines of the splits before.
    Nothing depends on how a second scan would split the files.  A line without a
    start, or a total that differs, is an error.
    """
    raw = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row_id"),
    )
    stored = materialize(raw, "lines")
    splits = stored.groupBy("file", "block").agg(
        F.min("row_id").alias("first_id"), F.count(F.lit(1)).alias("lines")
    )
    splits = materialize(splits, "line-splits")
    # running totals: over the files (one row each), then over the splits of a file
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = splits.groupBy("file").agg(F.sum("lines").alias("in_file"))
    files = files.select("file", F.coalesce(F.sum("in_file").over(earlier), F.lit(0)).alias("files_before"))
    within = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("lines").over(within), F.lit(0))
    shifts = splits.withColumn("before", before).join(files, "file").select(
        "file", "block", (F.col("files_before") + F.col("before") - F.col("first_id")).alias("shift")
    )
    count, total = splits.agg(F.count(F.lit(1)), F.coalesce(F.sum("lines"), F.lit(0))).first()
    shifts = F.broadcast(shifts) if count <= BROADCAST_ROWS else shifts
    line_no = F.col("row_id") + F.coalesce(
        "shift", F.raise_error(F.concat(F.lit("a split without start: "), F.col("file"))).cast("long")
    )
    return stored.join(shifts, ["file", "block"], "left").select(line_no.alias("line_no"), "value"), total


def read_aligned(
    spark: SparkSession, source_path: str, target_path: str, score_path: str | None = None
) -> DataFrame:
    """``(line_no, source, target, score)`` from two or three aligned text files.

    Lines are stripped of Unicode white space.  Unequal lengths and a score that
    is not a number are errors.  Each task reads its lines from all files by an index of
    offsets; only if a file is compressed are the sides numbered and joined.
    """
    paths = {"source": source_path, "target": target_path}
    if score_path is not None:
        paths["score"] = score_path
    files = {name: list_files(spark, path) for name, path in paths.items()}
    if can_index(list(files.values())):
        pairs, lengths = zip_files(spark, files)
    else:
        sides, lengths = [], {}
        for name, path in paths.items():
            lines, lengths[name] = read_lines(spark, path)
            sides.append(lines.withColumnRenamed("value", name))
        pairs = zip_by_line(sides)
    if len(set(lengths.values())) > 1:
        raise AlignmentError(f"line counts differ: {lengths}")
    texts = {name: strip(F.col(name)) for name in paths}
    if "score" in texts:
        texts["score"] = _strict_double(texts["score"])
    return pairs.select("line_no", *[text.alias(name) for name, text in texts.items()])


def _strict_double(value):
    """Cast that fails on text which is no number, whatever the session's ANSI setting."""
    number = value.try_cast("double")
    return F.when(number.isNotNull(), number).otherwise(
        F.raise_error(F.concat(F.lit("not a score: "), value)).cast("double")
    )


def write_aligned(
    df: DataFrame,
    source_path: str,
    target_path: str,
    score_path: str | None = None,
    key: str = "line_no",
) -> None:
    """Write the sides as aligned text folders, sorted by line over many parts.

    A line break inside a text would shift all lines after it, so it becomes a
    space.
    """
    texts = {"source": source_path, "target": target_path}
    if score_path is not None:
        texts["score"] = score_path
    for name, path in texts.items():
        line = F.regexp_replace(F.col(name).cast("string"), r"[\r\n]+", " ").alias("value")
        ordered = df.select(key, line).repartitionByRange(key).sortWithinPartitions(key)
        ordered.select("value").write.text(path)
