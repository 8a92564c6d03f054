"""Aligned files put side by side through an index of line offsets, without moving their texts.

Each side is one long file, its parts in name order.  A first scan of byte ranges counts the lines that start in
each range and keeps the offset of every ``STRIDE``-th.  Running totals over the ranges number the lines; then every
block of ``BLOCK`` line numbers knows where its lines lie on each side, and one task reads them from all sides by
ranged reads.  Only the index is shuffled.

Lines end at ``\\n``, ``\\r`` or ``\\r\\n``; a last line needs no end; a byte order mark at the start of a file is no
text; bytes that are not UTF-8 become replacement characters.  Empty files and empty sides have no lines.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairscore.operators.ranks import range_starts
from pairscore.session import materialize

RANGE_BYTES = 32 << 20
STRIDE = 1_000
BLOCK = 16_384
READ_BYTES = 1 << 20
BATCH_LINES = 2_048
# Endings of files that Spark decompresses, whose bytes are no lines.
COMPRESSED = (".gz", ".bz2", ".lz4", ".zst", ".snappy", ".deflate", ".xz")
MARK = b"\xef\xbb\xbf"
LINE_END = re.compile(rb"\r\n|\n|\r")
INDEX = "side int, range_no long, file string, size long, lines long, offsets array<long>"


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a Hadoop path, and the path in it."""
    scheme, colon, rest = uri.partition(":")
    if not colon or "/" in scheme or scheme == "file":
        path = rest if colon and scheme == "file" else uri
        return fs.LocalFileSystem(), "/" + path.lstrip("/")
    return fs.FileSystem.from_uri(f"{scheme}:{quote(rest)}")


def list_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(path, bytes) of the file or of the folder's files, in name order; hidden files are left out."""
    found = spark.read.format("binaryFile").load(path).select("path", "length").collect()
    return sorted((r["path"], r["length"]) for r in found)


def can_index(files: list[list[tuple[str, int]]]) -> bool:
    """Whether bytes of the files are lines; compressed files have to be read from their start."""
    return not any(path.endswith(COMPRESSED) for side in files for path, _ in side)


def line_starts(data: np.ndarray, first: bool) -> np.ndarray:
    """Places in ``data`` after which a line starts, one byte ahead of it; ``first`` counts the start of the file.

    The last byte of ``data`` is only looked at to tell whether it goes with a carriage return before it.
    """
    ends = data[:-1] == 10
    ends |= (data[:-1] == 13) & (data[1:] != 10)
    places = np.flatnonzero(ends)
    return np.concatenate([[-1], places]) if first else places


def index_lines(
    spark: SparkSession, files: list[list[tuple[str, int]]], range_bytes: int = RANGE_BYTES, stride: int = STRIDE
) -> tuple[DataFrame, int]:
    """The stored index, one row per byte range, and the number of ranges."""
    rows, number = [], 0
    for side, of_side in enumerate(files):
        for path, size in of_side:
            rows.append((side, number, path, size))
            number += -(-size // range_bytes)
    if not number:
        return spark.createDataFrame([], INDEX + ", start long"), 0
    listed = spark.createDataFrame(rows, "side int, first long, file string, size long").filter("size > 0")
    pieces = F.sequence(F.lit(0), F.floor((F.col("size") - 1) / F.lit(range_bytes)))
    ranges = listed.select("side", "first", "file", "size", F.explode(pieces).alias("piece"))
    # an explicit number of partitions: the rows are few and small, the work behind each is not
    tasks = min(number, 100_000)
    ranges = ranges.repartition(tasks, "file", "piece")

    def scan(batches):
        for b in batches:
            for r in b.to_pylist():
                system, path = opened(r["file"])
                low = r["piece"] * range_bytes
                high = min(low + range_bytes, r["size"])
                with system.open_input_file(path) as source:
                    source.seek(max(low - 1, 0))
                    data = np.frombuffer(source.read(high - max(low - 1, 0)), dtype=np.uint8)
                if len(data) != high - max(low - 1, 0):
                    raise ValueError(f"{r['file']} is shorter than it was")
                starts = line_starts(data, low == 0) + 1 + max(low - 1, 0)
                yield pa.RecordBatch.from_pydict(
                    {
                        "side": pa.array([r["side"]], pa.int32()),
                        "range_no": pa.array([r["first"] + r["piece"]], pa.int64()),
                        "file": [r["file"]],
                        "size": pa.array([r["size"]], pa.int64()),
                        "lines": pa.array([len(starts)], pa.int64()),
                        "offsets": pa.array([starts[::stride].tolist()], pa.list_(pa.int64())),
                    }
                )

    index = materialize(ranges.mapInArrow(scan, INDEX), "line-index")
    held = index.select("side", "range_no", F.col("lines").alias("held"))
    starts = materialize(range_starts(held, number, ["side"]), "line-starts")
    return index.join(starts, ["side", "range_no"]), number


def lines_at(source, offset: int) -> Iterator[bytes]:
    """The lines of an open file from the start of one on."""
    source.seek(offset)
    held: list[bytes] = []
    first, back = True, b""
    while (read := source.read(READ_BYTES)) or back:
        data, back = back + read, b""
        if read and data.endswith(b"\r"):
            data, back = data[:-1], b"\r"  # a line feed may follow that belongs to it
        if first and offset == 0 and data.startswith(MARK):
            data = data[len(MARK) :]
        first = False
        *whole, rest = LINE_END.split(data)
        for part in whole:
            if held:
                part, held = b"".join([*held, part]), []
            yield part
        if rest:
            held.append(rest)
    if held:
        yield b"".join(held)


def zip_files(
    spark: SparkSession,
    files: dict[str, list[tuple[str, int]]],
    range_bytes: int = RANGE_BYTES,
    stride: int = STRIDE,
    block: int = BLOCK,
) -> tuple[DataFrame, dict[str, int]]:
    """``(line_no, *sides)`` of the sides' files, and the number of lines of each side.

    Where the numbers differ the shorter sides have NULL; the caller decides whether that is an error.
    """
    names = list(files)
    index, _ = index_lines(spark, list(files.values()), range_bytes, stride)
    index = index.filter("lines > 0")
    counted = {r["side"]: r["n"] for r in index.groupBy("side").agg(F.sum("lines").alias("n")).collect()}
    lengths = {name: counted.get(i, 0) for i, name in enumerate(names)}

    # the part of each block that lies in a range: where to start reading, lines to skip, lines to take
    last = F.col("start") + F.col("lines")
    pieces = index.withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((last - 1) / block))))
    low = F.greatest(F.col("block") * F.lit(block), F.col("start"))
    high = F.least((F.col("block") + F.lit(1)) * F.lit(block), last)
    inside = low - F.col("start")
    piece = F.struct(
        low.alias("low"),
        "file",
        F.get("offsets", F.floor(inside / stride).cast("int")).alias("offset"),
        (inside % stride).alias("skip"),
        (high - low).alias("take"),
    )
    sides = [F.array_sort(F.collect_list(F.when(F.col("side") == i, piece))).alias(f"s{i}") for i in range(len(names))]
    blocks = materialize(pieces.groupBy("block").agg(*sides), "line-blocks")
    total = sum(size for of_side in files.values() for _, size in of_side)
    tasks = max(1, min(-(-max(lengths.values(), default=0) // block), -(-total // range_bytes) * 2, 100_000))
    blocks = blocks.repartitionByRange(tasks, "block")

    def lines_of(pieces: list[dict]) -> Iterator[bytes]:
        for p in pieces:
            system, path = opened(p["file"])
            with system.open_input_file(path) as source:
                wanted = p["skip"] + p["take"]
                done = 0
                for line in lines_at(source, p["offset"]):
                    done += 1
                    if done > p["skip"]:
                        yield line
                    if done == wanted:
                        break
                if done != wanted:
                    raise ValueError(f"{p['file']} has fewer lines than it had")

    def read(batches):
        for b in batches:
            for r in b.to_pylist():
                sides = [lines_of(r[f"s{i}"]) for i in range(len(names))]
                have = [sum(p["take"] for p in r[f"s{i}"]) for i in range(len(names))]
                at, end = r["block"] * block, r["block"] * block + max(have)
                while at < end:
                    count = min(BATCH_LINES, end - at)
                    columns = [pa.array(range(at, at + count), pa.int64())]
                    for lines in sides:
                        texts = [line.decode("utf-8", "replace") for _, line in zip(range(count), lines)]
                        columns.append(pa.array(texts + [None] * (count - len(texts)), pa.string()))
                    yield pa.RecordBatch.from_arrays(columns, ["line_no", *names])
                    at += count

    schema = ", ".join(["line_no long", *[f"`{n}` string" for n in names]])
    return blocks.mapInArrow(read, schema), lengths
