"""Small helpers shared by the operators: Arrow columns, word splitting, digests of spans."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def add_columns(
    df: DataFrame,
    schema: str,
    source: str,
    make: Callable[[], Callable[[list], dict[str, list]]],
) -> DataFrame:
    """``df`` plus the columns of ``schema``, computed from the column ``source`` batch by batch.

    ``make`` runs once per task and returns the function over one batch of values, so
    automata and tables are built once. A column of ``df`` that has the name of a new
    one is replaced. All other columns pass through untouched; rows keep their order.
    """
    added = T._parse_datatype_string(schema)
    kept = [c for c in df.schema.fields if c.name not in added.names]
    full = T.StructType(kept + added.fields)
    arrow = to_arrow_schema(full)
    passed = [c.name for c in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            for part in bounded(batch, source):
                new = compute(part.column(source).to_pylist())
                columns = [part.column(name).cast(arrow.field(name).type) for name in passed]
                columns += [pa.array(new[f.name], arrow.field(f.name).type) for f in added.fields]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    wanted = df if source in df.columns else df.withColumn(source, F.lit(None).cast("string"))
    return wanted.mapInArrow(run, full)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def bounded(batch: pa.RecordBatch, source: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices whose ``source`` column holds about ``limit`` bytes, at least one row each."""
    size = batch.column(source).nbytes
    step = max(1, batch.num_rows * limit // max(size, 1))
    for start in range(0, batch.num_rows, step):
        yield batch.slice(start, step)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, LOWER)


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of an array of spans, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def digest(text: Column) -> Column:
    """Lowercase hex SHA-256 of a string or binary column."""
    return F.sha2(text, 256)
