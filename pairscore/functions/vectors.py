"""Expressions over dense vectors kept as ``ARRAY<FLOAT>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0),
        lambda total, x: total + x,
    )


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine in double precision, 0.0 when either vector is all zeros."""
    length = norm(a) * norm(b)
    return F.when(length == 0, F.lit(0.0)).otherwise(dot(a, b) / F.nullif(length, F.lit(0.0)))
