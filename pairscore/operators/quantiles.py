"""Exact quantiles that never gather a column, or a part of one, in one task.

The wanted columns are stored once, as numbers, and read three times, however many columns and quantiles
are asked for.  The first scan makes one mergeable sketch per column, merged in two steps; it gives each wanted place
a bracket of values.  The second counts the values below and inside the brackets.  The third counts the
distinct values inside, which are then ranked over as many tasks as they need.  The sketch decides how many values are ranked,
not the result: a bracket that misses its place, which is next to impossible, is widened to the whole column.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairscore.operators.ranks import VALUES_PER_BUCKET, value_ranks
from pairscore.session import materialize

SKETCH_SIZE = 1 << 15
# Sketches that meet in the last merge.
SKETCH_GROUPS = 64


def rank_error(size: int) -> float:
    """How far, as a share of the rows, a sketch of this size may misplace a value; exceeded once in 100 times."""
    return 2.296 / size**0.9021


def quantile_values(
    df: DataFrame,
    targets: dict[str, list[float]],
    sketch: int = SKETCH_SIZE,
    per_bucket: int = VALUES_PER_BUCKET,
) -> dict[tuple[str, float], float | None]:
    """Linear-interpolated quantiles as ``{(column, q): value}``; NULL and NaN are skipped, None without values."""
    return quantiles_and_more(df, targets, {}, sketch, per_bucket)[0]


def quantiles_and_more(
    df: DataFrame,
    targets: dict[str, list[float]],
    aggregates: dict[str, Column],
    sketch: int = SKETCH_SIZE,
    per_bucket: int = VALUES_PER_BUCKET,
) -> tuple[dict[tuple[str, float], float | None], dict]:
    """The same, and other named aggregates over the wanted columns from the second of the scans."""
    columns = list(targets)
    names = [f"_column_{i}" for i in range(len(columns))]
    clean = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(n) for n, c in zip(names, columns)]
    stored = materialize(df.select(*clean), "quantile-columns")
    wanted = [(n, c, q) for n, c in zip(names, columns) for q in targets[c]]
    sketched = _sketched(stored, {n: targets[c] for n, c in zip(names, columns)}, sketch)
    brackets = [sketched[n, q] for n, _, q in wanted]

    probes = [F.lit(0).alias("none")]
    for i, ((name, _, _), (low, high)) in enumerate(zip(wanted, brackets)):
        probes += [F.count_if(F.col(name) < low).alias(f"b{i}"), F.count_if(F.col(name).between(low, high)).alias(f"h{i}")]
    probes += [F.count(n).alias(f"n_{n}") for n in names]
    named = stored.select("*", *[F.col(n).alias(c) for n, c in zip(names, columns)]) if aggregates else stored
    seen = named.agg(*probes, *[a.alias(f"more_{k}") for k, a in aggregates.items()]).first()
    more = {k: seen[f"more_{k}"] for k in aggregates}

    result: dict[tuple[str, float], float | None] = {}
    places: list[tuple[int, str, float, float, float, int]] = []
    held = 0
    for i, ((name, column, q), (low, high)) in enumerate(zip(wanted, brackets)):
        n, below, inside = seen[f"n_{name}"], seen[f"b{i}"], seen[f"h{i}"]
        if not n:
            result[column, q] = None
            continue
        at = q * (n - 1)
        if not (below <= math.floor(at) and math.ceil(at) < below + inside):
            low, high, below, inside = -math.inf, math.inf, 0, n
        if low == high:
            result[column, q] = low
            continue
        places.append((i, name, low, high, at - below, inside))
        held += inside
    if places:
        found = _at_places(stored, places, held, per_bucket)
        for i, *_ in places:
            _, column, q = wanted[i]
            result[column, q] = found[i]
    return {(column, q): result[column, q] for _, column, q in wanted}, more


def _sketched(stored: DataFrame, probs: dict[str, list[float]], size: int) -> dict[tuple[str, float], tuple[float, float]]:
    """``{(column, q): (low, high)}``: values between which the quantile lies."""
    margin = 3 * rank_error(size)
    group = F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS))
    partial = stored.groupBy(group.alias("_group")).agg(
        *[F.kll_sketch_agg_double(n, F.lit(size)).alias(n) for n in probs], *[F.count(n).alias(f"n_{n}") for n in probs]
    )
    # a sketch of no value has no quantiles, and NULL is not merged
    some = partial.select(*[F.when(F.col(f"n_{n}") > 0, F.col(n)).alias(n) for n in probs], *[f"n_{n}" for n in probs])
    merged = some.agg(
        *[F.kll_merge_agg_double(n).alias(n) for n in probs], *[F.sum(f"n_{n}").alias(f"n_{n}") for n in probs]
    )
    ends = {n: [min(max(q + s * margin, 0.0), 1.0) for q in qs for s in (-1, 1)] for n, qs in probs.items()}
    asked = [n for n, qs in probs.items() if qs]
    row = merged.select(
        *[
            F.when(
                F.col(f"n_{n}") > 0, F.kll_sketch_get_quantile_double(n, F.array(*[F.lit(e) for e in ends[n]]))
            ).alias(n)
            for n in asked
        ]
    ).first()
    brackets = {}
    for n in asked:
        for i, q in enumerate(probs[n]):
            low, high = row[n][2 * i : 2 * i + 2] if row[n] is not None else (0.0, 0.0)
            # the ends of the column are not left to the sketch
            low = -math.inf if ends[n][2 * i] <= 0 else low
            high = math.inf if ends[n][2 * i + 1] >= 1 else high
            brackets[n, q] = low, high
    return brackets


def _at_places(stored: DataFrame, places: list[tuple], held: int, per_bucket: int) -> dict[int, float]:
    """The interpolated value at each place (counted from its bracket's start), for ``held`` values in all brackets."""
    inside = [
        F.when(F.col(name).between(low, high), F.struct(F.lit(i).alias("i"), F.col(name).alias("value")))
        for i, name, low, high, _, _ in places
    ]
    met = stored.select(F.explode(F.filter(F.array(*inside), lambda x: x.isNotNull())).alias("x")).select("x.*")
    counts = met.groupBy("i", "value").agg(F.count(F.lit(1)).alias("n"))
    if held > per_bucket:
        counts = materialize(counts, "quantile-values")
        held = counts.count()
    ranks = value_ranks(counts, "value", "n", held, per_bucket, ["i"], keep=["n"])
    # the first and the last of a value's places; a wanted place lies on a value or between two
    first = F.col("rank") - F.lit(1) - (F.col("n") - F.lit(1)) / F.lit(2.0)
    last = first + F.col("n") - F.lit(1)
    hit = F.lit(False)
    for i, _, _, _, at, inside_n in places:
        one = math.floor(at)
        two = min(one + 1, inside_n - 1)
        hit = hit | ((F.col("i") == i) & (first <= two) & (last >= one))
    rows = ranks.filter(hit).select("i", "value", first.alias("first"), last.alias("last")).collect()
    values = {}
    for i, _, _, _, at, inside_n in places:
        one = math.floor(at)
        two = min(one + 1, inside_n - 1)
        mine = [r for r in rows if r["i"] == i]
        low = next(r["value"] for r in mine if r["first"] <= one <= r["last"])
        high = next(r["value"] for r in mine if r["first"] <= two <= r["last"])
        values[i] = low if low == high or at == one else (one + 1 - at) * low + (at - one) * high
    return values


def quantiles(df: DataFrame, column: str, probs: list[float]) -> DataFrame:
    """One row ``(q, value)`` per wanted quantile."""
    values = quantile_values(df, {column: probs})
    rows = [(float(q), values[column, q]) for q in probs]
    return df.sparkSession.createDataFrame(rows, "q double, value double")
