"""Cross-validation from sufficient statistics.

One scan gathers for every fold the number of rows, the means and the centred Gram matrix of the
features and the target.  They merge exactly, so the training part of a fold is the merge of
all other folds: scalers and a whole grid of linear models for every fold need no further scan.
Only one matrix per fold reaches the driver.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairscore.operators.sampling import kfold
from pairscore.operators.scaling import Scaler
from pairscore.schema import TARGET

PARTS = "fold int, part long, n long, mean binary, gram binary"
PARTS_ARROW = pa.schema(
    [("fold", pa.int32()), ("part", pa.int64()), ("n", pa.int64()), ("mean", pa.binary()), ("gram", pa.binary())]
)
#: Partial statistics of a fold that are merged in one task.
FAN_IN = 64
#: Coordinate descent ends when no coefficient moves by more than this.
TOLERANCE = 1e-12
MOST_ROUNDS = 10_000


@dataclass(frozen=True)
class Moments:
    """Rows, means, and sums of products around the means."""

    n: int
    mean: np.ndarray
    gram: np.ndarray

    @classmethod
    def of(cls, rows: np.ndarray) -> Moments:
        mean = rows.mean(axis=0)
        return cls(len(rows), mean, (rows - mean).T @ (rows - mean))

    def merge(self, other: Moments) -> Moments:
        n = self.n + other.n
        if not n:
            return self
        gap = other.mean - self.mean
        gram = self.gram + other.gram + np.outer(gap, gap) * (self.n * other.n / n)
        return Moments(n, self.mean + gap * (other.n / n), gram)

    def scaler(self, columns: list[str]) -> Scaler:
        """Means and population deviations; a column that does not vary has divisor 1."""
        deviation = np.sqrt(np.maximum(np.diag(self.gram), 0) / max(self.n, 1))
        still = deviation <= 1e-12 * np.maximum(np.abs(self.mean), 1e-300)
        return Scaler(list(columns), self.mean.tolist(), np.where(still, 1.0, deviation).tolist())


def packed(fold: int, part: int, moments: Moments) -> dict:
    return {"fold": fold, "part": part, "n": moments.n, "mean": moments.mean.tobytes(), "gram": moments.gram.tobytes()}


def _moments(row: dict) -> Moments:
    mean = np.frombuffer(row["mean"])
    return Moments(row["n"], mean, np.frombuffer(row["gram"]).reshape(len(mean), len(mean)))


def fold_moments(folded: DataFrame, columns: list[str]) -> dict[int, Moments]:
    """Moments of the columns for every fold of a table with the column ``fold``; rows with a missing value don't count."""
    width = len(columns)
    numbers = F.array(*[F.col(c).cast("double") for c in columns])
    whole = folded.select(F.col("fold").cast("int").alias("fold"), numbers.alias("x")).where(
        F.col("fold").isNotNull() & ~F.exists("x", lambda v: v.isNull() | F.isnan(v))
    )

    def gather(batches):
        found: dict[int, Moments] = {}
        for b in batches:
            folds = b.column("fold").to_numpy()
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            for fold in np.unique(folds).tolist():
                made = Moments.of(x[folds == fold])
                found[fold] = found[fold].merge(made) if fold in found else made
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_pylist([packed(fold, part, m) for fold, m in found.items()], PARTS_ARROW)

    return merged_parts(whole.mapInArrow(gather, PARTS))


def merged_parts(parts: DataFrame) -> dict[int, Moments]:
    """The moments of each fold from those of its parts, merged in a tree."""

    def merge(table: pa.Table) -> pa.Table:
        rows = table.sort_by("part").to_pylist()
        total = reduce(Moments.merge, map(_moments, rows))
        return pa.Table.from_pylist([packed(rows[0]["fold"], rows[0]["part"] // FAN_IN, total)], PARTS_ARROW)

    parts = parts.groupBy("fold", F.floor(F.col("part") / FAN_IN).alias("group")).applyInArrow(merge, PARTS)
    parts = parts.groupBy("fold").applyInArrow(merge, PARTS)
    return {r["fold"]: _moments(r.asDict()) for r in parts.collect()}


def training_moments(by_fold: dict[int, Moments]) -> dict[int, Moments]:
    """For every fold the moments of all other folds."""
    return {
        fold: reduce(Moments.merge, [m for other, m in sorted(by_fold.items()) if other != fold])
        for fold in by_fold
        if len(by_fold) > 1
    }


def fold_scalers(folded: DataFrame, columns: list[str]) -> dict[int, Scaler]:
    """The scaler of every fold's training rows, from one scan."""
    made = training_moments(fold_moments(folded, columns))
    return {fold: m.scaler(columns) for fold, m in made.items()}


def scale_folds(folded: DataFrame, columns: list[str]) -> DataFrame:
    """Every row's columns scaled with the numbers of the other folds, from one scan before."""
    scalers = fold_scalers(folded, columns)

    def scaled(column: str):
        out = F.lit(None).cast("double")
        for fold, scaler in scalers.items():
            out = F.when(F.col("fold") == fold, scaler.scaled(column)).otherwise(out)
        return out

    return folded.withColumns({c: scaled(c) for c in columns})


def elastic_net(gram: np.ndarray, cross: np.ndarray, l1: float, l2: float, start: np.ndarray | None = None) -> np.ndarray:
    """Coefficients that minimise b'Gb/2 - c'b + l1 |b| + l2 b'b/2, by coordinate descent."""
    m = len(cross)
    if l1 == 0:
        return np.linalg.lstsq(gram + l2 * np.eye(m), cross, rcond=1e-12)[0]
    b = np.zeros(m) if start is None else start.copy()
    moved = gram @ b
    for _ in range(MOST_ROUNDS):
        largest = 0.0
        for j in range(m):
            if gram[j, j] + l2 <= 0:
                continue
            left = cross[j] - moved[j] + gram[j, j] * b[j]
            new = np.sign(left) * max(abs(left) - l1, 0.0) / (gram[j, j] + l2)
            if new != b[j]:
                moved += gram[:, j] * (new - b[j])
                largest, b[j] = max(largest, abs(new - b[j])), new
        if largest < TOLERANCE:
            break
    return b


@dataclass(frozen=True)
class Line:
    """A linear model of a scaled target over scaled features."""

    scaler: Scaler
    coefficients: np.ndarray

    def weights(self) -> tuple[np.ndarray, float]:
        """Weights and intercept in the original units."""
        scale, mean = np.array(self.scaler.scale), np.array(self.scaler.mean)
        weights = self.coefficients * scale[-1] / scale[:-1]
        return weights, float(mean[-1] - weights @ mean[:-1])

    def squared_error(self, held: Moments) -> float:
        """Summed squared error over rows with these moments."""
        weights, intercept = self.weights()
        full = np.append(-weights, 1.0)
        bias = float(held.mean @ full) - intercept
        return float(full @ held.gram @ full) + held.n * bias * bias


def linear_path(train: Moments, columns: list[str], penalties: list[tuple[float, float]]) -> list[Line]:
    """One line for each (regParam, elasticNetParam), target last in ``columns``; strong penalties first warm the next."""
    scaler = train.scaler(columns)
    scale = np.array(scaler.scale)
    gram = train.gram / np.outer(scale, scale) / train.n
    lines: dict[int, Line] = {}
    warm: dict[float, np.ndarray] = {}
    for i in sorted(range(len(penalties)), key=lambda i: -penalties[i][0]):
        strength, mix = penalties[i]
        found = elastic_net(gram[:-1, :-1], gram[:-1, -1], strength * mix, strength * (1 - mix), warm.get(mix))
        warm[mix] = found
        lines[i] = Line(scaler, found)
    return [lines[i] for i in range(len(penalties))]


@dataclass(frozen=True)
class PathSearch:
    """RMSE of every combination and fold, the averages, and the winner refitted on all rows."""

    folds: DataFrame
    averages: DataFrame
    best_params: dict
    best_cv_rmse: float
    best: Line


def search_linear_path(
    df: DataFrame,
    features: list[str],
    reg_params: list[float],
    elastic_net_params: list[float],
    k: int = 5,
    target: str = TARGET,
    key: str = "line_no",
    seed: int = 42,
) -> PathSearch:
    """The full grid of penalties over ``k`` folds from one scan of ``df``; the first of equal means wins."""
    columns = [*features, target]
    by_fold = fold_moments(kfold(df, k, seed, key), columns)
    if len(by_fold) < 2:
        raise ValueError("cross-validation needs rows in two folds or more")
    penalties = [(r, e) for r in reg_params for e in elastic_net_params]
    names = [json.dumps({"regParam": r, "elasticNetParam": e}) for r, e in penalties]
    rows, sums = [], np.zeros(len(penalties))
    for fold, train in sorted(training_moments(by_fold).items()):
        held = by_fold[fold]
        for i, line in enumerate(linear_path(train, columns, penalties)):
            rmse = (max(line.squared_error(held), 0.0) / held.n) ** 0.5
            rows.append((i, names[i], fold, rmse))
            sums[i] += rmse
    folds = df.sparkSession.createDataFrame(rows, "ordinal int, params string, fold int, rmse double")
    averages = folds.groupBy("ordinal", "params").agg(F.avg("rmse").alias("mean_rmse"), F.count("*").alias("folds"))
    best = int(np.flatnonzero(sums <= sums.min() * (1 + 1e-12))[0])
    everything = reduce(Moments.merge, [m for _, m in sorted(by_fold.items())])
    strength, mix = penalties[best]
    line = linear_path(everything, columns, [penalties[best]])[0]
    return PathSearch(
        folds, averages.drop("ordinal"), {"regParam": strength, "elasticNetParam": mix}, float(sums[best] / len(by_fold)), line
    )
