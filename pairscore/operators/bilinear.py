"""Regression on two vectors with their interaction, fitted by alternating least squares.

score = bias + a.u + c.w + sum over r of (p_r.u)(q_r.w), over standardised vectors u and w and a standardised score.
With the q held the rest is linear, and with the p held it is too; each half-step solves ridge equations whose
means and Gram matrix come from one pass over the stored rows, merged in a tree.  The first q are the leading
directions of the moment of score, u and w.

A row that lacks a vector, a component (NULL, NaN or infinite) or the score teaches nothing; without its vectors it gets NULL.
Vectors of another length than the first are an error in fitting and get NULL in scoring.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairscore.operators.foldstats import PARTS, PARTS_ARROW, Moments, merged_parts, packed
from pairscore.schema import TARGET
from pairscore.session import materialize

RANK = 4
ROUNDS = 20
RIDGE = 1e-3
#: A round that lowers the error by less than this share of the first is the last.
ENOUGH = 1e-4


@dataclass(frozen=True)
class FittedBilinear:
    """The weights over standardised vectors, and the scalers of both sides and the target."""

    source_vector: str
    target_vector: str
    target: str
    bias: float
    linear: np.ndarray = field(repr=False)
    left: np.ndarray = field(repr=False)
    right: np.ndarray = field(repr=False)
    mean: np.ndarray = field(repr=False)
    scale: np.ndarray = field(repr=False)
    errors: tuple[float, ...] = ()

    kind = "bilinear"

    def values(self, u: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Predictions for rows of both vectors."""
        d = self.left.shape[1]
        u, w = (u - self.mean[:d]) / self.scale[:d], (w - self.mean[d:-1]) / self.scale[d:-1]
        made = self.bias + np.hstack([u, w]) @ self.linear + ((u @ self.left.T) * (w @ self.right.T)).sum(axis=1)
        return made * self.scale[-1] + self.mean[-1]

    def predict(self, df: DataFrame, output: str = "predicted_score") -> DataFrame:
        """``df`` with the predicted score."""
        fitted = df.sparkSession.sparkContext.broadcast(self)

        @F.arrow_udf("double")
        def predicted(us: pa.Array, ws: pa.Array) -> pa.Array:
            model = fitted.value
            sizes = model.left.shape[1], model.right.shape[1]
            rows = list(zip(us.to_pylist(), ws.to_pylist()))
            good = [i for i, pair in enumerate(rows) if all(v is not None and len(v) == n and None not in v for v, n in zip(pair, sizes))]
            out = np.full(len(rows), np.nan)
            if good:
                u, w = (np.array([rows[i][side] for i in good], dtype=float) for side in (0, 1))
                out[good] = model.values(u, w)
            return pa.array(out, type=pa.float64(), mask=~np.isfinite(out))

        vectors = [F.col(c).cast("array<double>") for c in (self.source_vector, self.target_vector)]
        return df.withColumn(output, predicted(*vectors))


def _moments_of(stored: DataFrame, sizes: tuple[int, int], design) -> Moments:
    """Moments of the columns that ``design(u, w, y)`` makes of the stored rows."""

    def gather(batches):
        total = None
        for b in batches:
            if b.num_rows:
                u, w = (b.column(i).flatten().to_numpy().reshape(-1, n) for i, n in enumerate(sizes))
                made = Moments.of(design(u, w, b.column(2).to_numpy()))
                total = made if total is None else total.merge(made)
        if total is not None:
            yield pa.RecordBatch.from_pylist([packed(0, TaskContext.get().partitionId(), total)], PARTS_ARROW)

    return merged_parts(stored.mapInArrow(gather, PARTS))[0]


def _solved(moments: Moments, ridge: float) -> tuple[np.ndarray, float, float]:
    """Ridge weights of all columns but the last on the last, the bias, and the mean squared error."""
    gram, cross = moments.gram[:-1, :-1], moments.gram[:-1, -1]
    weights = np.linalg.solve(gram + ridge * moments.n * np.eye(len(gram)), cross)
    error = moments.gram[-1, -1] - 2 * weights @ cross + weights @ gram @ weights
    return weights, float(moments.mean[-1] - weights @ moments.mean[:-1]), float(max(error, 0.0) / moments.n)


def fit_bilinear(
    df: DataFrame,
    source_vector: str,
    target_vector: str,
    target: str = TARGET,
    rank: int = RANK,
    ridge: float = RIDGE,
    rounds: int = ROUNDS,
) -> FittedBilinear:
    """Regress the score on both sentence vectors and ``rank`` products of directions in them."""
    u, w, y = (F.col(c).cast(t) for c, t in ((source_vector, "array<double>"), (target_vector, "array<double>"), (target, "double")))
    usable = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = df.select(u.alias("u"), w.alias("w"), y.alias("y"))
    rows = rows.where("u IS NOT NULL AND w IS NOT NULL").where(~usable(F.col("y")) & ~F.exists("u", usable) & ~F.exists("w", usable))
    stored = materialize(rows, "bilinear-rows")
    sizes = stored.agg(F.min(F.size("u")), F.max(F.size("u")), F.min(F.size("w")), F.max(F.size("w"))).first()
    if sizes[0] is None:
        raise ValueError("no row has both vectors and a score")
    if sizes[0] != sizes[1] or sizes[2] != sizes[3]:
        raise ValueError(f"vectors of several lengths: {sizes[0]} to {sizes[1]} and {sizes[2]} to {sizes[3]}")
    du, dw = sizes[0], sizes[2]
    rank = min(rank, du, dw)
    whole = _moments_of(stored, (du, dw), lambda u, w, y: np.column_stack([u, w, y]))
    scaler = whole.scaler([str(i) for i in range(du + dw + 1)])
    mean, scale = np.array(scaler.mean), np.array(scaler.scale)

    def scaled(u, w, y):
        return (u - mean[:du]) / scale[:du], (w - mean[du:-1]) / scale[du:-1], (y - mean[-1]) / scale[-1]

    def crossed(u, w, y):
        u, w, y = scaled(u, w, y)
        return np.column_stack([u, w * y[:, None]])

    # the leading directions of E[y u w'] are where a product explains most
    moment = _moments_of(stored, (du, dw), crossed).gram[:du, du:]
    right = np.linalg.svd(moment, full_matrices=False)[2][:rank]
    left, linear, bias, errors = np.zeros((rank, du)), np.zeros(du + dw), 0.0, []
    for _ in range(rounds):
        for side in ("left", "right"):

            def design(u, w, y, side=side, left=left, right=right):
                u, w, y = scaled(u, w, y)
                free, held = (u, w @ right.T) if side == "left" else (w, u @ left.T)
                products = (held[:, :, None] * free[:, None, :]).reshape(len(y), -1)
                return np.column_stack([u, w, products, y])

            weights, bias, error = _solved(_moments_of(stored, (du, dw), design), ridge)
            linear, moved = weights[: du + dw], weights[du + dw :].reshape(rank, -1)
            # both directions of a product share its size, so the penalty treats them alike
            other = right if side == "left" else left
            norms = np.linalg.norm(moved, axis=1), np.linalg.norm(other, axis=1)
            share = np.sqrt(np.divide(norms[1], norms[0], out=np.ones(rank), where=(norms[0] > 0) & (norms[1] > 0)))[:, None]
            moved, other = moved * share, other / share
            left, right = (moved, other) if side == "left" else (other, moved)
            errors.append(error)
        if len(errors) > 2 and errors[-3] - errors[-1] <= ENOUGH * errors[0]:
            break
    return FittedBilinear(source_vector, target_vector, target, bias, linear, left, right, mean, scale, tuple(errors))
