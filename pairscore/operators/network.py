"""Small feed-forward networks fitted data-parallel.

With a batch size, rows are dealt once into shards of bounded size by a hash of their
key and stored packed.  An epoch is one job: every shard starts from the common
weights, takes its mini-batch steps by itself, and the shards' weights and moments are
averaged up a tree to a single row.  Shards, their order and the dropout depend on keys, epoch and step
only, so the fit is the same for any partitioning, with dropout too.

Without a batch size every step sends the weights to the tasks, adds up the gradients
of all rows and moves the weights once.  Rows never leave their tasks in either way;
the network has at most a few hundred thousand weights.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairscore.operators.sampling import bucket
from pairscore.operators.scaling import Scaler, fit_scaler
from pairscore.schema import TARGET
from pairscore.session import materialize, shuffles_removed, task_per_file

# Optimizer and stopping rule.
ADAM_BETA1 = 0.9
ADAM_BETA2 = 0.999
ADAM_EPSILON = 1e-7
MIN_DELTA = 1e-4

ROW_CHUNK = 4_096
#: Rows of a shard, about.
SHARD_ROWS = 2_048
#: Files of packed shards, at most, and states that are added in one task.
MOST_FILES = 4_096
FAN_IN = 8
#: States an epoch shuffles, about; beyond that a task first adds those of up to ``MOST_TOGETHER`` shards.
MOST_STATES = 64
MOST_TOGETHER = 32
TASKS_PER_CORE = 4
#: Weights that an optimizer step works on at a time.
STEP_BLOCK = 32_768


@dataclass(frozen=True)
class Shape:
    """Layer layout.  ``residual`` adds each hidden layer to its input and applies ReLU."""

    inputs: int
    hidden_dim: int = 128
    num_layers: int = 3
    residual: bool = False

    def layers(self) -> list[tuple[int, int]]:
        hidden = self.num_layers + (1 if self.residual else 0)
        widths = [self.inputs] + [self.hidden_dim] * hidden + [1]
        return list(zip(widths[:-1], widths[1:]))

    def size(self) -> int:
        return sum(i * o + o for i, o in self.layers())

    def unpack(self, flat: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        parts, at = [], 0
        for i, o in self.layers():
            parts.append((flat[at : at + i * o].reshape(i, o), flat[at + i * o : at + i * o + o]))
            at += i * o + o
        return parts

    def start(self, seed: int) -> np.ndarray:
        """Uniform weights in +-sqrt(6 / (in + out)), zero offsets."""
        rng = np.random.default_rng(seed)
        parts = []
        for i, o in self.layers():
            limit = math.sqrt(6.0 / (i + o))
            parts += [rng.uniform(-limit, limit, i * o), np.zeros(o)]
        return np.concatenate(parts)

    def forward(self, flat: np.ndarray, x: np.ndarray) -> np.ndarray:
        layers = self.unpack(flat)
        for n, (w, b) in enumerate(layers[:-1]):
            made = np.maximum(x @ w + b, 0.0)
            x = np.maximum(x + made, 0.0) if self.residual and n > 0 else made
        w, b = layers[-1]
        return (x @ w + b)[:, 0]

    def gradient(
        self, flat: np.ndarray, x: np.ndarray, y: np.ndarray, dropout: float, rng
    ) -> tuple[np.ndarray, float, float]:
        """Summed gradient of the squared error, and the summed squared and absolute error.

        What a layer lets through is kept as one array of factors, and each layer's part of the
        gradient is made where it belongs.  A residual sum needs no factors of its own: both
        summands are at least 0, so where it is 0 those of all layers below it are 0 too."""
        layers = self.unpack(flat)
        inputs, passed = [], []
        for n, (w, b) in enumerate(layers[:-1]):
            inputs.append(x)
            made = x @ w
            made += b
            np.maximum(made, 0.0, out=made)
            active = made > 0
            skips = self.residual and n > 0
            if dropout > 0 and (skips or not self.residual):
                factors = rng.random(made.shape)
                active &= factors >= dropout
                np.multiply(active, 1.0 / (1.0 - dropout), out=factors)
                made *= factors
            else:
                factors = active.astype(made.dtype)
            passed.append(factors)
            if skips:
                made += x
            x = made
        w, b = layers[-1]
        error = (x @ w + b)[:, 0] - y
        back = (2.0 * error)[:, None]
        summed = np.empty_like(flat)
        grads = self.unpack(summed)
        np.matmul(x.T, back, out=grads[-1][0])
        back.sum(axis=0, out=grads[-1][1])
        back = back @ w.T
        for n in range(len(layers) - 2, -1, -1):
            inner = np.multiply(back, passed[n], out=passed[n])
            np.matmul(inputs[n].T, inner, out=grads[n][0])
            inner.sum(axis=0, out=grads[n][1])
            if n and self.residual:
                back += inner @ layers[n][0].T
            elif n:
                back = inner @ layers[n][0].T
        return summed, float(error @ error), float(np.abs(error).sum())


@dataclass(frozen=True)
class FittedNetwork:
    shape: Shape
    features: list[str]
    feature_scaler: Scaler
    target_scaler: Scaler
    weights: np.ndarray = field(repr=False)
    history: list[dict] = field(repr=False)
    target: str = TARGET

    kind = "mlp"

    def scaled_function(self):
        """The network as a numpy function of scaled features, for use inside tasks."""
        shape, weights = self.shape, self.weights
        return lambda x: shape.forward(weights, x)

    def predict(self, df: DataFrame, output: str = "predicted_score") -> DataFrame:
        shape = self.shape
        weights = df.sparkSession.sparkContext.broadcast(self.weights)

        @F.arrow_udf("double")
        def apply(*columns: pa.Array) -> pa.Array:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in columns])
            return pa.array(shape.forward(weights.value, x))

        scaled = [self.feature_scaler.scaled(c) for c in self.features]
        return df.withColumn(output, self.target_scaler.inverse(apply(*scaled), self.target))

    def history_table(self, df: DataFrame) -> DataFrame:
        """Losses per epoch: ``(epoch, loss, mae, val_loss, val_mae)``."""
        rows = [(i + 1, *map(float, h.values())) for i, h in enumerate(self.history)]
        return df.sparkSession.createDataFrame(
            rows, "epoch int, loss double, mae double, val_loss double, val_mae double"
        )


def _sums(part: DataFrame, shape: Shape, weights: np.ndarray, dropout: float, seed: int, train: bool):
    """Gradient (when training), squared error, absolute error and rows, summed over ``part``.

    Slots 0 .. size-1 carry the gradient, the three after it the sums.  A task
    adds up its own rows first, and there are only a few tasks per core, so what
    is shuffled depends on the cluster and the weights and not on the rows.
    """
    size = shape.size()
    context = part.sparkSession.sparkContext
    part = part.coalesce(TASKS_PER_CORE * context.defaultParallelism)
    sent = context.broadcast(weights)

    def per_task(batches):
        total = np.zeros(size + 3)
        rng = np.random.default_rng(seed)
        for b in batches:
            if not b.num_rows:
                continue
            width = len(b.column(0)[0].as_py())
            x_all = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            y_all = b.column(1).to_numpy(zero_copy_only=False)
            for at in range(0, len(y_all), ROW_CHUNK):
                x, y = x_all[at : at + ROW_CHUNK], y_all[at : at + ROW_CHUNK]
                if train:
                    grad, squared, absolute = shape.gradient(sent.value, x, y, dropout, rng)
                    total[:size] += grad
                else:
                    error = shape.forward(sent.value, x) - y
                    squared, absolute = float(error @ error), float(np.abs(error).sum())
                total[size:] += (squared, absolute, len(y))
        slots = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(slots, pa.int64()), pa.array(total[slots])], ["slot", "value"]
        )

    summed = (
        part.mapInArrow(per_task, "slot long, value double")
        .groupBy("slot")
        .agg(F.sum("value").alias("value"))
        .toArrow()
    )
    sent.destroy()
    total = np.zeros(size + 3)
    total[summed["slot"].to_numpy()] = summed["value"].to_numpy()
    return total[:size], *map(float, total[size:])


class Optimizer:
    """Weights with their Adam moments and the number of steps taken; copies, which a step changes where they are."""

    def __init__(self, weights: np.ndarray, first: np.ndarray, second: np.ndarray, steps: int):
        self.weights, self.first, self.second, self.steps = weights.copy(), first.copy(), second.copy(), steps

    @classmethod
    def start(cls, weights: np.ndarray) -> Optimizer:
        return cls(weights, np.zeros_like(weights), np.zeros_like(weights), 0)

    def step(self, gradient: np.ndarray, learning_rate: float, rows: int = 1) -> None:
        """Moves the weights by a gradient summed over ``rows``, a block at a time that stays in the processor's cache."""
        self.steps += 1
        rate = learning_rate * math.sqrt(1 - ADAM_BETA2**self.steps) / (1 - ADAM_BETA1**self.steps)
        mean, moved, spread = np.empty((3, min(STEP_BLOCK, len(gradient))))
        for at in range(0, len(gradient), STEP_BLOCK):
            weights, first, second = (a[at : at + STEP_BLOCK] for a in (self.weights, self.first, self.second))
            g, m, s = (a[: len(weights)] for a in (mean, moved, spread))
            np.divide(gradient[at : at + STEP_BLOCK], rows, out=g)
            first *= ADAM_BETA1
            first += np.multiply(g, 1 - ADAM_BETA1, out=m)
            np.multiply(g, 1 - ADAM_BETA2, out=m)
            m *= g
            second *= ADAM_BETA2
            second += m
            np.multiply(first, rate, out=m)
            np.sqrt(second, out=s)
            s += ADAM_EPSILON
            m /= s
            weights -= m


def shards_together(count: int) -> int:
    """Shards whose states are added by the task that steps through them: a matter of the number of shards only."""
    return min(-(-count // MOST_STATES), MOST_TOGETHER) or 1


def pack_shards(rows: DataFrame, key: str, count: int, seed: int) -> DataFrame:
    """The ``count`` shards of (key, held, x, y), stored a few to a row: their numbers, rows, and values in order of the
    key's hash. Shards of rows that are held back for validation have numbers from ``count`` on, beside their likes.
    Every row gets a file of its own (of ``MOST_FILES`` at most), so that the files take about the same time."""
    dealt = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(f"shard{seed}")), F.lit(count))
    together = shards_together(count)
    keyed = rows.select(
        F.floor(dealt / together).cast("int").alias("part"),
        (dealt + F.col("held").cast("int") * count).alias("shard"),
        F.xxhash64(F.col(key).cast("string"), F.lit(f"order{seed}")).alias("place"), "x", "y",
    )

    def pack(table: pa.Table) -> pa.Table:
        y, shard = table["y"].to_numpy(), table["shard"].to_numpy()
        x = table["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1)
        order = np.lexsort((y, *x.T[::-1], table["place"].to_numpy(), shard))  # rows that share a key: by their values
        numbers, starts = np.unique(shard[order], return_index=True)
        parts = np.split(order, starts[1:])
        packed = {"shard": numbers.tolist(), "rows": [len(o) for o in parts], "x": [x[o].tobytes() for o in parts], "y": [y[o].tobytes() for o in parts]}
        kinds = {"shard": pa.int64(), "rows": pa.int64(), "x": pa.binary(), "y": pa.binary()}
        return pa.table([table["part"][:1].cast(pa.int64()), *(pa.array([packed[c]], pa.list_(k)) for c, k in kinds.items())], names=["part", *kinds])

    stored = "part long, shard array<long>, rows array<long>, x array<binary>, y array<binary>"
    files = min(-(-count // together), MOST_FILES)
    return materialize(keyed.repartitionById(files, "part").groupBy("part").applyInArrow(pack, stored), "mlp-shards")


def run_epoch(shards: DataFrame, count: int, shape: Shape, state: Optimizer, epoch: int | None, batch_size: int, dropout: float, learning_rate: float, seed: int):
    """The averaged state after every shard's steps, and the summed squared error, absolute error and rows: of the
    steps, and of the weights that came in on the rows held back. Without an ``epoch`` no steps are taken.

    A state is several MB: one row of added ones comes to the driver, and the files of the adding go at once. Every file
    of shards is a task."""
    sent = shards.sparkSession.sparkContext.broadcast(state)
    size = len(state.weights)
    sums = 3 * size if epoch is not None else 0  # where the errors start in a total, behind the state
    width = shape.inputs

    def of_shard(common: Optimizer, shard: int, rows: int, x: np.ndarray, y: np.ndarray, total: np.ndarray) -> None:
        if shard >= count:
            for at in range(0, rows, ROW_CHUNK):
                error = shape.forward(common.weights, x[at : at + ROW_CHUNK]) - y[at : at + ROW_CHUNK]
                total[-3:] += (error @ error, np.abs(error).sum(), len(error))
            return
        if epoch is None:
            return
        own = Optimizer(common.weights, common.first, common.second, common.steps)
        rng = np.random.default_rng([seed, epoch, shard])
        order, squared, absolute = rng.permutation(rows), 0.0, 0.0
        for at in range(0, rows, batch_size):
            mine = order[at : at + batch_size]
            gradient, sq, ab = shape.gradient(own.weights, x[mine], y[mine], dropout, rng)
            own.step(gradient, learning_rate, len(mine))
            squared, absolute = squared + sq, absolute + ab
        for n, moved in enumerate((own.weights, own.first, own.second)):
            total[n * size : (n + 1) * size] += moved * rows
        total[sums : sums + 4] += (squared, absolute, rows, own.steps * rows)

    def steps(batches):
        for b in batches:
            for i in range(b.num_rows):
                part, shards, counts = (b.column(c)[i].as_py() for c in ("part", "shard", "rows"))
                xs, ys = (([np.frombuffer(v.as_buffer()) for v in b.column(c)[i].values]) for c in ("x", "y"))
                total = np.zeros(sums + 7)
                for shard, rows, x, y in zip(shards, counts, xs, ys):
                    of_shard(sent.value, shard, rows, x.reshape(rows, width), y, total)
                yield pa.RecordBatch.from_pydict({"part": [part], "total": [total.tobytes()]})

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")  # a fixed order of adding
        total = np.zeros(sums + 7)
        for t in table["total"]:
            total += np.frombuffer(t.as_buffer())
        return pa.table({"part": [table["part"][0].as_py() // FAN_IN], "total": [total.tobytes()]})

    with shuffles_removed(shards.sparkSession), task_per_file(shards.sparkSession):
        made, left = shards.mapInArrow(steps, "part long, total binary"), -(-count // shards_together(count))
        while left > 1:
            made = made.groupBy(F.floor(F.col("part") / FAN_IN).alias("group")).applyInArrow(add, "part long, total binary")
            left = -(-left // FAN_IN)
        totals = [np.frombuffer(r["total"]) for r in made.collect()]
    sent.destroy()
    total = np.sum([np.zeros(sums + 7), *totals], axis=0)
    squared, absolute, rows, taken, *held = total[sums:].tolist()
    if rows:
        mean = total[:sums] / rows
        state = Optimizer(mean[:size], mean[size : 2 * size], mean[2 * size :], max(round(taken / rows), state.steps + 1))
    return state, (squared, absolute, rows), tuple(held)


def fit_mlp(
    df: DataFrame,
    features: list[str],
    target: str = TARGET,
    key: str = "line_no",
    hidden_dim: int = 128,
    num_layers: int = 3,
    dropout: float = 0.2,
    learning_rate: float = 1e-3,
    residual: bool = False,
    epochs: int = 60,
    batch_size: int | None = 128,
    patience: int = 6,
    validation: DataFrame | None = None,
    validation_share: float = 0.1,
    seed: int = 42,
    shard_rows: int = SHARD_ROWS,
) -> FittedNetwork:
    """Dense-ReLU-dropout layers, squared error, Adam, early stopping on the validation loss.

    Steps are taken over ``batch_size`` rows at a time within shards of about ``shard_rows``
    rows; None is one step an epoch over all rows.  Without a ``validation`` table a hash
    share of the rows is held back.  The best weights are the ones returned.
    """
    shape = Shape(len(features), hidden_dim, num_layers, residual)
    share = int(validation_share * 10_000)
    place = bucket(F.col(key), f"validation{seed}")
    train_rows = df if validation is not None else df.filter(place >= share)
    both = fit_scaler(train_rows, [*features, target])
    feature_scaler = Scaler(list(features), both.mean[:-1], both.scale[:-1])
    target_scaler = Scaler([target], both.mean[-1:], both.scale[-1:])

    def ready(rows: DataFrame, held) -> DataFrame:
        x = F.array(*[feature_scaler.scaled(c) for c in features]).alias("x")
        y = target_scaler.scaled(target).alias("y")
        return rows.select(key, held.alias("held"), x, y)

    held_back = validation if validation is not None else df.filter(place < share)
    both_parts = ready(train_rows, F.lit(False)).unionByName(ready(held_back, F.lit(True)))
    rows = materialize(both_parts, "mlp-rows")
    train, check = (rows.filter(part).select("x", "y") for part in (~F.col("held"), F.col("held")))
    if batch_size:
        shards = -(-train.count() // shard_rows) or 1
        packed = pack_shards(rows, key, shards, seed)

    def advance(state: Optimizer, epoch: int | None):
        """The state after an epoch, its training errors, and the validation errors of the state before it."""
        if batch_size:
            return run_epoch(packed, shards, shape, state, epoch, batch_size, dropout, learning_rate, seed)
        _, *held = _sums(check, shape, state.weights, 0.0, seed, False)
        if epoch is None:
            return state, None, held
        grad, *errors = _sums(train, shape, state.weights, dropout, seed + epoch, True)
        after = Optimizer(state.weights, state.first, state.second, state.steps)
        after.step(grad, learning_rate, max(errors[2], 1))
        return after, errors, held

    state = Optimizer.start(shape.start(seed))
    best, best_loss, waited = state.weights, math.inf, 0
    errors: tuple = ()
    history: list[dict] = []
    for epoch in [*range(epochs), None]:  # an epoch is judged by the next one's job
        after, new_errors, (v_sq, v_ab, v_n) = advance(state, epoch)
        if errors:
            val_loss = v_sq / max(v_n, 1)
            squared, absolute, seen = (errors[0], errors[1], max(errors[2], 1))
            history.append(
                {"loss": squared / seen, "mae": absolute / seen, "val_loss": val_loss, "val_mae": v_ab / max(v_n, 1)}
            )
            waited += 1
            if val_loss < best_loss - MIN_DELTA:
                best, best_loss, waited = state.weights, val_loss, 0
            if waited >= patience:
                break
        state, errors = after, new_errors
    return FittedNetwork(
        shape, list(features), feature_scaler, target_scaler, best, history, target
    )
