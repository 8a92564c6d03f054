"""Per-row feature attributions against a small background sample."""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairscore.operators.regress import Fitted, Trees, export_trees
from pairscore.operators.sampling import sample_n
from pairscore.operators.scaling import Scaler

# Background rows, explained rows, seed.
BACKGROUND_ROWS = 50
EXPLAINED_ROWS = 200
SEED = 42


def coalitions(m: int, budget: int | None = None, seed: int = SEED):
    """Feature subsets (rows of 0/1) and their Shapley kernel weights.

    Subset sizes are listed in full from the outside in, together with their
    complements, while the budget lasts; what is left of it is drawn at random.
    """
    budget = budget or 2 * m + 2048
    kernel = {
        s: (m - 1) / (s * (m - s)) for s in range(1, m)
    }  # total weight of all subsets of size s
    rows, weights = [], []
    left = dict(kernel)
    for s in range(1, m // 2 + 1):
        sizes = {s, m - s}
        count = sum(math.comb(m, z) for z in sizes)
        if len(rows) + count > budget:
            break
        for z in sorted(sizes):
            for chosen in combinations(range(m), z):
                row = np.zeros(m)
                row[list(chosen)] = 1.0
                rows.append(row)
                weights.append(kernel[z] / math.comb(m, z))
            left.pop(z)
    if left:
        rng = np.random.default_rng(seed)
        sizes = np.array(sorted(left))
        chance = np.array([left[z] for z in sizes])
        draws = max((budget - len(rows)) // 2, m)
        drawn = rng.choice(sizes, size=draws, p=chance / chance.sum())
        for z in drawn:
            row = np.zeros(m)
            row[rng.choice(m, size=z, replace=False)] = 1.0
            rows += [row, 1.0 - row]
            weights += [chance.sum() / (2 * draws)] * 2
    return np.array(rows), np.array(weights)


def solver(z: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Matrix that turns subset values into all attributions but the last."""
    free = z[:, :-1] - z[:, -1:]
    weighted = free * w[:, None]
    return np.linalg.pinv(free.T @ weighted) @ weighted.T


def background_rows(
    df: DataFrame, features: list[str], scaler: Scaler, key: str = "line_no",
    n: int = BACKGROUND_ROWS, seed: int = SEED,
) -> np.ndarray:
    """``n`` scaled rows as a matrix; small by definition."""
    rows = sample_n(df, n, f"background{seed}", key).orderBy(key)
    scaled = rows.select(*[scaler.scaled(c).alias(c) for c in features]).limit(n).toArrow()
    return np.column_stack([scaled[c].to_numpy() for c in features])


def shapley(
    df: DataFrame,
    function,
    features: list[str],
    scaler: Scaler,
    background: np.ndarray,
    key: str = "line_no",
    budget: int | None = None,
    seed: int = SEED,
) -> DataFrame:
    """Attributions of ``function`` (scaled matrix -> predictions) for every row of ``df``.

    Returns the key, one column per feature, ``base_value`` (the mean prediction
    of the background) and ``prediction``; the attributions of a row add up to
    prediction - base_value.  Rows are explained in the tasks that hold them.
    """
    m = len(features)
    z, w = coalitions(m, budget, seed)
    context = df.sparkSession.sparkContext
    sent = context.broadcast((z, solver(z, w), background))

    def explain(batches):
        z, solve, background = sent.value
        base = float(np.mean(function(background)))
        for b in batches:
            x = np.column_stack([b.column(i + 1).to_numpy(zero_copy_only=False) for i in range(m)])
            out = np.zeros((len(x), m))
            predicted = function(x) if len(x) else np.zeros(0)
            for i, row in enumerate(x):
                mixed = z[:, None, :] * row + (1.0 - z[:, None, :]) * background[None, :, :]
                values = function(mixed.reshape(-1, m)).reshape(len(z), -1).mean(axis=1)
                gap = predicted[i] - base
                first = solve @ (values - base - z[:, -1] * gap)
                out[i, :-1] = first
                out[i, -1] = gap - first.sum()
            columns = [b.column(0), *[pa.array(out[:, i]) for i in range(m)]]
            columns += [pa.array(np.full(len(x), base)), pa.array(predicted)]
            yield pa.RecordBatch.from_arrays(columns, [key, *features, "base_value", "prediction"])

    scaled = df.select(key, *[scaler.scaled(c).alias(c) for c in features])
    key_type = df.schema[key].dataType.simpleString()
    numbers = ", ".join(f"{c} double" for c in [*features, "base_value", "prediction"])
    return scaled.mapInArrow(explain, f"{key} {key_type}, {numbers}")


def leaf_paths(trees: Trees) -> list[tuple[float, np.ndarray, np.ndarray, np.ndarray]]:
    """Every leaf as (weighted value, features on its path, lower bounds, upper bounds): low < x <= high."""
    out = []
    for t, weight in enumerate(trees.weights):
        waiting = [(0, {})]
        while waiting:
            at, bounds = waiting.pop()
            feature = int(trees.feature[t, at])
            if feature < 0:
                names = sorted(bounds)
                low, high = np.array([bounds[f] for f in names]).reshape(-1, 2).T
                out.append((weight * trees.value[t, at], np.array(names, int), low, high))
                continue
            low, high = bounds.get(feature, (-np.inf, np.inf))
            cut = trees.threshold[t, at]
            waiting.append((trees.left[t, at], {**bounds, feature: (low, min(high, cut))}))
            waiting.append((trees.right[t, at], {**bounds, feature: (max(low, cut), high)}))
    return out


def leaf_shares(depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Shapley values of a leaf that needs ``a`` features of the row and ``b`` of the background row, by (a, b):
    for each of the row's features, and for each of the background's."""
    row, other = np.zeros((depth + 1, depth + 1)), np.zeros((depth + 1, depth + 1))
    for a in range(depth + 1):
        for b in range(depth + 1 - a):
            if a:
                row[a, b] = math.factorial(a - 1) * math.factorial(b) / math.factorial(a + b)
            if b:
                other[a, b] = -math.factorial(a) * math.factorial(b - 1) / math.factorial(a + b)
    return row, other


def explain_trees(paths, shares, x: np.ndarray, background: np.ndarray) -> np.ndarray:
    """Exact attributions of the rows of ``x``, averaged over the background rows.

    A coalition takes its features from the row and the others from a background row. Walking the path of a
    leaf, a feature that only the row passes must be in the coalition and one that only the background row passes
    must not; a leaf with a feature that neither passes is never reached. What is left has a closed form.
    """
    out = np.zeros(x.shape)
    for value, names, low, high in paths:
        if not len(names):
            continue
        mine = ((x[:, names] > low) & (x[:, names] <= high))[:, None, :]
        theirs = ((background[:, names] > low) & (background[:, names] <= high))[None]
        only_mine, only_theirs = mine & ~theirs, theirs & ~mine
        reached = (mine | theirs).all(2)
        a, b = only_mine.sum(2), only_theirs.sum(2)
        gain, loss = (value * reached * s[a, b] for s in shares)
        each = only_mine * gain[:, :, None] + only_theirs * loss[:, :, None]
        out[:, names] += each.mean(1)
    return out


def tree_shapley(df: DataFrame, fitted: Fitted, background: np.ndarray, key: str = "line_no") -> DataFrame:
    """Exact attributions of a forest or boosted trees: the columns of ``shapley``, without drawn coalitions.

    The work per row is the number of leaves times the background rows; rows are explained in the tasks
    that hold them, a bounded number at a time.
    """
    trees, features = export_trees(fitted.model), fitted.features
    sent = df.sparkSession.sparkContext.broadcast((trees, background))

    def explain(batches):
        trees, background = sent.value
        paths, shares = leaf_paths(trees), leaf_shares(max(trees.depth, 1))
        base = float(np.mean(trees(background)))
        for whole in batches:
            for at in range(0, whole.num_rows, EXPLAINED_ROWS):
                b = whole.slice(at, EXPLAINED_ROWS)
                x = np.column_stack([b.column(i + 1).to_numpy(zero_copy_only=False) for i in range(len(features))])
                out = explain_trees(paths, shares, x, background)
                columns = [b.column(0), *[pa.array(c) for c in out.T]]
                columns += [pa.array(np.full(len(x), base)), pa.array(trees(x))]
                yield pa.RecordBatch.from_arrays(columns, [key, *features, "base_value", "prediction"])

    scaled = df.select(key, *[fitted.feature_scaler.scaled(c).alias(c) for c in features])
    key_type = df.schema[key].dataType.simpleString()
    numbers = ", ".join(f"`{c}` double" for c in [*features, "base_value", "prediction"])
    return scaled.mapInArrow(explain, f"`{key}` {key_type}, {numbers}")


def linear_shapley(
    df: DataFrame, fitted: Fitted, background: np.ndarray, key: str = "line_no"
) -> DataFrame:
    """Exact attributions of a linear model: weight * (x - background mean)."""
    weights = fitted.model.coefficients.toArray()
    means = background.mean(axis=0)
    parts = {
        c: F.lit(float(weights[i])) * (fitted.feature_scaler.scaled(c) - F.lit(float(means[i])))
        for i, c in enumerate(fitted.features)
    }
    base = float(weights @ means + fitted.model.intercept)
    explained = df.select(key, *[e.alias(c) for c, e in parts.items()])
    total = sum((F.col(c) for c in fitted.features), F.lit(base))
    return explained.withColumns({"base_value": F.lit(base), "prediction": total})


def importance(attributions: DataFrame, features: list[str]) -> DataFrame:
    """Mean absolute attribution per feature, largest first."""
    wide = attributions.agg(*[F.avg(F.abs(F.col(c))).alias(c) for c in features])
    return wide.unpivot([], features, "feature", "importance").orderBy(
        F.col("importance").desc(), "feature"
    )
