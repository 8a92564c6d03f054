"""Cross-validation and grid search."""

from __future__ import annotations

import json
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairscore.operators.foldstats import fold_scalers
from pairscore.operators.metrics import fold_average, regression_metrics
from pairscore.operators.network import fit_mlp
from pairscore.operators.regress import ESTIMATORS, fit_regressor
from pairscore.operators.sampling import kfold
from pairscore.schema import TARGET

# The grids of the two network kinds.
SEARCH_SPACES = {
    "mlp": {
        "hidden_dim": [64, 128, 256],
        "num_layers": [2, 3, 4],
        "dropout": [0.2, 0.3],
        "learning_rate": [1e-3, 5e-4],
    },
    "residual_mlp": {
        "hidden_dim": [64, 128, 256],
        "num_layers": [2, 3],
        "dropout": [0.2, 0.3],
        "learning_rate": [1e-3, 5e-4],
    },
}
CV_EPOCHS = 100
CV_PATIENCE = 5


@dataclass(frozen=True)
class Search:
    """All fold results, their averages, and the winner."""

    kind: str
    folds: DataFrame
    averages: DataFrame
    best_params: dict
    best_cv_rmse: float


def grid(space: dict[str, Iterable]) -> list[dict]:
    """Every combination of the listed values, last name varying fastest."""
    return [dict(zip(space, values)) for values in product(*space.values())]


def first_least(values: list[float]) -> int:
    """Place of the smallest value; values that differ by rounding only are equal, and the first of those counts."""
    least = min(values)
    return next(i for i, v in enumerate(values) if v <= least + 1e-12 * abs(least))


def fit_kind(df, kind, features, target, params, scaler=None, validation=None, key="line_no"):
    """Fit any known kind of model with one parameter set."""
    if kind in ESTIMATORS:
        return fit_regressor(df, kind, features, target, params, scaler)
    if kind not in SEARCH_SPACES:
        raise ValueError(f"unknown model {kind!r}")
    return fit_mlp(
        df, features, target, key, residual=kind == "residual_mlp", validation=validation, **params
    )


def grid_search(
    df: DataFrame,
    kind: str,
    features: list[str],
    space: dict[str, Iterable] | None = None,
    k: int = 5,
    target: str = TARGET,
    key: str = "line_no",
    seed: int = 42,
    parallelism: int = 4,
) -> Search:
    """Mean fold RMSE of every combination; the smallest wins, the first on a tie.

    ``df`` should be a stored table: every fit reads it again.  Scalers see the
    training folds only and are fitted once per fold.  Fits run as concurrent
    Spark jobs; only metrics return to the driver.
    """
    folded = kfold(df, k, seed, key)
    combinations = grid(space or SEARCH_SPACES[kind])
    limits = {} if kind in ESTIMATORS else {"epochs": CV_EPOCHS, "patience": CV_PATIENCE}

    # one scan for the scalers of all folds; networks hold back rows of their own and scale within
    scalers = fold_scalers(folded, [*features, target]) if kind in ESTIMATORS else {}

    def run(job: tuple[int, int]):
        at, fold = job
        train = folded.filter(F.col("fold") != fold)
        check = folded.filter(F.col("fold") == fold)
        params = combinations[at]
        model = fit_kind(
            train, kind, features, target, {**limits, **params}, scalers.get(fold), check, key
        )
        row = regression_metrics(model.predict(check, "_predicted"), target, "_predicted").first()
        return at, json.dumps(params), fold, row["rmse"], row["mae"]

    with ThreadPoolExecutor(parallelism) as pool:
        rows = list(pool.map(run, product(range(len(combinations)), range(k))))
    folds = df.sparkSession.createDataFrame(
        rows, "ordinal int, params string, fold int, rmse double, mae double"
    )
    means = {
        at: sum(r[3] for r in rows if r[0] == at) / k for at in range(len(combinations))
    }
    best = first_least(list(means.values()))
    return Search(kind, folds, fold_average(folds), combinations[best], means[best])
