"""Regression on the feature table with Spark ML."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.ml import Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import (
    GBTRegressor,
    LinearRegression,
    RandomForestRegressionModel,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairscore.functions.derived import interval
from pairscore.operators.scaling import Scaler, fit_scaler
from pairscore.schema import TARGET

ESTIMATORS = {
    "linear": LinearRegression,
    "random_forest": RandomForestRegressor,
    "gbt": GBTRegressor,
}
VECTOR = "_features"
SCALED_TARGET = "_scaled_target"
SCALED_PREDICTION = "_scaled_prediction"


@dataclass(frozen=True)
class Fitted:
    """A model with everything needed to apply it: feature order and both scalers."""

    kind: str
    features: list[str]
    feature_scaler: Scaler
    target_scaler: Scaler
    model: Model = field(repr=False)
    target: str = TARGET

    def predict(self, df: DataFrame, output: str = "predicted_score") -> DataFrame:
        """Scale, apply, scale back: one plan, whatever the size of ``df``.

        A row that lacks a feature (its text is missing) gets NULL; the others go on.
        """
        applied = self.model.transform(assemble(df, self.feature_scaler, self.features, 0.0))
        back = self.target_scaler.inverse(F.col(SCALED_PREDICTION), self.target)
        lacking = F.exists(F.array(*[F.col(c).isNull() for c in self.features]), lambda x: x)
        return applied.withColumn(output, F.when(~lacking, back)).drop(VECTOR, SCALED_PREDICTION)

    def scaled_function(self):
        """The model as a numpy function of scaled features, for use inside tasks."""
        if self.kind == "linear":
            weights, intercept = self.model.coefficients.toArray(), self.model.intercept
            return lambda x: x @ weights + intercept
        return export_trees(self.model)


@dataclass(frozen=True)
class Trees:
    """Fitted trees as arrays, one row per tree; a leaf has feature -1."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    weights: np.ndarray
    depth: int

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Weighted sum of the trees' predictions for the rows of ``x``."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for t, weight in enumerate(self.weights):
            at = np.zeros(len(x), dtype=int)
            for _ in range(self.depth):
                feature = self.feature[t, at]
                low = x[rows, np.maximum(feature, 0)] <= self.threshold[t, at]
                at = np.where(feature < 0, at, np.where(low, self.left[t, at], self.right[t, at]))
            total += weight * self.value[t, at]
        return total


def _nodes(node, rows: list) -> int:
    """Appends a node and all below it; returns its place."""
    place = len(rows)
    rows.append((-1, 0.0, place, place, node.prediction()))
    if node.subtreeDepth():
        split = node.split()
        left, right = _nodes(node.leftChild(), rows), _nodes(node.rightChild(), rows)
        rows[place] = (split.featureIndex(), split.threshold(), left, right, 0.0)
    return place


def export_trees(model: Model) -> Trees:
    """A fitted forest (mean of its trees) or boosted ensemble (weighted sum) as arrays."""
    tables = []
    for tree in model.trees:
        rows: list = []
        _nodes(tree._call_java("rootNode"), rows)
        tables.append(rows)
    size = max(map(len, tables))
    padded = [rows + [(-1, 0.0, 0, 0, 0.0)] * (size - len(rows)) for rows in tables]
    columns = [np.array([[r[i] for r in rows] for rows in padded]) for i in range(5)]
    weights = np.array(model.treeWeights, dtype=float)
    if isinstance(model, RandomForestRegressionModel):
        weights = weights / len(weights)
    return Trees(*columns, weights, max(tree.depth for tree in model.trees))


def assemble(
    df: DataFrame, scaler: Scaler, features: list[str], missing: float | None = None
) -> DataFrame:
    """Adds the vector of scaled features, ``missing`` for those that are NULL; without it NULL is an error."""
    scaled = [F.coalesce(scaler.scaled(c), F.lit(missing)) for c in features]
    return df.withColumn(VECTOR, array_to_vector(F.array(*scaled)))


def fit_regressor(
    df: DataFrame,
    kind: str,
    features: list[str],
    target: str = TARGET,
    params: dict | None = None,
    scaler: Scaler | None = None,
) -> Fitted:
    """Fit ``linear``, ``random_forest`` or ``gbt`` on scaled features and target.

    ``scaler`` is one already fitted on these rows, features first, target last.
    """
    if kind not in ESTIMATORS:
        raise ValueError(f"unknown model {kind!r}, expected one of {sorted(ESTIMATORS)}")
    # features and target are scaled with one pass over the data
    both = scaler or fit_scaler(df, [*features, target])
    feature_scaler = Scaler(list(features), both.mean[:-1], both.scale[:-1])
    target_scaler = Scaler([target], both.mean[-1:], both.scale[-1:])
    ready = assemble(df, feature_scaler, features).select(
        VECTOR, target_scaler.scaled(target).alias(SCALED_TARGET)
    )
    estimator = ESTIMATORS[kind](
        featuresCol=VECTOR,
        labelCol=SCALED_TARGET,
        predictionCol=SCALED_PREDICTION,
        **(params or {}),
    )
    return Fitted(kind, list(features), feature_scaler, target_scaler, estimator.fit(ready), target)


def with_interval(df: DataFrame, prediction: str = "predicted_score") -> DataFrame:
    lower, upper = interval(F.col(prediction))
    return df.withColumns({"confidence_lower": lower, "confidence_upper": upper})


@dataclass(frozen=True)
class FittedOnVectors:
    """A model over the two sentence vectors of a pair."""

    model: Model = field(repr=False)
    source_vector: str
    target_vector: str

    def predict(self, df: DataFrame, output: str = "predicted_score") -> DataFrame:
        joined = _join_vectors(df, self.source_vector, self.target_vector)
        return (
            self.model.transform(joined)
            .withColumnRenamed(SCALED_PREDICTION, output)
            .drop(VECTOR, "_a", "_b")
        )


def _join_vectors(df: DataFrame, a: str, b: str) -> DataFrame:
    made = df.withColumns(
        {
            "_a": array_to_vector(F.col(a).cast("array<double>")),
            "_b": array_to_vector(F.col(b).cast("array<double>")),
        }
    )
    return VectorAssembler(inputCols=["_a", "_b"], outputCol=VECTOR).transform(made)


def fit_embedding_regressor(
    df: DataFrame,
    source_vector: str,
    target_vector: str,
    target: str = TARGET,
    kind: str = "linear",
    params: dict | None = None,
) -> FittedOnVectors:
    """Regress the score on both sentence vectors instead of on the features."""
    ready = _join_vectors(df, source_vector, target_vector).select(VECTOR, target)
    estimator = ESTIMATORS[kind](
        featuresCol=VECTOR, labelCol=target, predictionCol=SCALED_PREDICTION, **(params or {})
    )
    return FittedOnVectors(estimator.fit(ready), source_vector, target_vector)


def tree_importance(fitted: Fitted, df: DataFrame, k: int | None = 10) -> DataFrame:
    """Features by their importance in a tree model, largest first."""
    weights = fitted.model.featureImportances.toArray()
    table = df.sparkSession.createDataFrame(
        [(f, float(w)) for f, w in zip(fitted.features, weights)],
        "feature string, importance double",
    )
    return sort_importance(table, k)


def sort_importance(importance: DataFrame, k: int | None = None) -> DataFrame:
    ordered = importance.orderBy(F.col("importance").desc(), "feature")
    return ordered.limit(k) if k else ordered
