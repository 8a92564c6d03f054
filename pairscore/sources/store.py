"""Fitted pipelines on disk: model, scalers, feature list, language model, ratio range."""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
from pyspark.ml.regression import (
    GBTRegressionModel,
    LinearRegressionModel,
    RandomForestRegressionModel,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairscore.operators.bilinear import FittedBilinear
from pairscore.operators.network import FittedNetwork, Shape
from pairscore.operators.regress import Fitted, FittedOnVectors
from pairscore.operators.scaling import Scaler
from pairscore.plans.features import RatioRange

MODELS = {
    "linear": LinearRegressionModel,
    "random_forest": RandomForestRegressionModel,
    "gbt": GBTRegressionModel,
}


VECTOR_PARTS = ("linear", "left", "right", "mean", "scale")


@dataclass(frozen=True)
class ScoringPipeline:
    """All that scoring needs, kept together."""

    fitted: Fitted | FittedNetwork
    lm: DataFrame
    ratio_range: RatioRange


def _scaler_rows(part: str, scaler: Scaler) -> list[tuple]:
    return [
        (part, i, c, float(scaler.mean[i]), float(scaler.scale[i]))
        for i, c in enumerate(scaler.columns)
    ]


def save_pipeline(spark: SparkSession, pipeline: ScoringPipeline, path: str) -> None:
    fitted = pipeline.fitted
    rows = _scaler_rows("feature", fitted.feature_scaler) + _scaler_rows(
        "target", fitted.target_scaler
    )
    spark.createDataFrame(
        rows, "part string, ordinal int, column string, mean double, scale double"
    ).write.parquet(f"{path}/scalers")
    pipeline.lm.write.parquet(f"{path}/lm")
    about = {
        "kind": fitted.kind,
        "target": fitted.target,
        "ratio_low": pipeline.ratio_range.low,
        "ratio_high": pipeline.ratio_range.high,
    }
    if isinstance(fitted, FittedNetwork):
        about["shape"] = vars(fitted.shape)
        spark.createDataFrame(
            [(i, float(v)) for i, v in enumerate(fitted.weights)], "slot long, value double"
        ).write.parquet(f"{path}/model")
        spark.createDataFrame(
            [(json.dumps(h),) for h in fitted.history], "value string"
        ).coalesce(1).write.text(f"{path}/history")
    else:
        fitted.model.write().save(f"{path}/model")
    # written last: a folder without it is an unfinished save
    spark.createDataFrame([(json.dumps(about),)], "value string").write.text(f"{path}/about")


def load_pipeline(spark: SparkSession, path: str) -> ScoringPipeline:
    """The saved pipeline; any missing part is an error."""

    def part(name, read):
        try:
            return read(f"{path}/{name}")
        except Exception as reason:
            raise FileNotFoundError(f"{path} has no usable {name!r}") from reason

    about = json.loads("".join(r[0] for r in part("about", spark.read.text).collect()))
    rows = sorted(part("scalers", spark.read.parquet).collect(), key=lambda r: r["ordinal"])
    scalers = {}
    for name in ("feature", "target"):
        mine = [r for r in rows if r["part"] == name]
        if not mine:
            raise FileNotFoundError(f"{path} has no {name} scaler")
        scalers[name] = Scaler(
            [r["column"] for r in mine], [r["mean"] for r in mine], [r["scale"] for r in mine]
        )
    features = scalers["feature"].columns
    common = (features, scalers["feature"], scalers["target"])
    if "shape" in about:
        slots = part("model", spark.read.parquet).orderBy("slot").toArrow()
        history = part("history", spark.read.text).select(F.col("value")).collect()
        fitted = FittedNetwork(
            Shape(**about["shape"]),
            *common,
            np.array(slots["value"].to_numpy()),
            [json.loads(r[0]) for r in history],
            about["target"],
        )
    else:
        model = part("model", MODELS[about["kind"]].load)
        fitted = Fitted(about["kind"], *common, model, about["target"])
    return ScoringPipeline(
        fitted,
        part("lm", spark.read.parquet),
        RatioRange(about["ratio_low"], about["ratio_high"]),
    )


NUMBERS = "part string, i int, j int, value double"


def save_vector_model(spark: SparkSession, fitted: FittedBilinear | FittedOnVectors, path: str) -> None:
    """A model over two vectors, with its scalers."""
    about = {"source_vector": fitted.source_vector, "target_vector": fitted.target_vector}
    if isinstance(fitted, FittedBilinear):
        about |= {"kind": fitted.kind, "target": fitted.target, "bias": fitted.bias, "errors": fitted.errors}
        parts = {name: np.atleast_2d(getattr(fitted, name)) for name in VECTOR_PARTS}
        rows = [(n, i, j, float(v)) for n, part in parts.items() for (i, j), v in np.ndenumerate(part)]
        spark.createDataFrame(rows, NUMBERS).write.parquet(f"{path}/model")
    else:
        about["kind"] = next(kind for kind, made in MODELS.items() if isinstance(fitted.model, made))
        fitted.model.write().save(f"{path}/model")
    # written last: a folder without it is an unfinished save
    spark.createDataFrame([(json.dumps(about),)], "value string").write.text(f"{path}/about")


def load_vector_model(spark: SparkSession, path: str) -> FittedBilinear | FittedOnVectors:
    """The saved model; a folder without a finished save is an error."""
    try:
        about = json.loads("".join(r[0] for r in spark.read.text(f"{path}/about").collect()))
    except Exception as reason:
        raise FileNotFoundError(f"{path} has no usable 'about'") from reason
    vectors = about["source_vector"], about["target_vector"]
    if about["kind"] != FittedBilinear.kind:
        return FittedOnVectors(MODELS[about["kind"]].load(f"{path}/model"), *vectors)
    found: dict[str, dict] = {name: {} for name in VECTOR_PARTS}
    for r in spark.read.schema(NUMBERS).parquet(f"{path}/model").collect():
        found[r["part"]][r["i"], r["j"]] = r["value"]
    parts = {}
    for name, cells in found.items():
        part = np.zeros([1 + max(at) for at in zip(*cells)])
        for at, value in cells.items():
            part[at] = value
        parts[name] = part if name in ("left", "right") else part[0]
    return FittedBilinear(*vectors, about["target"], about["bias"], **parts, errors=tuple(about["errors"]))
