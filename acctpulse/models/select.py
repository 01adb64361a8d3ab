"""One entry point for the three outlier models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from acctpulse.models import forest, lof, ocsvm

FITTERS = {
    "IsolationForest": forest.fit_forest,
    "LocalOutlierFactor": lof.fit_lof,
    "OneClassSVM": ocsvm.fit_ocsvm,
}
SCORERS = {
    "IsolationForest": forest.score_forest,
    "LocalOutlierFactor": lof.score_lof,
    "OneClassSVM": ocsvm.score_ocsvm,
}
SAVERS = {
    "IsolationForest": forest.save_forest,
    "LocalOutlierFactor": lof.save_lof,
    "OneClassSVM": ocsvm.save_ocsvm,
}
LOADERS = {
    "IsolationForest": forest.load_forest,
    "LocalOutlierFactor": lof.load_lof,
    "OneClassSVM": ocsvm.load_ocsvm,
}


def check(model_type: str) -> None:
    if model_type not in FITTERS:
        raise ValueError(f"there is no model named {model_type!r}, only {sorted(FITTERS)}")


def fit(
    df: DataFrame,
    features: Sequence[str],
    model_type: str = "IsolationForest",
    params: Mapping[str, Any] | None = None,
) -> Any:
    check(model_type)
    return FITTERS[model_type](df, features, **(params or {}))


def score(df: DataFrame, model: Any) -> DataFrame:
    return SCORERS[model.kind](df, model)


def save(spark: SparkSession, model: Any, path: str) -> None:
    SAVERS[model.kind](spark, model, path)


def load(spark: SparkSession, path: str) -> Any:
    kind = spark.read.parquet(f"{path.rstrip('/')}/meta").first()["kind"]
    return LOADERS[kind](spark, path)


def explains(model: Any) -> bool:
    """Contributions exist for tree models only."""
    return model.kind == "IsolationForest"
