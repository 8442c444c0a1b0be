"""Distributed regression models with the usual names and parameters."""

from __future__ import annotations

import logging
import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark import StorageLevel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array  # noqa: F401
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import columns as fx
from .boost import AdaBoostR2, Boosted, FlatTrees, GradientBoosting  # noqa: F401
from .evaluate import metric_columns
from .features import FeatureState, feature_columns
from .forest import RandomForest, RandomForestModel
from .linear import KINDS as LINEAR, LinearEstimator, LinearFit, MOST_FEATURES

log = logging.getLogger(__name__)

# Default parameters per model type.
DEFAULTS: dict[str, dict[str, Any]] = {
    "lasso": {"alpha": 0.1, "max_iter": 1000},
    "ridge": {"alpha": 0.5, "max_iter": 1000},
    "elasticnet": {"alpha": 0.1, "l1_ratio": 0.5, "max_iter": 1000},
    "random_forest": {"n_estimators": 300, "max_depth": 30, "max_features": "sqrt", "random_state": 42},
    "gradient_boosting": {"n_estimators": 200, "max_depth": 5, "learning_rate": 0.1, "random_state": 42},
    "adaboost": {"n_estimators": 200, "learning_rate": 1.0, "random_state": 42},
}

# Parameter grids for tuning.
GRIDS: dict[str, dict[str, list]] = {
    "lasso": {"alpha": [0.001, 0.01, 0.1, 1.0, 10.0]},
    "ridge": {"alpha": [0.01, 0.1, 0.5, 1.0, 5.0, 10.0]},
    "random_forest": {
        "n_estimators": [100, 200, 300],
        "max_depth": [10, 20, 30, None],
        "max_features": ["sqrt", "log2"],
        "min_samples_split": [2, 5, 10],
    },
    "gradient_boosting": {"n_estimators": [100, 200, 300], "max_depth": [3, 5, 7], "learning_rate": [0.01, 0.1, 0.2]},
}

MAX_DEPTH = 30  # the deepest boosted tree; it also stands for "unlimited"
FEATURES, PREDICTION = "features", "prediction"


def model_params(model_type: str, params: Mapping[str, Any] | None = None) -> dict[str, Any]:
    if model_type not in DEFAULTS:
        raise ValueError(f"unknown model type: {model_type}")
    return {**DEFAULTS[model_type], **(params or {})}


def penalty(model_type: str, params: Mapping[str, Any], rows: int, deviation: float) -> tuple[float, float]:
    """(regParam, elasticNetParam) for penalties stated on the unscaled squared error.

    MLlib divides the label by its deviation s and the loss by the row count, so an L1 weight
    carries over unchanged, while an L2 weight is multiplied by s (and, for ridge, whose
    penalty is not averaged, divided by the row count).
    """
    alpha = params["alpha"]
    if model_type == "lasso":
        return alpha, 1.0
    if model_type == "ridge":
        return alpha / rows * deviation, 0.0
    l1, l2 = alpha * params["l1_ratio"], alpha * (1 - params["l1_ratio"]) * deviation
    return l1 + l2, (l1 / (l1 + l2) if l1 + l2 else 0.0)


def _label_size(df: DataFrame, label: str) -> tuple[int, float]:
    row = df.agg(F.count(fx.quoted(label)).alias("n"), F.stddev_pop(fx.quoted(label)).alias("s")).first()
    return row["n"], row["s"] or 0.0


def vector_size(df: DataFrame) -> int:
    """Length of the vector column, from its metadata or its first row; 0 without rows."""
    known = df.schema[FEATURES].metadata.get("ml_attr", {}).get("num_attrs")
    if known is not None:
        return known
    first = df.select(FEATURES).where(F.col(FEATURES).isNotNull()).first()
    return first[0].size if first else 0


def estimator(model_type: str, params: Mapping[str, Any], df: DataFrame, label: str):
    """An estimator over a vector column.

    Linear models are solved from one scan's sums, or, with very many features, by MLlib's
    iterations, for which ``df`` supplies the row count and deviation that penalties need.
    """
    if model_type in LINEAR:
        if vector_size(df) <= MOST_FEATURES:
            return LinearEstimator(model_type, params, label)
        reg, mix = penalty(model_type, params, *_label_size(df, label))
        return LinearRegression(
            featuresCol=FEATURES, labelCol=label, regParam=reg, elasticNetParam=mix, standardization=False,
            maxIter=params["max_iter"], tol=params.get("tol", 1e-8),
        )
    seed = params.get("random_state", 42)
    if model_type == "random_forest":
        return RandomForest(
            label, params["n_estimators"], params.get("max_depth"), params.get("max_features"), params.get("min_samples_split", 2), seed,
            params.get("bootstrap", True),
        )
    depth = params.get("max_depth") or MAX_DEPTH
    if depth > MAX_DEPTH:
        raise ValueError(f"max_depth {depth}: boosted trees are at most {MAX_DEPTH} deep")
    # a split needs two leaves, so half the minimum split size is the nearest leaf bound
    leaf = max(1, params.get("min_samples_split", 2) // 2)
    if model_type == "gradient_boosting":
        return GradientBoosting(label, params["n_estimators"], params["learning_rate"], depth, leaf)
    return AdaBoostR2(label, params["n_estimators"], params["learning_rate"], params.get("max_depth", 3), seed)


# --- training -----------------------------------------------------------------------------


@dataclass
class FittedModel:
    """A fitted regressor and the columns it reads, usable on DataFrames without a vector column.

    With a ``state`` the columns are made from raw rows first: dummies by the fitted vocabulary,
    values scaled by the fitted scalers. Columns of the input stay as they are.
    """

    regressor: Any
    feature_names: list[str]
    state: FeatureState | None = None

    def transform(self, df: DataFrame) -> DataFrame:
        if FEATURES in df.columns:
            return self.regressor.transform(df)
        if self.state is not None and isinstance(self.regressor, LinearFit):  # needs no vectors in between
            return df.withColumn(PREDICTION, self.regressor.predicted(F.array(*feature_values(df, self.feature_names, self.state))))
        return self.regressor.transform(with_vectors(df, self.feature_names, self.state)).drop(FEATURES)


@dataclass
class TrainingResult:
    """A fitted model and how it did: metrics by side (train, validation), training rows, importances.

    A model that could not be fitted has an ``error`` and no model.
    """

    kind: str
    version: str
    model: FittedModel | None = None
    scores: dict[str, dict[str, float]] = field(default_factory=dict)
    rows: int = 0
    importances: dict[str, float] = field(default_factory=dict)
    error: str | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.version}"


def assemble(df: DataFrame, feature_names: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(feature_names), outputCol=FEATURES, handleInvalid="error").transform(df)


def with_vectors(df: DataFrame, feature_names: Sequence[str], state: FeatureState | None = None) -> DataFrame:
    """The vector column from columns as they are, or made from raw ones by a fitted state."""
    if state is None:
        return assemble(df, feature_names)
    return df.withColumn(FEATURES, array_to_vector(F.array(*feature_values(df, feature_names, state))))


def feature_values(df: DataFrame, feature_names: Sequence[str], state: FeatureState) -> list[Column]:
    """The features made from raw rows. A missing value has no place in a vector; like the assembler, refuse it."""
    columns = feature_columns(df, state)
    return [F.coalesce(columns[n].cast("double"), F.raise_error(F.lit(f"missing value in feature {n}")).cast("double")) for n in feature_names]


def training_cache(df: DataFrame) -> DataFrame:
    """Persist rows that will be scanned many times, spread over all cores.

    Adaptive execution packs small results into few partitions, which would leave most cores
    idle in every pass of an iterative fit. Evenly filled inputs are left as they are.
    """
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    sizes = [r["count"] for r in cached.groupBy(F.spark_partition_id()).count().collect()]
    cores = df.sparkSession.sparkContext.defaultParallelism
    if not sizes or max(sizes) * cores <= 2 * sum(sizes):
        return cached
    spread = cached.repartition(max(cores, len(sizes))).persist(StorageLevel.MEMORY_AND_DISK)
    spread.count()
    cached.unpersist()
    return spread


def importances_of(regressor, feature_names: Sequence[str]) -> dict[str, float]:
    if isinstance(regressor, Boosted):
        values = regressor.importances()
    elif isinstance(regressor, RandomForestModel):
        values = regressor.importances
    elif hasattr(regressor, "featureImportances"):
        values = regressor.featureImportances.toArray().tolist()
    else:
        values = [abs(c) for c in regressor.coefficients.toArray().tolist()]
    return dict(zip(feature_names, values))


def _metrics(scored: DataFrame, label: str) -> dict[str, float]:
    found = metric_columns(fx.quoted(label), F.col(PREDICTION))
    row = scored.agg(F.count(F.lit(1)).alias("n"), *[found[k].alias(k) for k in ("r2", "rmse", "mae")]).first()
    return row.asDict()


def fit_regressor(model_type: str, df: DataFrame, label: str, params: Mapping[str, Any] | None = None):
    """Fit on a DataFrame that already has a vector column."""
    return estimator(model_type, model_params(model_type, params), df, label).fit(df)


def train_model(
    model_type: str,
    train: DataFrame,
    validation: DataFrame,
    feature_names: Sequence[str],
    label: str,
    params: Mapping[str, Any] | None = None,
    version: str | None = None,
    state: FeatureState | None = None,
) -> TrainingResult:
    """Fit one model and measure it on both sides.

    With ``state`` both sides are raw rows, and the model keeps the state for the rows it will score.
    """
    full, names = model_params(model_type, params), list(feature_names)
    vectors = with_vectors(train, names, state)
    regressor = estimator(model_type, full, vectors, label).fit(vectors)
    model = FittedModel(regressor, names, state)
    fitted = _metrics(model.transform(train), label)
    held_out = dict(fitted) if validation is train else _metrics(model.transform(validation), label)
    rows = fitted.pop("n")
    held_out.pop("n")
    scores = {"train": fitted, "validation": held_out}
    return TrainingResult(model_type, version or time.strftime("%Y%m%d_%H%M%S"), model, scores, rows, importances_of(regressor, names))


def train_all(
    train: DataFrame,
    validation: DataFrame,
    feature_names: Sequence[str],
    label: str,
    model_types: Sequence[str] | None = None,
    params: Mapping[str, Mapping[str, Any]] | None = None,
    version: str | None = None,
    state: FeatureState | None = None,
) -> dict[str, TrainingResult]:
    """One result per type, all on the same cached split. A type that cannot be fitted has an error in its place."""
    sides = training_cache(train), validation.persist(StorageLevel.MEMORY_AND_DISK)
    settings, stamp = params or {}, version or time.strftime("%Y%m%d_%H%M%S")
    results: dict[str, TrainingResult] = {}
    for kind in model_types or DEFAULTS:
        try:
            results[kind] = train_model(kind, *sides, feature_names, label, settings.get(kind), stamp, state)
        except Exception as error:
            log.exception("%s was not fitted", kind)
            results[kind] = TrainingResult(kind, stamp, error=f"{type(error).__name__}: {str(error).splitlines()[0] if str(error) else ''}")
    for side in sides:
        side.unpersist()
    return results


def metrics_table(spark: SparkSession, results: Mapping[str, TrainingResult]) -> DataFrame:
    """One row per result; one that was not fitted has null metrics and its error."""
    rows = [
        (name, r.scores.get("train", {}).get("r2"), *[r.scores.get("validation", {}).get(k) for k in ("r2", "rmse", "mae")], r.error)
        for name, r in results.items()
    ]
    return spark.createDataFrame(rows, "model string, train_r2 double, r2 double, rmse double, mae double, error string")


def best_model(metrics: DataFrame, score: str = "r2") -> DataFrame:
    """The row with the highest score; empty in, empty out."""
    return metrics.filter(F.col(score).isNotNull()).orderBy(F.desc(score), "model").limit(1)


def best_result(results: Mapping[str, TrainingResult]) -> TrainingResult | None:
    scored = [r for r in results.values() if r.scores and r.scores["validation"]["r2"] is not None]
    return max(scored, key=lambda r: r.scores["validation"]["r2"], default=None)
