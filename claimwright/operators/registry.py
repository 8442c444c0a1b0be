"""A model registry: model folders plus append-only tables of events and metrics.

A saved version is one artifact: the regressor and, if it has one, the fitted state that turns raw
rows into its features. Every save and promotion appends one event. Latest and production are the
newest events, so writers never rewrite what readers see. Works on any folder Spark can write,
local or remote.
"""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.ml.regression import GBTRegressionModel, LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from .boost import AdaBoostR2Model, GradientBoostingModel
from .features import load_state, save_state
from .forest import RandomForestModel
from .linear import LinearFit
from .models import FittedModel, TrainingResult

EVENTS = "event string, model string, version string, at bigint, kind string, regressor string, features array<string>, has_state boolean, rows bigint"
METRICS = "model string, version string, side string, metric string, value double"

# Regressors that write themselves as tables, and those that MLlib writes.
OWN = {c.__name__: c for c in (LinearFit, RandomForestModel, GradientBoostingModel, AdaBoostR2Model)}
MLLIB = {c.__name__: c for c in (LinearRegressionModel, GBTRegressionModel)}


class ModelRegistry:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _append(self, table: str, schema: str, rows: list[tuple]) -> None:
        self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{self.root}/{table}")

    def _read(self, table: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{table}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def events(self) -> DataFrame:
        return self._read("events", EVENTS)

    def metrics(self) -> DataFrame:
        """(model, version, side, metric, value) of every saved version."""
        return self._read("metrics", METRICS)

    def _path(self, name: str, version: str) -> str:
        return f"{self.root}/models/{name}/v{version}"

    def save(self, result: TrainingResult, name: str | None = None) -> str:
        """Writes regressor and state, then the metrics, then the event that makes them visible."""
        if result.model is None:
            raise ValueError(f"{result.kind} was not fitted: {result.error}")
        name, version, model = name or result.name, result.version, result.model
        path, kind = self._path(name, version), type(model.regressor).__name__
        if kind in OWN:
            model.regressor.save(self.spark, f"{path}/regressor")
        else:
            model.regressor.write().overwrite().save(f"{path}/regressor")
        if model.state is not None:
            save_state(self.spark, model.state, f"{path}/state")
        values = [(name, version, side, metric, value) for side, found in result.scores.items() for metric, value in found.items()]
        if values:
            self._append("metrics", METRICS, values)
        self._append("events", EVENTS, [("save", name, version, time.time_ns(), result.kind, kind, model.feature_names, model.state is not None, result.rows)])
        return path

    def list_models(self) -> DataFrame:
        """(model, versions, latest), versions in the order they were saved."""
        saved = self.events().filter("event = 'save'")
        ordered = F.array_sort(F.collect_list(F.struct("at", "version")))["version"]
        return saved.groupBy("model").agg(ordered.alias("versions"), F.max_by("version", "at").alias("latest"))

    def _find(self, name: str, version: str | None):
        saved = self.events().filter((F.col("event") == "save") & (F.col("model") == name))
        if version is not None:
            saved = saved.filter(F.col("version") == version)
        newest = saved.orderBy(F.desc("at")).limit(1).collect()
        if not newest:
            raise ValueError(f"model not found: {name}" + (f" version {version}" if version else ""))
        return newest[0]

    def load(self, name: str, version: str | None = None) -> FittedModel:
        """The given version, or the latest, with its state."""
        entry = self._find(name, version)
        path = self._path(name, entry["version"])
        own = OWN.get(entry["regressor"])
        regressor = own.load(self.spark, f"{path}/regressor") if own else MLLIB[entry["regressor"]].load(f"{path}/regressor")
        state = load_state(self.spark, f"{path}/state") if entry["has_state"] else None
        return FittedModel(regressor, list(entry["features"]), state)

    def promote(self, name: str, version: str | None = None) -> None:
        found = self._find(name, version)
        self._append("events", EVENTS, [("promote", name, found["version"], time.time_ns(), found["kind"], None, None, None, None)])

    def production_pointer(self) -> DataFrame:
        """(model, version) in production; no row if none was promoted."""
        newest = F.max_by(F.struct("model", "version"), "at").alias("newest")
        return self.events().filter("event = 'promote'").agg(newest).filter("newest IS NOT NULL").select("newest.*")

    def production(self) -> tuple[FittedModel, str] | None:
        """The model in production and its version."""
        row = self.production_pointer().first()
        return (self.load(row["model"], row["version"]), row["version"]) if row else None
