"""Whole workflows: from arriving claims to a stored sample, and from rows to a model in production."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from ..operators import evaluate, models, profile, quality, sampling
from ..operators.features import FeaturePlan, FeatureState
from ..operators.registry import ModelRegistry
from ..sources import files


@dataclass
class Ingested:
    """The stored sample and what is known of it."""

    sample: DataFrame
    checks: DataFrame
    report: DataFrame
    missing: DataFrame
    summary: DataFrame


def ingest(
    spark: SparkSession,
    claims: DataFrame,
    lookups: Mapping[str, DataFrame],
    path: str,
    id_column: str = "CLAIM_ID_KEY",
    n_ids: int = 1_000_000,
    seed: int = 42,
    mean_of: str | None = "AMT_PAID",
) -> Ingested:
    """Samples whole claims, adds the descriptions of their codes, stores the result, validates and profiles it.

    ``lookups`` maps code columns to tables whose first column is the code. The sample is written
    once as Parquet; checks and profiles read the stored table.
    """
    rows = sampling.sample_by_key(claims, id_column, n_ids, seed)
    for column, lookup in lookups.items():
        rows = files.enrich_lookup(rows, lookup, column)
    files.write_parquet(rows, path)
    stored = files.read_parquet(spark, path)
    checks = quality.validate_claims(stored)
    return Ingested(stored, checks, quality.validation_report(checks), profile.missing_profile(stored), profile.table_profile(stored, mean_of))


@dataclass
class Trained:
    """All fits of a workflow, the best one as it was read back, and how that does on the test rows."""

    results: dict[str, models.TrainingResult]
    comparison: DataFrame
    version: str
    best: str
    model: models.FittedModel
    metrics: DataFrame
    scored: DataFrame


def train(
    rows: DataFrame,
    registry: ModelRegistry,
    label: str,
    encoded: Sequence[str] = (),
    scaled: Sequence[str] = (),
    model_types: Sequence[str] | None = None,
    params: Mapping[str, Mapping[str, Any]] | None = None,
    test_size: float = 0.2,
    key_columns: Sequence[str] | None = None,
    name: str = "claims_predictor",
    version: str = "1",
) -> Trained:
    """Splits, fits the features on the training side, trains all types, registers and promotes the best.

    The best model by validation r2 is saved with its fitted features, promoted, read back from the
    registry, and evaluated on the raw test rows.
    """
    tagged = sampling.tag_test_rows(rows, test_size, key_columns, flag="__test")
    sides = [tagged.filter(f).drop("__test") for f in ("NOT __test", "__test")]
    inputs = [*encoded, *scaled, label]
    state: FeatureState = FeaturePlan(label, tuple(encoded), tuple(scaled)).fit(sides[0].select(*inputs))
    results = models.train_all(*sides, state.feature_names, label, model_types, params, version, state)
    best = models.best_result(results)
    if best is None:
        raise RuntimeError("no model was fitted")
    registry.save(best, name)
    registry.promote(name, version)
    model, promoted = registry.production()
    metrics, scored = evaluate.evaluate_model(model, sides[1], label)
    return Trained(results, models.metrics_table(rows.sparkSession, results), promoted, best.kind, model, metrics, scored)
