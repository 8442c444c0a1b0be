"""Cross-validation and parameter search on seeded folds."""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import product
from math import sqrt
from typing import Any

from pyspark.sql import DataFrame, functions as F

from ..functions import columns as fx
from .evaluate import metric_columns
from .linear import KINDS as LINEAR, MOST_FEATURES, Moments, fold_scores, merged, moments, r2, solve
from .models import FEATURES, GRIDS, PREDICTION, assemble, estimator, model_params, training_cache
from .sampling import k_folds

SHARES = (0.1, 0.325, 0.55, 0.775, 1.0)  # fixed values: sizes of a learning curve, evenly spaced
SHARE_STEPS = 1_000_000  # a share is told by a seeded key of this many steps


def _fold_scores(
    model_type: str, folded: DataFrame, label: str, fold_column: str, k: int, candidates: Sequence[Mapping[str, Any]], parallelism: int
) -> list[list[float | None]]:
    """r2 per candidate and fold, null where the fold or the rest has no row.

    Fits are Spark jobs; a few are in flight at a time.
    """
    held = {r[fold_column]: r["count"] for r in folded.groupBy(fold_column).count().collect()}

    def one(task: tuple[Mapping[str, Any], int]) -> float | None:
        params, fold = task
        if not held.get(fold) or held[fold] == sum(held.values()):
            return None
        train = folded.filter(F.col(fold_column) != fold)
        test = folded.filter(F.col(fold_column) == fold)
        model = estimator(model_type, model_params(model_type, params), train, label).fit(train)
        r2 = metric_columns(fx.quoted(label), F.col(PREDICTION))["r2"]
        return model.transform(test).agg(r2).first()[0]

    tasks = [(c, fold) for c in candidates for fold in range(k)]
    with ThreadPoolExecutor(parallelism) as pool:
        scores = list(pool.map(one, tasks))
    return [scores[i * k:(i + 1) * k] for i in range(len(candidates))]


def _folded(
    df: DataFrame, feature_names: Sequence[str], label: str, k: int, seed: int, fold_keys: Sequence[str] | None
) -> DataFrame:
    """Vectors, label and fold of all rows that have a label."""
    names = list(feature_names)
    folds = k_folds(df, k, fold_keys or [*names, label], seed, "__fold").where(fx.known(df, label).isNotNull())
    return assemble(folds, names).select(FEATURES, fx.quoted(label), "__fold")


def _scores(
    model_type: str, df: DataFrame, feature_names: Sequence[str], label: str, k: int, candidates: Sequence[Mapping[str, Any]], seed: int,
    parallelism: int, fold_keys: Sequence[str] | None,
) -> list[list[float | None]]:
    """Linear models take one scan for all folds and candidates, others a fit for each."""
    folded = _folded(df, feature_names, label, k, seed, fold_keys)
    if model_type in LINEAR and len(feature_names) <= MOST_FEATURES:
        by_fold = {key[0]: m for key, m in moments(folded, label, [F.col("__fold")]).items()}
        return fold_scores(model_type, by_fold, k, [model_params(model_type, c) for c in candidates])
    cached = training_cache(folded)
    try:
        return _fold_scores(model_type, cached, label, "__fold", k, candidates, parallelism)
    finally:
        cached.unpersist()


def _mean(scores: Sequence[float | None]) -> float | None:
    known = [s for s in scores if s is not None]
    return sum(known) / len(known) if known else None


def cross_validate(
    model_type: str,
    df: DataFrame,
    feature_names: Sequence[str],
    label: str,
    cv: int = 5,
    params: Mapping[str, Any] | None = None,
    seed: int = 42,
    parallelism: int = 4,
    fold_keys: Sequence[str] | None = None,
) -> dict[str, Any]:
    """mean_r2, std_r2 (population) and the score of each fold.

    Folds follow a seeded key of ``fold_keys`` (by default features and label). A fold without rows,
    or with all of them, has no score and does not count; without any score mean and std are None.
    """
    model_params(model_type, params)
    scores = _scores(model_type, df, feature_names, label, cv, [params or {}], seed, parallelism, fold_keys)[0]
    mean, known = _mean(scores), [s for s in scores if s is not None]
    return {"mean_r2": mean, "std_r2": sqrt(sum((s - mean) ** 2 for s in known) / len(known)) if known else None, "scores": scores}


def learning_curve(
    model_type: str,
    df: DataFrame,
    feature_names: Sequence[str],
    label: str,
    shares: Sequence[float] = SHARES,
    cv: int = 5,
    params: Mapping[str, Any] | None = None,
    seed: int = 42,
    fold_keys: Sequence[str] | None = None,
) -> DataFrame:
    """(share, fold, train_rows, train, validation): r2 of fits on growing shares of the other folds.

    Shares grow by a seeded key, so each holds the smaller ones. Linear models take one scan: the
    moments of every fold and slice between two shares add up to those of every fit.
    """
    full, names, ends = model_params(model_type, params), list(feature_names), sorted(shares)
    key = fx.row_key(df, list(fold_keys or [*names, label]), seed)
    step = (F.floor(key / cv) % SHARE_STEPS) / SHARE_STEPS
    rows = df.withColumns({"__fold": (key % cv).cast("int"), "__slice": sum(((step >= e).cast("int") for e in ends), F.lit(0))})
    rows = assemble(rows.where(fx.known(df, label).isNotNull()), names).select(FEATURES, fx.quoted(label), "__fold", "__slice")
    found: list[tuple[float, int, int, float | None, float | None]] = []
    if model_type in LINEAR and len(names) <= MOST_FEATURES:
        cells = moments(rows, label, [F.col("__fold"), F.col("__slice")])

        def total(wanted) -> Moments:
            return merged((m for k, m in sorted(cells.items()) if wanted(*k)), len(names) + 1)

        for fold in range(cv):
            test = total(lambda f, _: f == fold)
            for i, share in enumerate(ends):
                train = total(lambda f, at: f != fold and at <= i)
                fit = solve(model_type, full, train) if train.n else None
                found.append((float(share), fold, int(train.n), *[r2(fit, m) if fit else None for m in (train, test)]))
    else:
        cached = training_cache(rows)
        share_explained = metric_columns(fx.quoted(label), F.col(PREDICTION))["r2"]
        for fold in range(cv):
            for i, share in enumerate(ends):
                train = cached.where((F.col("__fold") != fold) & (F.col("__slice") <= i))
                n = train.count()
                fit = estimator(model_type, full, train, label).fit(train) if n else None
                sides = (train, cached.where(F.col("__fold") == fold))
                found.append((float(share), fold, n, *[fit.transform(side).agg(share_explained).first()[0] if fit else None for side in sides]))
        cached.unpersist()
    return df.sparkSession.createDataFrame(found, "share double, fold int, train_rows bigint, train double, validation double")


def grid_points(grid: Mapping[str, Sequence], n_iter: int | None = None, seed: int = 42) -> list[dict[str, Any]]:
    """All combinations of the grid, or a seeded choice of ``n_iter`` of them."""
    points = [dict(zip(grid, values)) for values in product(*grid.values())]
    if n_iter is None or n_iter >= len(points):
        return points
    return random.Random(seed).sample(points, n_iter)


def tune(
    model_type: str,
    df: DataFrame,
    feature_names: Sequence[str],
    label: str,
    grid: Mapping[str, Sequence] | None = None,
    cv: int = 5,
    n_iter: int | None = None,
    base: Mapping[str, Any] | None = None,
    seed: int = 42,
    parallelism: int = 4,
    fold_keys: Sequence[str] | None = None,
) -> tuple[dict[str, Any], float, list[tuple[dict[str, Any], float]]]:
    """(best parameters, best mean r2, all points with their mean r2).

    Grid search over all points, or random search over ``n_iter`` of them. A model type without
    a grid gives ({}, 0.0, []).
    """
    model_params(model_type)
    grid = GRIDS.get(model_type, {}) if grid is None else grid
    if not grid:
        return {}, 0.0, []
    points = grid_points(grid, n_iter, seed)
    scores = _scores(model_type, df, feature_names, label, cv, [{**(base or {}), **p} for p in points], seed, parallelism, fold_keys)
    means = [_mean(s) for s in scores]
    best = max(range(len(points)), key=lambda i: float("-inf") if means[i] is None else means[i])
    return points[best], means[best], list(zip(points, means))


def tune_grid(model_type, df, feature_names, label, grid=None, cv=5, **options):
    return tune(model_type, df, feature_names, label, grid, cv, None, **options)


def tune_random(model_type, df, feature_names, label, n_iter, grid=None, cv=5, **options):
    return tune(model_type, df, feature_names, label, grid, cv, n_iter, **options)
