"""Regression metrics and the data behind evaluation charts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import columns as fx
from .profile import histogram
from .quantiles import exact_percentiles

METRICS = ("r2", "rmse", "mae", "mape", "explained_variance", "residual_mean", "residual_std")


def _share_explained(unexplained: Column, total: Column) -> Column:
    """1 - unexplained / total; a constant target gives 1 for a perfect fit, else 0."""
    return F.when(total == 0, F.when(unexplained == 0, 1.0).otherwise(0.0)).otherwise(1 - F.try_divide(unexplained, total))


def metric_columns(actual: Column, predicted: Column) -> dict[str, Column]:
    """The seven metrics as aggregate expressions over rows where both values are present."""
    y = F.when(predicted.isNotNull(), actual.cast("double"))
    p = F.when(actual.isNotNull(), predicted.cast("double"))
    error = y - p
    absolute = F.abs(error)
    mse, spread = F.avg(error * error), fx.spread_pop(y)
    return {
        "r2": _share_explained(mse, spread),
        "rmse": F.sqrt(mse),
        "mae": F.avg(absolute),
        "mape": F.avg(F.when(y != 0, F.try_divide(absolute, F.abs(y)))),
        "explained_variance": _share_explained(fx.spread_pop(error), spread),
        "residual_mean": F.avg(error),
        "residual_std": F.sqrt(fx.spread_pop(error)),
    }


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """All metrics in one pass."""
    return df.agg(*[v.alias(k) for k, v in metric_columns(fx.quoted(actual), fx.quoted(predicted)).items()])


def evaluate_model(model, df: DataFrame, actual: str, prediction: str = "prediction") -> tuple[DataFrame, DataFrame]:
    """(metrics, scored rows) of a fitted model on held-out rows."""
    scored = model.transform(df)
    return regression_metrics(scored, actual, prediction), scored


def compare_predictions(df: DataFrame, actual: str, predictions: Mapping[str, str]) -> DataFrame:
    """Metrics per model, best r2 first, from one row set with a prediction column per model.

    Every model's metrics are aggregated side by side in one pass.
    """
    models = list(predictions)
    measures, rows = [], []
    for i, name in enumerate(models):
        found = metric_columns(fx.quoted(actual), fx.quoted(predictions[name]))
        measures += [v.alias(f"{k}_{i}") for k, v in found.items()]
        rows.append(F.struct(F.lit(name).alias("model"), *[F.col(f"{k}_{i}").alias(k) for k in METRICS]))
    return df.agg(*measures).select(F.inline(F.array(*rows))).orderBy(F.desc_nulls_last("r2"), "model")


def compare_models(models: Mapping[str, object], df: DataFrame, actual: str, prediction: str = "prediction") -> DataFrame:
    """``compare_predictions`` for fitted models: all of them score the rows in one projection chain."""
    scored, columns = df, {}
    for i, (name, model) in enumerate(models.items()):
        before = set(scored.columns)
        out = model.transform(scored)
        extra = [c for c in out.columns if c not in before and c != prediction]
        columns[name] = f"__prediction_{i}"
        scored = out.withColumnRenamed(prediction, columns[name]).drop(*extra)
    return compare_predictions(scored, actual, columns)


def business_impact(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    y, p = fx.quoted(actual), fx.quoted(predicted)
    mean, mae = F.avg(F.when(p.isNotNull(), y)), F.avg(F.abs(y - p))
    return df.agg(mean.alias("mean_actual"), mae.alias("mae"), F.try_divide(mae, mean).alias("mae_share"))


def pred_vs_actual_data(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """(actual, predicted, residual) per row."""
    y, p = fx.quoted(actual).cast("double"), fx.quoted(predicted).cast("double")
    return df.select(y.alias("actual"), p.alias("predicted"), (y - p).alias("residual"))


def shared_line(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Ends of the diagonal: smallest and largest of both columns."""
    y, p = fx.quoted(actual).cast("double"), fx.quoted(predicted).cast("double")
    return df.agg(F.least(F.min(y), F.min(p)).alias("low"), F.greatest(F.max(y), F.max(p)).alias("high"))


def residual_histogram(df: DataFrame, actual: str, predicted: str, bins: int = 50) -> DataFrame:
    """Histogram of actual - predicted, with the mean residual on each row."""
    residual = fx.quoted(actual).cast("double") - fx.quoted(predicted).cast("double")
    mean = df.agg(F.avg(residual)).first()[0]
    return histogram(df, residual, bins).withColumn("mean_residual", F.lit(mean).cast("double"))


def qq_points(df: DataFrame, actual: str, predicted: str, points: int = 99) -> DataFrame:
    """Residual percentiles against normal quantiles at evenly spaced shares."""
    shares = [i / (points + 1) for i in range(1, points + 1)]
    residuals = df.select((fx.quoted(actual).cast("double") - fx.quoted(predicted).cast("double")).alias("residual"))
    found = exact_percentiles(residuals, {"residual": shares})["residual"]
    normal = NormalDist()
    rows = [(s, normal.inv_cdf(s), v) for s, v in zip(shares, found)]
    return df.sparkSession.createDataFrame(rows, "share double, theoretical double, residual double")


def importance_rank(scores: DataFrame, score: str, n: int = 20, feature: str = "feature") -> DataFrame:
    """The n largest by absolute value, sign kept."""
    return scores.orderBy(F.desc_nulls_last(F.abs(F.col(score))), feature).limit(n)


def learning_curve_data(scores: DataFrame, size: str = "train_size", columns: Sequence[str] = ("train", "validation")) -> DataFrame:
    """Mean and population deviation over folds, per training size."""
    measures = []
    for c in columns:
        measures += [F.avg(c).alias(f"{c}_mean"), F.stddev_pop(c).alias(f"{c}_std")]
    return scores.groupBy(size).agg(*measures)


def evaluation_report(
    model, df: DataFrame, actual: str, importances: DataFrame | None = None, prediction: str = "prediction"
) -> dict[str, DataFrame | None]:
    """Everything about one model on one row set; all parts are lazy."""
    metrics, scored = evaluate_model(model, df, actual, prediction)
    return {
        "metrics": metrics,
        "predictions": pred_vs_actual_data(scored, actual, prediction),
        "line": shared_line(scored, actual, prediction),
        "importances": importances,
    }
