"""Feature selection by variance, correlation, F score, mutual information and forests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window, functions as F

from ..functions import columns as fx
from .bagged import BaggedTrees
from .features import bin_quantile
from .models import training_cache
from .neighbours import neighbour_information
from .profile import _correlations, correlation_matrix


def variances(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(feature, variance), population variance."""
    names = fx.present(df, columns or fx.numeric_columns(df))
    one = df.agg(*[fx.spread_pop(fx.quoted(c).cast("double")).alias(f"v{i}") for i, c in enumerate(names)])
    rows = [F.struct(F.lit(c).alias("feature"), F.col(f"v{i}").alias("variance")) for i, c in enumerate(names)]
    return one.select(F.inline(F.array(*rows)))


def select_variance(
    df: DataFrame, threshold: float = 0.01, columns: Sequence[str] | None = None
) -> tuple[DataFrame, list[str]]:
    """Drop columns whose population variance does not exceed the threshold."""
    found = {r["feature"]: r["variance"] for r in variances(df, columns).collect()}
    removed = [c for c, v in found.items() if v is None or not v > threshold]
    return df.drop(*removed), removed


def f_scores(df: DataFrame, target: str, columns: Sequence[str] | None = None) -> DataFrame:
    """(feature, f_score) of a one-feature regression: r^2 / (1 - r^2) * (n - 2)."""
    names = [c for c in fx.present(df, columns or fx.numeric_columns(df)) if c != target]
    pairs = _correlations(df, [(c, target) for c in names])
    goal = fx.quoted(target)
    counts = df.agg(*[F.count_if(fx.quoted(c).isNotNull() & goal.isNotNull()).alias(f"n{i}") for i, c in enumerate(names)])
    rows = [F.struct(F.lit(c).alias("x"), F.col(f"n{i}").alias("n")) for i, c in enumerate(names)]
    n = counts.select(F.inline(F.array(*rows)))
    square = F.col("r") * F.col("r")
    return pairs.join(n, "x").select(
        F.col("x").alias("feature"), (F.try_divide(square, 1 - square) * (F.col("n") - 2)).alias("f_score")
    )


def top_features(scores: DataFrame, score: str, n: int = 10, feature: str = "feature") -> DataFrame:
    """The n highest scores; missing scores rank last."""
    return scores.orderBy(F.desc_nulls_last(score), feature).limit(n)


def select_k_best_f(df: DataFrame, target: str, k: int = 20, columns: Sequence[str] | None = None) -> DataFrame:
    return top_features(f_scores(df, target, columns), "f_score", k)


def mutual_information(
    df: DataFrame, target: str, columns: Sequence[str] | None = None, n_bins: int = 10
) -> DataFrame:
    """(feature, mi) in nats between quantile bins of feature and target.

    All features share one pass: bin pairs are counted per feature, which leaves at most
    ``n_bins**2`` rows each.
    """
    names = [c for c in fx.present(df, columns or fx.numeric_columns(df)) if c != target]
    binned = bin_quantile(df.select(*[fx.quoted(c) for c in [*names, target]]), [*names, target], n_bins)
    pairs = [
        F.struct(F.lit(c).alias("feature"), fx.quoted(f"{c}_binned").alias("a"), fx.quoted(f"{target}_binned").alias("b"))
        for c in names
    ]
    cells = (
        binned.select(F.inline(F.array(*pairs)))
        .filter("a IS NOT NULL AND b IS NOT NULL")
        .groupBy("feature", "a", "b")
        .agg(F.count(F.lit(1)).cast("double").alias("n"))
    )
    w = Window.partitionBy
    sized = cells.withColumns(
        {
            "all": F.sum("n").over(w("feature")),
            "na": F.sum("n").over(w("feature", "a")),
            "nb": F.sum("n").over(w("feature", "b")),
        }
    )
    term = F.col("n") / F.col("all") * F.log(F.col("n") * F.col("all") / (F.col("na") * F.col("nb")))
    return sized.groupBy("feature").agg(F.sum(term).alias("mi"))


def select_k_best_mi(df: DataFrame, target: str, k: int = 20, columns: Sequence[str] | None = None, n_neighbors: int = 3) -> DataFrame:
    """The k features of most mutual information with the target, by nearest neighbours."""
    return top_features(neighbour_information(df, target, columns, n_neighbors), "mi", k)


def selected(df: DataFrame, target: str, scores: DataFrame, feature: str = "feature") -> DataFrame:
    """The reduced frame: the features of a score table, in the order of the columns, and the target."""
    wanted = {r[0] for r in scores.select(feature).collect()}
    return df.select(*[fx.quoted(c) for c in df.columns if c in wanted or c == target])


def forest_importances(
    df: DataFrame, target: str, names: Sequence[str], trees: int, depth: int, seed: int = 42, fill: float = 0.0
) -> dict[str, float]:
    """Importances over all rows; missing features (null or NaN) count as ``fill``."""
    filled = [F.coalesce(fx.known(df, c).cast("double"), F.lit(fill)).alias(c) for c in names]
    vectors = VectorAssembler(inputCols=list(names), outputCol="features", handleInvalid="error").transform(
        df.select(*filled, fx.quoted(target))
    )
    return dict(zip(names, BaggedTrees(target, trees, depth, seed).importances(vectors)))


def select_importance(
    df: DataFrame, target: str, n_features: int = 20, trees: int = 100, columns: Sequence[str] | None = None, depth: int = 10
) -> DataFrame:
    """The most important features of a random forest."""
    names = [c for c in fx.present(df, columns or fx.numeric_columns(df)) if c != target]
    rows = training_cache(df.select(*[fx.quoted(c) for c in [*names, target]]))
    found = forest_importances(rows, target, names, trees, depth)
    rows.unpersist()
    scores = df.sparkSession.createDataFrame(list(found.items()), "feature string, importance double")
    return top_features(scores, "importance", n_features)


def select_rfe(
    df: DataFrame,
    target: str,
    n_features: int = 20,
    step: int = 5,
    trees: int = 50,
    depth: int = 8,
    columns: Sequence[str] | None = None,
) -> list[str]:
    """Refit and drop the ``step`` least important features until ``n_features`` are left.

    Each round is one distributed fit over rows that are cached and spread over all cores once.
    """
    left = [c for c in fx.present(df, columns or fx.numeric_columns(df)) if c != target]
    rows = training_cache(df.select(*[fx.quoted(c) for c in [*left, target]])) if len(left) > n_features else df
    while len(left) > n_features:
        scores = forest_importances(rows, target, left, trees, depth)
        worst = sorted(left, key=lambda c: scores[c])[: min(step, len(left) - n_features)]
        left = [c for c in left if c not in set(worst)]
    if rows is not df:
        rows.unpersist()
    return left


def drop_correlated(
    df: DataFrame, threshold: float = 0.95, columns: Sequence[str] | None = None
) -> tuple[DataFrame, list[str]]:
    """Drop each column whose correlation with any earlier one exceeds the threshold.

    Columns already dropped still count, and an undefined correlation never drops.
    """
    names = fx.present(df, columns or fx.numeric_columns(df))
    hits = correlation_matrix(df, names).filter(F.abs("r") > threshold).select("y").distinct()
    found = {r["y"] for r in hits.collect()}
    removed = [c for c in names if c in found]
    return df.drop(*removed), removed
