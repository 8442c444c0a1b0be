"""Profiles of a table: counts, moments, percentiles, histograms, correlations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import columns as fx
from . import products
from .quantiles import exact_percentiles

# Aggregate expressions put into one pass; more pairs than this take another pass.
PAIRS_PER_PASS = 400


def _long(df: DataFrame, columns: Sequence[str], label: str = "column", value: str = "value") -> DataFrame:
    """(label, value) rows for the given columns, cast to one type by the caller."""
    pairs = [F.struct(F.lit(c).alias(label), fx.quoted(c).alias(value)) for c in columns]
    return df.select(F.inline(F.array(*pairs)))


def missing_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null count and percentage of each column that has nulls, most first."""
    names = fx.present(df, columns or df.columns)
    one = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(fx.known(df, c).isNull()).alias(f"c{i}") for i, c in enumerate(names)])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("missing_count")) for i, c in enumerate(names)])
    percent = F.round(F.col("missing_count") * 100.0 / F.col("n"), 2).alias("missing_pct")
    return (
        one.select("n", F.inline(rows))
        .filter("missing_count > 0")
        .select("column", "missing_count", percent)
        .orderBy(F.desc("missing_count"), "column")
    )


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None, digits: int = 2) -> DataFrame:
    """count, mean, std, min, quartiles and max per numeric column, rounded."""
    names = fx.present(df, columns or fx.numeric_columns(df))
    quartiles = exact_percentiles(df, {c: [0.25, 0.5, 0.75] for c in names})
    measures = []
    for i, c in enumerate(names):
        x = fx.known(df, c).cast("double")
        measures += [
            F.count(x).alias(f"count{i}"), F.avg(x).alias(f"mean{i}"), F.stddev_samp(x).alias(f"std{i}"),
            F.min(x).alias(f"min{i}"), F.max(x).alias(f"max{i}"),
        ]
    def rounded(value: Column) -> Column:
        return F.round(value.cast("double"), digits)
    rows = []
    for i, c in enumerate(names):
        q1, q2, q3 = (F.lit(q) for q in quartiles[c])
        rows.append(
            F.struct(
                F.lit(c).alias("column"), F.col(f"count{i}").alias("count"),
                rounded(F.col(f"mean{i}")).alias("mean"), rounded(F.col(f"std{i}")).alias("std"),
                rounded(F.col(f"min{i}")).alias("min"), rounded(q1).alias("p25"), rounded(q2).alias("p50"),
                rounded(q3).alias("p75"), rounded(F.col(f"max{i}")).alias("max"),
            )
        )
    return df.agg(*measures).select(F.inline(F.array(*rows)))


def adjusted_skew(column: Column) -> Column:
    """Bias-adjusted sample skewness (null below three rows and for a constant)."""
    n = F.count(column).cast("double")
    return F.when((n > 2) & fx.varies(column), F.try_divide(F.skewness(column) * F.sqrt(n * (n - 1)), n - 2))


def target_stats(df: DataFrame, target: str) -> DataFrame:
    x = fx.known(df, target).cast("double")
    median = exact_percentiles(df, {target: [0.5]})[target][0]
    return df.agg(
        F.avg(x).alias("mean"), F.lit(median).cast("double").alias("median"), F.stddev_samp(x).alias("std"), adjusted_skew(x).alias("skew")
    )


def _bounds(df: DataFrame, value: Column) -> tuple[float | None, float | None]:
    row = df.agg(F.min(value).alias("low"), F.max(value).alias("high")).first()
    return row["low"], row["high"]


def histogram(df: DataFrame, value: str | Column, bins: int = 50) -> DataFrame:
    """Equal-width bins from min to max, the last one closed, empty bins included.

    A value is placed by division and then corrected against the edges, so that rounding in the
    division cannot put it on the wrong side of an edge.
    """
    x = F.nanvl((fx.quoted(value) if isinstance(value, str) else value).cast("double"), F.lit(None).cast("double"))
    low, high = _bounds(df, x)
    spark = df.sparkSession
    if low is None:
        return spark.createDataFrame([], "bin int, lower double, upper double, n bigint")
    if low == high:
        low, high = low - 0.5, high + 0.5
    step = (high - low) / bins
    def edge(i: Column) -> Column:
        return F.when(i == bins, F.lit(high)).otherwise(i * step + low)
    guess = F.least(F.floor((x - low) / step).cast("int"), F.lit(bins - 1))
    placed = (
        df.select(x.alias("x"), guess.alias("guess"))
        .filter("x IS NOT NULL")
        .select(
            F.when(F.col("x") < edge(F.col("guess")), F.col("guess") - 1)
            .when((F.col("x") >= edge(F.col("guess") + 1)) & (F.col("guess") < bins - 1), F.col("guess") + 1)
            .otherwise(F.col("guess"))
            .alias("bin")
        )
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    i = F.col("bin")
    return (
        spark.range(bins).select(F.col("id").cast("int").alias("bin"))
        .join(placed, "bin", "left")
        .select("bin", edge(i).alias("lower"), edge(i + 1).alias("upper"), F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))
    )


def boxplot_stats(df: DataFrame, column: str) -> DataFrame:
    """Quartiles, whiskers at the extremes inside 1.5 IQR, and the outliers beyond them."""
    q1, q2, q3 = exact_percentiles(df, {column: [0.25, 0.5, 0.75]})[column]
    x = fx.known(df, column).cast("double")
    if q1 is None:
        low = high = None
    else:
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    inside = (x >= F.lit(low)) & (x <= F.lit(high))
    return df.agg(
        F.lit(q1).cast("double").alias("q1"),
        F.lit(q2).cast("double").alias("median"),
        F.lit(q3).cast("double").alias("q3"),
        F.least(F.min(F.when(inside, x)), F.lit(q1)).alias("whisker_low"),
        F.greatest(F.max(F.when(inside, x)), F.lit(q3)).alias("whisker_high"),
        F.count_if(x < F.lit(low)).alias("n_low"),
        F.count_if(x > F.lit(high)).alias("n_high"),
    )


def value_counts_topk(df: DataFrame, columns: Sequence[str] | None = None, k: int = 10) -> DataFrame:
    """The k most frequent non-null values per column, in one scan.

    The rank limit is applied by Catalyst inside each partition before the ranking shuffle, so
    at most k rows per column and partition travel.
    """
    names = fx.present(df, columns or fx.string_columns(df))
    typed = df.select(*[fx.quoted(c).cast("string").alias(c) for c in names])
    counts = _long(typed, names).filter("value IS NOT NULL").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    ranked = counts.withColumn("rank", F.row_number().over(Window.partitionBy("column").orderBy(F.desc("n"), "value")))
    return ranked.filter(F.col("rank") <= k).select("column", "value", "n", "rank")


def distinct_count(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct non-null values per column."""
    names = fx.present(df, columns)
    if approximate:
        one = df.agg(*[F.approx_count_distinct(fx.quoted(c)).alias(f"c{i}") for i, c in enumerate(names)])
        rows = [F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("n_distinct")) for i, c in enumerate(names)]
        return one.select(F.inline(F.array(*rows)))
    def text(c: str) -> Column:
        if fx.is_floating(df.schema[c].dataType):  # -0.0 and 0.0 are one value, NaN is missing
            return (fx.known(df, c) + F.lit(0.0)).cast("string")
        return fx.quoted(c).cast("string")
    typed = df.select(*[text(c).alias(c) for c in names])
    seen = _long(typed, names).filter("value IS NOT NULL").distinct()
    counted = seen.groupBy("column").agg(F.count(F.lit(1)).alias("n"))
    listed = df.sparkSession.createDataFrame([(c,) for c in names], "column string")
    return listed.join(counted, "column", "left").select("column", F.coalesce("n", F.lit(0).cast("bigint")).alias("n_distinct"))


def _correlations(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(x, y, r) for the given pairs, Pearson over rows where both are present.

    A first pass finds the means and which columns have nulls or are constant. Over columns
    without nulls the second pass then sums centred products, one per pair, which is stable and
    small in generated code; only pairs with nulls need moments of their own. r is null when
    either side is constant.
    """
    names = list(dict.fromkeys(c for pair in pairs for c in pair))
    if not names:
        return df.sparkSession.createDataFrame([], "x string, y string, r double")
    def number(c: str) -> Column:
        return fx.known(df, c).cast("double")
    seen = df.agg(
        *[F.count_if(number(c).isNull()).alias(f"n{i}") for i, c in enumerate(names)],
        *[fx.varies(number(c)).alias(f"v{i}") for i, c in enumerate(names)],
        *[F.avg(number(c)).alias(f"m{i}") for i, c in enumerate(names)],
    ).first()
    means = {c: seen[f"m{i}"] for i, c in enumerate(names)}
    complete = {c for i, c in enumerate(names) if seen[f"n{i}"] == 0}
    varying = {c for i, c in enumerate(names) if seen[f"v{i}"]}

    def correlation(x: str, y: str) -> Column:
        if x not in varying or y not in varying:
            return F.lit(None).cast("double")
        a, b = number(x), number(y)
        if x in complete and y in complete:
            a, b = a - F.lit(means[x]), b - F.lit(means[y])
            return F.try_divide(F.sum(a * b), F.sqrt(F.sum(a * a)) * F.sqrt(F.sum(b * b)))
        both_a = a if y in complete else F.when(b.isNotNull(), a)
        both_b = b if x in complete else F.when(a.isNotNull(), b)
        r = F.try_divide(F.covar_pop(a, b), F.stddev_pop(both_a) * F.stddev_pop(both_b))
        return F.when(fx.varies(both_a) & fx.varies(both_b), r)

    result = None
    for start in range(0, len(pairs), PAIRS_PER_PASS):
        part = pairs[start:start + PAIRS_PER_PASS]
        one = df.agg(*[correlation(a, b).alias(f"r{i}") for i, (a, b) in enumerate(part)])
        rows = [
            F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"r{i}").alias("r")) for i, (a, b) in enumerate(part)
        ]
        long = one.select(F.inline(F.array(*rows)))
        result = long if result is None else result.unionByName(long)
    return result


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The lower triangle as (x, y, r), with x before y in column order.

    Two passes for up to ``products.BLOCK`` columns: the means, then all products about them.
    """
    names = fx.present(df, columns or fx.numeric_columns(df))
    schema = "x string, y string, r double"
    if len(names) < 2:
        return df.sparkSession.createDataFrame([], schema)
    numbers = {c: fx.known(df, c).cast("double") for c in names}
    means = df.agg(*[F.avg(v) for v in numbers.values()]).first()
    centred = {c: v - F.lit(m or 0.0) for (c, v), m in zip(numbers.items(), means)}
    return df.sparkSession.createDataFrame(products.correlations(df, centred), schema)


def target_correlation(df: DataFrame, target: str, columns: Sequence[str] | None = None, k: int = 10) -> DataFrame:
    """Features by absolute correlation with the target, largest first."""
    names = [c for c in fx.present(df, columns or fx.numeric_columns(df)) if c != target]
    pairs = _correlations(df, [(c, target) for c in names])
    ranked = pairs.select(F.col("x").alias("feature"), F.abs("r").alias("abs_r"))
    return ranked.orderBy(F.desc_nulls_last("abs_r"), "feature").limit(k)


def linear_trend(df: DataFrame, x: str, y: str, points: int = 100) -> DataFrame:
    """Least-squares line of y on x, evaluated on an even grid from min(x) to max(x)."""
    a, b = fx.known(df, x).cast("double"), fx.known(df, y).cast("double")
    both = df.filter(a.isNotNull() & b.isNotNull())
    fit = both.agg(
        F.when(fx.varies(a), F.regr_slope(b, a)).alias("slope"), F.when(fx.varies(a), F.regr_intercept(b, a)).alias("intercept"), F.min(a).alias("low"), F.max(a).alias("high")
    )
    step = (F.col("high") - F.col("low")) / (points - 1)
    grid = fit.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    at = F.col("low") + F.col("point") * step
    return grid.select("point", at.alias("x"), (F.col("slope") * at + F.col("intercept")).alias("y"), "slope", "intercept")


def table_profile(df: DataFrame, mean_of: str | None = None) -> DataFrame:
    """rows, columns, columns with nulls, and optionally one mean: a single pass."""
    with_nulls = [F.max(fx.known(df, c).isNull().cast("int")).alias(f"c{i}") for i, c in enumerate(df.columns)]
    mean = F.avg(fx.known(df, mean_of)) if mean_of in df.columns else F.lit(None).cast("double")
    one = df.agg(F.count(F.lit(1)).alias("rows"), mean.alias("mean"), *with_nulls)
    total = sum((F.coalesce(F.col(f"c{i}"), F.lit(0)) for i in range(len(df.columns))), F.lit(0))
    return one.select("rows", F.lit(len(df.columns)).alias("columns"), total.alias("columns_with_nulls"), "mean")
