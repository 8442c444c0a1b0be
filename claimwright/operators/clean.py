"""Cleaning: dropping and filling columns, filtering rows, removing duplicates, encoding."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import columns as fx

# Share of missing values above which a column is dropped by default.
HIGH_MISSING_SHARE = 0.5

# The diagnosis columns of a claim line.
DIAGNOSIS_COLUMNS = [f"ICD_DIAG_{i:02d}" for i in range(1, 14)] + ["ICD_DIAG_01_PRIMARY"]


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, int]:
    """Missing values (null or NaN) of every column in one aggregate pass; the result is one row."""
    names = fx.present(df, df.columns if columns is None else columns)
    if not names:
        return {}
    row = df.agg(*[F.count_if(fx.known(df, c).isNull()).alias(f"n{i}") for i, c in enumerate(names)]).first()
    return {c: row[i] for i, c in enumerate(names)}


def drop_high_missing(
    df: DataFrame, threshold: int | None = None, keep_columns: Sequence[str] = (), share: float = HIGH_MISSING_SHARE
) -> tuple[DataFrame, list[str]]:
    """Drop columns with more than ``share`` of their values missing.

    An explicit ``threshold`` is an absolute count instead, whatever the number of rows.
    """
    names = [c for c in df.columns if c not in set(keep_columns)]
    counts = [F.count_if(fx.known(df, c).isNull()).alias(f"n{i}") for i, c in enumerate(names)]
    row = df.agg(F.count(F.lit(1)).alias("rows"), *counts).first()
    limit = share * row["rows"] if threshold is None else threshold
    removed = [c for i, c in enumerate(names) if row[f"n{i}"] > limit]
    return df.drop(*removed), removed


def fill_missing(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    wanted = {c: v for c, v in values.items() if c in df.columns}
    return df.fillna(wanted) if wanted else df


def drop_missing_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null or NaN in any (listed) column.

    Written as one test per column, not ``dropna``: Catalyst then removes the tests of columns
    that cannot be null and pushes the others to the scan.
    """
    def complete(name: str) -> Column:
        column = fx.quoted(name)
        test = column.isNotNull()
        return test & ~F.isnan(column) if fx.is_floating(df.schema[name].dataType) else test

    names = df.columns if subset is None else fx.present(df, subset)
    return df.filter(reduce(Column.__and__, [complete(c) for c in names])) if names else df


def filter_non_negative(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep rows where every listed column is >= 0; nulls and NaN fail the test."""

    def accept(name: str) -> Column:
        column = fx.quoted(name)
        test = column >= 0
        return test & ~F.isnan(column) if fx.is_floating(df.schema[name].dataType) else test

    names = fx.present(df, columns)
    return df.filter(reduce(Column.__and__, [accept(c) for c in names])) if names else df


def split_features_target(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """(features, target) as two projections of one plan; models use the single DataFrame."""
    require_columns(df, [target])
    return df.drop(target), df.select(target)


def require_columns(df: DataFrame, required: Sequence[str], name: str = "DataFrame") -> DataFrame:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{name} is missing required columns: {missing}")
    return df


def dedup_keep(
    df: DataFrame,
    subset: Sequence[str] | None = None,
    keep: str | bool = "first",
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Remove duplicates over ``subset``, keeping the first, the last or none of each group.

    First and last follow ``order_by``, ties by all columns. This is a min/max over a struct
    rather than a window, so that copies are combined before the shuffle and one hot group
    never has to be sorted in one task.
    """
    keys = list(df.columns if subset is None else subset)
    require_columns(df, keys)
    if keep not in ("first", "last", False):
        raise ValueError(f"keep must be 'first', 'last' or False, not {keep!r}")
    groups = [fx.quoted(c) for c in keys]
    if set(keys) == set(df.columns):
        if keep is False:
            return df.groupBy(*groups).agg(F.count(F.lit(1)).alias("__n")).filter("__n = 1").select(*map(fx.quoted, df.columns))
        return df.dropDuplicates()
    order = [fx.quoted(c).alias(f"o{i}") for i, c in enumerate(order_by or [])]
    values = [fx.quoted(c).alias(f"v{i}") for i, c in enumerate(df.columns)]
    row = F.struct(*order, *values)
    pick = F.max(row) if keep == "last" else F.min(row)
    best = df.groupBy(*groups).agg(pick.alias("__row"), F.count(F.lit(1)).alias("__n"))
    if keep is False:
        best = best.filter("__n = 1")
    return best.select(*[F.col(f"__row.v{i}").alias(c) for i, c in enumerate(df.columns)])


# --- encoders -----------------------------------------------------------------------------


def _replace(df: DataFrame, column: str, new_column: str, value: Column, drop_original: bool = True) -> DataFrame:
    out = df.withColumn(new_column, value)
    return out.drop(column) if drop_original and column != new_column else out


def encode_gender(df: DataFrame, column: str = "SEX", new_column: str = "Gender_Code") -> DataFrame:
    return _replace(df, column, new_column, fx.gender_code(fx.quoted(column))) if column in df.columns else df


def encode_age(df: DataFrame, column: str = "AGE", new_column: str = "Age", strict: bool = True) -> DataFrame:
    """'90+' becomes 90, everything else an integer. ``strict=False`` gives null for other text."""
    if column not in df.columns:
        return df
    kept = [fx.quoted(c) for c in df.columns if c != column]
    return df.select(*kept, fx.age_number(fx.quoted(column), strict).alias(new_column))


def code_category(df: DataFrame, column: str, new_column: str, drop_original: bool = True) -> DataFrame:
    if column not in df.columns:
        return df
    return _replace(df, column, new_column, fx.first_letter(fx.quoted(column)), drop_original)


def count_non_null(
    df: DataFrame, columns: Sequence[str] = tuple(DIAGNOSIS_COLUMNS), new_column: str = "Num_diag"
) -> DataFrame:
    names = fx.present(df, columns)
    if not names:
        return df
    total = reduce(Column.__add__, [fx.quoted(c).isNotNull().cast("int") for c in names])
    return df.withColumn(new_column, total)


def merge_categories(df: DataFrame, column: str, mapping: Mapping[str, str] | None = None) -> DataFrame:
    if column not in df.columns:
        return df
    return df.withColumn(column, fx.merged_category(fx.quoted(column), mapping))
