"""Scaling: fit parameters in one aggregate pass, apply them as literal expressions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import columns as fx

METHODS = ("zscore", "standard", "minmax")


@dataclass(frozen=True)
class Scaler:
    """(x - center) / scale for one column. A missing scale means a constant column."""

    column: str
    method: str
    center: float | None
    scale: float | None


def fit_scalers(df: DataFrame, columns: Sequence[str], method: str = "standard") -> list[Scaler]:
    """Mean and population deviation (zscore, standard) or minimum and range (minmax)."""
    if method not in METHODS:
        raise ValueError(f"unknown scaling method: {method}")
    names = fx.present(df, columns)
    if not names:
        return []
    measures = []
    for i, c in enumerate(names):
        x = fx.known(df, c).cast("double")
        if method == "minmax":
            measures += [F.min(x).alias(f"c{i}"), (F.max(x) - F.min(x)).alias(f"s{i}")]
        else:
            measures += [F.avg(x).alias(f"c{i}"), F.sqrt(fx.spread_pop(x)).alias(f"s{i}")]
    row = df.agg(*measures).first()
    return [Scaler(c, method, row[f"c{i}"], row[f"s{i}"] or None) for i, c in enumerate(names)]


def scaled(column: Column, scaler: Scaler, keep_constant: bool = False) -> Column:
    """The column under fitted parameters."""
    x = column.cast("double")
    if scaler.center is None:
        return F.lit(None).cast("double")
    if scaler.scale is None:  # constant column
        if keep_constant:
            return x
        if scaler.method == "zscore":
            return F.lit(None).cast("double")
        return F.when(x.isNotNull(), x - F.lit(scaler.center))
    return (x - F.lit(scaler.center)) / F.lit(scaler.scale)


def transform_scalers(
    df: DataFrame, scalers: Sequence[Scaler], columns: Sequence[str] | None = None, keep_constant: bool = False
) -> DataFrame:
    """Scale the fitted columns that are present (and listed, if ``columns`` is given)."""
    if not scalers:
        raise RuntimeError("no fitted scalers; call fit_scalers first")
    wanted = {s.column: s for s in scalers if s.column in df.columns and (columns is None or s.column in columns)}
    return df.withColumns({c: scaled(fx.quoted(c), s, keep_constant) for c, s in wanted.items()}) if wanted else df


def scale_zscore(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Population z-score; nulls are skipped; a constant column becomes null."""
    scalers = fit_scalers(df, columns, "zscore")
    return transform_scalers(df, scalers) if scalers else df


def scale_minmax(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """To [0, 1]; a constant column stays as it is."""
    scalers = fit_scalers(df, columns, "minmax")
    varying = [s for s in scalers if s.scale is not None]
    return transform_scalers(df, varying) if varying else df
