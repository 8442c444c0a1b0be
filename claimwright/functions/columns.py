"""Column expressions. Everything here stays inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Merged diagnosis groups, applied in this order.
ICD_MERGES = {"W": "V", "X": "V", "Y": "V", "B": "A", "n": "N"}

# Range of the seeded row key: [0, KEY_MODULUS).
KEY_MODULUS = 2147483647


def present(df: DataFrame, columns: Iterable[str]) -> list[str]:
    """The requested columns that exist: absent names are a no-op, decided at plan time."""
    return [c for c in columns if c in df.columns]


def quoted(name: str) -> Column:
    """A column by its literal name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_floating(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.DoubleType, T.FloatType))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def known(df: DataFrame, name: str) -> Column:
    """A column with NaN as null, so that aggregates treat both as missing."""
    kind = df.schema[name].dataType
    return F.nanvl(quoted(name), F.lit(None).cast(kind)) if is_floating(kind) else quoted(name)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Make null the only missing value. Done once, on ingest."""
    floats = {f.name: f.dataType for f in df.schema.fields if is_floating(f.dataType)}
    if not floats:
        return df
    return df.withColumns(
        {name: F.nanvl(quoted(name), F.lit(None).cast(kind)) for name, kind in floats.items()}
    )


def varies(column: Column) -> Column:
    """Whether an aggregated column has two different values.

    Merging partial moments can leave a constant column with a deviation of about 1e-16, so
    constancy is decided by min and max.
    """
    return F.max(column) > F.min(column)


def spread_pop(column: Column) -> Column:
    """Population variance, exactly 0 for a constant column."""
    return F.when(varies(column), F.var_pop(column)).when(F.count(column) > 0, 0.0)


def safe_divide(numerator: Column, denominator: Column, default: float = 0.0) -> Column:
    return F.when(denominator == 0, F.lit(default)).otherwise(F.try_divide(numerator, denominator))


def gender_code(column: Column) -> Column:
    return F.when(column.eqNullSafe("M"), 1).otherwise(0)


def age_number(column: Column, strict: bool = True) -> Column:
    text = column.cast("string")
    number = text.cast("int") if strict else text.try_cast("int")
    return F.when(text == "90+", 90).otherwise(number)


def first_letter(column: Column) -> Column:
    return F.coalesce(F.substring(column.cast("string"), 1, 1), F.lit("U"))


def closed_map(mapping: Mapping[str, str]) -> dict[str, str]:
    """Fold an ordered list of replacements into one lookup (a->b then b->c gives a->c)."""
    folded: dict[str, str] = {}
    for old, new in mapping.items():
        folded = {k: (new if v == old else v) for k, v in folded.items()}
        folded.setdefault(old, new)
    return folded


def merged_category(column: Column, mapping: Mapping[str, str] | None = None) -> Column:
    """Replaced by the map, then 'num' for all digits. One constant map keeps the expression small."""
    steps = closed_map(ICD_MERGES if mapping is None else mapping)
    merged = column
    if steps:
        lookup = F.create_map(*[F.lit(part) for pair in steps.items() for part in pair])
        merged = F.coalesce(F.try_element_at(lookup, column), column)
    return F.when(merged.rlike("^[0-9]+$"), "num").otherwise(merged)


def log1p_clipped(column: Column) -> Column:
    """log(1 + max(x, 0)); null stays null although ``greatest`` skips nulls."""
    return F.when(column.isNotNull(), F.log1p(F.greatest(column.cast("double"), F.lit(0.0))))


def row_key(df: DataFrame, columns: Sequence[str], seed: int = 42) -> Column:
    """Seeded integer mix of the given columns in [0, KEY_MODULUS).

    Plain bigint arithmetic, so that any SQL engine can repeat it; it depends on the row's
    content only, so a recomputed task returns the same keys. Non-integer columns enter
    through xxhash64.
    """
    key = F.lit(seed % KEY_MODULUS).cast("bigint")
    for name in columns:
        kind = df.schema[name].dataType
        value = quoted(name).cast("bigint") if isinstance(kind, T.IntegralType) else F.xxhash64(quoted(name))
        part = F.coalesce(F.pmod(value, F.lit(KEY_MODULUS).cast("bigint")), F.lit(KEY_MODULUS - 1).cast("bigint"))
        step = ((key + part + 12345) * 1103515245) % KEY_MODULUS
        step = step.bitwiseXOR(F.shiftright(step, 15))
        key = (step * 16807) % KEY_MODULUS
    return key
