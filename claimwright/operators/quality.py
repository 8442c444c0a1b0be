"""Data-quality checks.

A check is a set of aggregates plus expressions over their results. ``run_checks`` evaluates all
of them in one pass and returns one row per check; only checks that need a grouping of their own
(duplicates, distinct values) add a pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import columns as fx
from .clean import require_columns

# Severities; the check names and message texts below are fixed values too.
INFO, WARNING, ERROR, CRITICAL = "info", "warning", "error", "critical"

DETAILS = "map<string,string>"
LISTED_INVALID = 10


@dataclass
class Check:
    """``measures`` are aggregates; the other fields may refer to them through ``F.col``."""

    name: str
    severity: str
    passed: Column
    message: Column
    details: Mapping[str, Column]
    measures: Mapping[str, Column] = field(default_factory=dict)
    source: DataFrame | None = None  # a one-row DataFrame that replaces ``measures``


def _grouped(number: Column) -> Column:
    return F.format_number(number, 0)


def _percent(share: Column, digits: int) -> Column:
    return F.format_string(f"%.{digits}f%%", share * 100)


def _row(check: Check, at: str) -> Column:
    pairs = [part for k, v in check.details.items() for part in (F.lit(k), v.cast("string"))]
    details = F.create_map(*pairs) if pairs else F.lit(None)
    return F.struct(
        F.lit(at).cast("int").alias("check_no"),
        F.lit(check.name).alias("check_name"),
        check.passed.alias("passed"),
        F.lit(check.severity).alias("severity"),
        check.message.alias("message"),
        details.cast(DETAILS).alias("details"),
    )


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per check, in order: (check_no, check_name, passed, severity, message, details)."""
    fused = [(i, c) for i, c in enumerate(checks) if c.source is None]
    parts = []
    if fused:
        measures = {k: v for _, c in fused for k, v in c.measures.items()}
        one = df.agg(*[v.alias(k) for k, v in measures.items()])
        parts.append(one.select(F.inline(F.array(*[_row(c, i) for i, c in fused]))))
    for i, c in enumerate(checks):
        if c.source is not None:
            parts.append(c.source.select(F.inline(F.array(_row(c, i)))))
    return reduce(DataFrame.unionByName, parts)


def check_not_empty(df: DataFrame, name: str = "DataFrame") -> Check:
    rows = F.col("rows")
    return Check(
        "Not Empty Check", CRITICAL, rows > 0,
        F.concat(F.lit(f"{name} has "), _grouped(rows), F.lit(" rows")),
        {"rows": rows, "columns": F.lit(len(df.columns))},
        {"rows": F.count(F.lit(1))},
    )


def check_required_columns(df: DataFrame, required: Sequence[str]) -> Check:
    missing = sorted(set(required) - set(df.columns))
    message = f"Missing columns: {missing}" if missing else "All required columns present"
    return Check(
        "Required Columns Check", ERROR, F.lit(not missing), F.lit(message),
        {"missing_columns": F.lit(",".join(missing)), "total_required": F.lit(len(required)), "rows": F.col("rows")},
        {"rows": F.count(F.lit(1))},
    )


def check_no_duplicates(df: DataFrame, subset: Sequence[str] | None = None, threshold: float = 0.01) -> Check:
    """Copies are combined before the shuffle; nulls count as equal."""
    if subset is not None:
        require_columns(df, subset)
    keys = [fx.quoted(c) for c in (subset or df.columns)]
    if keys:
        counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).select("__n")
        one = counted.agg(
            F.coalesce(F.sum("__n"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("copies")
        )
    else:
        one = df.agg(F.count(F.lit(1)).alias("rows"), F.lit(0).cast("bigint").alias("copies"))
    ratio = F.coalesce(F.try_divide(F.col("copies"), F.col("rows")), F.lit(0.0))
    return Check(
        "Duplicate Check", WARNING, ratio <= threshold,
        F.concat(_grouped(F.col("copies")), F.lit(" duplicates ("), _percent(ratio, 2), F.lit(")")),
        {"n_duplicates": F.col("copies"), "ratio": ratio},
        source=one,
    )


def check_missing_values(df: DataFrame, max_missing_ratio: float = 0.5, columns: Sequence[str] | None = None) -> Check:
    names = fx.present(df, columns or df.columns)
    measures = {"missing_rows": F.count(F.lit(1))}
    measures |= {f"missing_{c}": F.count_if(fx.known(df, c).isNull()) for c in names}
    def share(c: str) -> Column:
        return F.try_divide(fx.quoted(f"missing_{c}"), F.col("missing_rows"))
    def exceeding(texts: Mapping[str, Column]) -> Column:
        return F.array_compact(F.array(*[F.when(share(c) > max_missing_ratio, t) for c, t in texts.items()], F.lit(None).cast("string")))
    issues = exceeding({c: F.lit(c) for c in names})
    ratios = exceeding({c: F.concat(F.lit(f"{c}:"), _percent(share(c), 2)) for c in names})
    return Check(
        "Missing Values Check", WARNING, F.size(issues) == 0,
        F.concat(F.size(issues).cast("string"), F.lit(f" columns exceed {max_missing_ratio:.0%} missing threshold")),
        {"columns_exceeding": F.array_join(issues, ","), "ratios": F.array_join(ratios, ",")},
        measures,
    )


def check_data_types(df: DataFrame, expected: Mapping[str, type[T.DataType]]) -> Check:
    """Each present column's type is an instance of the expected Spark type class."""
    wrong = [c for c, kind in expected.items() if c in df.columns and not isinstance(df.schema[c].dataType, kind)]
    return Check(
        "Data Types Check", ERROR, F.lit(not wrong), F.lit(f"{len(wrong)} columns have unexpected types"),
        {
            "type_issues": F.lit(",".join(f"{c}:{df.schema[c].dataType.simpleString()}" for c in wrong)),
            "expected": F.lit(",".join(f"{c}:{expected[c].__name__}" for c in wrong)),
            "rows": F.col("rows"),
        },
        {"rows": F.count(F.lit(1))},
    )


def check_value_ranges(df: DataFrame, ranges: Mapping[str, tuple[float | None, float | None]]) -> Check:
    measures, issues, values = {"rows": F.count(F.lit(1))}, [], []

    def shown(label: str, measure: str, bound: float) -> Column:
        value = F.format_string("%.2f", fx.quoted(measure).cast("double"))
        return F.concat(F.lit(f"{label}:"), value, F.lit(f" beyond {bound:.2f}"))

    for c, (low, high) in ranges.items():
        if c not in df.columns:
            continue
        if low is not None:
            measures[f"min_{c}"] = F.min(fx.known(df, c))
            below = fx.quoted(f"min_{c}") < low
            issues.append(F.when(below, F.lit(f"{c}:min")))
            values.append(F.when(below, shown(f"{c}:min", f"min_{c}", low)))
        if high is not None:
            measures[f"max_{c}"] = F.max(fx.known(df, c))
            above = fx.quoted(f"max_{c}") > high
            issues.append(F.when(above, F.lit(f"{c}:max")))
            values.append(F.when(above, shown(f"{c}:max", f"max_{c}", high)))
    found = F.array_compact(F.array(*issues, F.lit(None).cast("string")))
    return Check(
        "Value Range Check", WARNING, F.size(found) == 0,
        F.concat(F.size(found).cast("string"), F.lit(" range violations found")),
        {
            "violations": F.array_join(found, ","),
            "values": F.array_join(F.array_compact(F.array(*values, F.lit(None).cast("string"))), ","),
        },
        measures,
    )


def check_no_negative_values(df: DataFrame, columns: Sequence[str]) -> Check:
    names = fx.present(df, columns)
    measures = {"rows": F.count(F.lit(1))} | {f"negative_{c}": F.count_if(fx.quoted(c) < 0) for c in names}
    found = F.array_compact(
        F.array(
            *[
                F.when(
                    fx.quoted(f"negative_{c}") > 0,
                    F.concat(F.lit(f"{c}:"), fx.quoted(f"negative_{c}").cast("string")),
                )
                for c in names
            ],
            F.lit(None).cast("string"),
        )
    )
    return Check(
        "Non-Negative Values Check", ERROR, F.size(found) == 0,
        F.concat(F.size(found).cast("string"), F.lit(" columns have negative values")),
        {"columns_with_negatives": F.array_join(found, ",")},
        measures,
    )


def anti_invalid_values(df: DataFrame, column: str, valid: DataFrame | Sequence[Any]) -> DataFrame:
    """Distinct non-null values that are not in the valid set."""
    seen = df.select(fx.quoted(column).alias("value")).filter("value IS NOT NULL").distinct()
    if isinstance(valid, DataFrame):
        return seen.join(valid.select(valid[valid.columns[0]].alias("value")), "value", "left_anti")
    return seen.filter(~F.col("value").isin(list(valid))) if valid else seen


def check_categorical_values(df: DataFrame, column: str, valid: DataFrame | Sequence[Any]) -> Check:
    name = f"Categorical Check: {column}"
    if column not in df.columns:
        return Check(name, ERROR, F.lit(False), F.lit(f"Column {column} not found"), {}, {"rows": F.count(F.lit(1))})
    invalid = anti_invalid_values(df, column, valid)
    # the ten smallest are ranked inside each partition first, and only they are listed
    listed = invalid.orderBy("value").limit(LISTED_INVALID).agg(F.array_sort(F.collect_list("value")).alias("listed"))
    one = invalid.agg(F.count(F.lit(1)).alias("n_invalid")).withColumn(
        "listed", F.array_join(listed.scalar().cast("array<string>"), ",")
    )
    n = F.col("n_invalid")
    return Check(
        name, WARNING, n == 0,
        F.when(n == 0, F.lit("All values valid")).otherwise(F.concat(n.cast("string"), F.lit(" invalid values found"))),
        {"invalid_values": F.col("listed")},
        source=one,
    )


def check_unique_values(df: DataFrame, column: str, should_be_unique: bool = True) -> Check:
    require_columns(df, [column])
    counted = df.groupBy(fx.quoted(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    one = counted.agg(
        F.count_if(F.col("value").isNotNull()).alias("n_unique"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_total")
    )
    u, n = F.col("n_unique"), F.col("n_total")
    unique = u == n
    if should_be_unique:
        message = F.concat(
            F.when(unique, "Column is unique: ").otherwise("Column is not unique: "), _grouped(u), F.lit("/"), _grouped(n)
        )
    else:
        message = F.concat(F.lit("Column has "), _grouped(u), F.lit(" unique values out of "), _grouped(n))
    return Check(
        f"Uniqueness Check: {column}", INFO, unique if should_be_unique else ~unique, message,
        {"n_unique": u, "n_total": n}, source=one,
    )


def validation_report(results: DataFrame) -> DataFrame:
    """total, passed and failed checks; valid unless an error or critical check failed."""
    blocking = F.col("severity").isin(ERROR, CRITICAL)
    one = results.agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if(F.col("passed")).alias("passed_checks"),
        F.count_if(~F.col("passed")).alias("failed_checks"),
        F.coalesce(F.bool_and(F.col("passed") | ~blocking), F.lit(True)).alias("is_valid"),
    )
    summary = F.concat(
        F.lit("Validation Report: "), F.col("passed_checks").cast("string"), F.lit("/"), F.col("total_checks").cast("string"),
        F.lit(" checks passed. Valid: "), F.when(F.col("is_valid"), "True").otherwise("False"),
    )
    return one.withColumn("summary", summary)


def validate_claims(df: DataFrame) -> DataFrame:
    """The standard claim checks: one aggregate pass for all but the duplicate count."""
    amounts = ["AMT_BILLED", "AMT_PAID", "AMT_DEDUCT", "AMT_COINS"]
    return run_checks(
        df,
        [
            check_not_empty(df, "Claims Data"),
            check_required_columns(df, ["AMT_BILLED", "AMT_PAID"]),
            check_no_negative_values(df, amounts),
            check_missing_values(df, 0.5),
            check_no_duplicates(df),
        ],
    )
