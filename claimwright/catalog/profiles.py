"""Aggregations, profiles, deduplication and data-quality checks."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F, types as T

from ..operators import clean, profile, quality
from ..plans.claims_view import AMOUNTS, claims_view
from .registry import Catalog, over_claims

catalog = Catalog()
add = catalog.add

NUMBERS = ["AMT_BILLED", "AMT_PAID", "AMT_DEDUCT", "AMT_COINS", "CLIENT_LOS"]


def union(parts):
    return " UNION ALL ".join(parts)


def rounded(df, columns, digits=4):
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- profiles -----------------------------------------------------------------------------

NULLABLE = ["SEX", "ICD_DIAG_01_PRIMARY", "ICD_DIAG_02", "CLIENT_LOS", "AMT_PAID"]


@add(
    "missing_profile",
    over_claims(
        ", counts AS ("
        + union(f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing_count, count(*) AS n FROM claims" for c in NULLABLE)
        + ') SELECT "column", missing_count, round(missing_count * 100.0::DOUBLE / n, 2) AS missing_pct FROM counts WHERE missing_count > 0',
        NULLABLE,
    ),
)
def missing_profile(spark, sf_dir):
    return profile.missing_profile(claims_view(spark, sf_dir, NULLABLE))


@add(
    "describe_numeric",
    over_claims(
        union(
            f"SELECT '{c}' AS \"column\", count(x) AS count, round(avg(x), 4) AS mean, round(stddev_samp(x), 4) AS std, "
            "round(min(x), 6) AS min, round(quantile_cont(x, 0.25), 6) AS p25, round(quantile_cont(x, 0.5), 6) AS p50, "
            f"round(quantile_cont(x, 0.75), 6) AS p75, round(max(x), 6) AS max FROM (SELECT CAST({c} AS DOUBLE) AS x FROM claims)"
            for c in NUMBERS
        ),
        NUMBERS,
    ),
)
def describe_numeric(spark, sf_dir):
    # amounts have four decimals, their interpolated quartiles six: fewer would round ties
    return rounded(profile.describe_numeric(claims_view(spark, sf_dir, NUMBERS), digits=6), ["mean", "std"])


@add(
    "target_stats",
    over_claims(
        "SELECT round(avg(AMT_PAID), 4) AS mean, round(quantile_cont(AMT_PAID, 0.5), 4) AS median, "
        "round(stddev_samp(AMT_PAID), 4) AS std, round(skewness(AMT_PAID), 6) AS skew FROM claims",
        ["AMT_PAID"],
    ),
)
def target_stats(spark, sf_dir):
    stats = profile.target_stats(claims_view(spark, sf_dir, ["AMT_PAID"]), "AMT_PAID")
    return rounded(rounded(stats, ["mean", "median", "std"]), ["skew"], 6)


def histogram_sql(value, bins=50, extra="", columns=None):
    """Counts by comparison with the edges; bin i is [edge i, edge i + 1), the last one closed."""
    return over_claims(
        f", v AS (SELECT {value} AS x FROM claims WHERE {value} IS NOT NULL), r AS (SELECT min(x) AS low, max(x) AS high, "
        f"(max(x) - min(x)) / {bins} AS step FROM v), "
        f"e AS (SELECT CAST(i AS INTEGER) AS bin, i * step + low AS lower, CASE WHEN i + 1 = {bins} THEN high ELSE (i + 1) * step + low END AS upper "
        f"FROM r, range({bins}) t(i)), "
        f"c AS (SELECT bin, count(*) AS n FROM v JOIN e ON x >= lower AND (x < upper OR (bin = {bins - 1} AND x <= upper)) GROUP BY bin) "
        f"SELECT e.bin AS bin, round(lower, 6) AS lower, round(upper, 6) AS upper, coalesce(n, 0) AS n{extra} FROM e LEFT JOIN c ON e.bin = c.bin",
        columns,
    )


@add("histogram", histogram_sql("AMT_PAID", columns=["AMT_PAID"]))
def histogram(spark, sf_dir):
    return rounded(profile.histogram(claims_view(spark, sf_dir, ["AMT_PAID"]), "AMT_PAID"), ["lower", "upper"], 6)


@add(
    "boxplot_stats",
    over_claims(
        ", q AS (SELECT quantile_cont(AMT_PAID, 0.25) AS q1, quantile_cont(AMT_PAID, 0.5) AS q2, quantile_cont(AMT_PAID, 0.75) AS q3 FROM claims), "
        "f AS (SELECT *, q1 - 1.5::DOUBLE * (q3 - q1) AS low, q3 + 1.5::DOUBLE * (q3 - q1) AS high FROM q) "
        "SELECT round(any_value(q1), 6) AS q1, round(any_value(q2), 6) AS median, round(any_value(q3), 6) AS q3, "
        "round(min(AMT_PAID) FILTER (AMT_PAID BETWEEN low AND high), 6) AS whisker_low, "
        "round(max(AMT_PAID) FILTER (AMT_PAID BETWEEN low AND high), 6) AS whisker_high, "
        "count(*) FILTER (AMT_PAID < low) AS n_low, count(*) FILTER (AMT_PAID > high) AS n_high FROM claims, f",
        ["AMT_PAID"],
    ),
)
def boxplot_stats(spark, sf_dir):
    stats = profile.boxplot_stats(claims_view(spark, sf_dir, ["AMT_PAID"]), "AMT_PAID")
    return rounded(stats, ["q1", "median", "q3", "whisker_low", "whisker_high"], 6)


CODES = ["SEX", "AGE", "SV_STAT", "PRODUCT_TYPE", "ICD_DIAG_01_PRIMARY", "PROC_CODE"]


@add(
    "value_counts_topk",
    over_claims(
        ", long AS ("
        + union(f"SELECT '{c}' AS \"column\", {c} AS value FROM claims WHERE {c} IS NOT NULL" for c in CODES)
        + '), counts AS (SELECT "column", value, count(*) AS n FROM long GROUP BY ALL), '
        'ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS INTEGER) AS rank FROM counts) '
        "SELECT * FROM ranked WHERE rank <= 10",
        CODES,
    ),
)
def value_counts_topk(spark, sf_dir):
    return profile.value_counts_topk(claims_view(spark, sf_dir, CODES))


DISTINCT = ["CLAIM_ID_KEY", "PROC_CODE", "SEX", "CLIENT_LOS", "SV_STAT"]


@add(
    "distinct_count",
    over_claims(union(f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM claims" for c in DISTINCT), DISTINCT),
)
def distinct_count(spark, sf_dir):
    return profile.distinct_count(claims_view(spark, sf_dir, DISTINCT), DISTINCT)


def correlation_sql(a, b):
    return (
        f"covar_pop({a}, {b}) / nullif(stddev_pop({a}) FILTER ({b} IS NOT NULL) * stddev_pop({b}) FILTER ({a} IS NOT NULL), 0)"
    )


@add(
    "correlation_matrix",
    over_claims(
        union(f"SELECT '{a}' AS x, '{b}' AS y, round({correlation_sql(a, b)}, 8) AS r FROM claims" for a, b in combinations(NUMBERS, 2)),
        NUMBERS,
    ),
)
def correlation_matrix(spark, sf_dir):
    return rounded(profile.correlation_matrix(claims_view(spark, sf_dir, NUMBERS)), ["r"], 8)


@add(
    "target_correlation",
    over_claims(
        ", c AS ("
        + union(
            f"SELECT '{c}' AS feature, round(abs({correlation_sql(c, 'AMT_PAID')}), 8) AS abs_r FROM claims"
            for c in NUMBERS if c != "AMT_PAID"
        )
        + ") SELECT * FROM c ORDER BY abs_r DESC, feature LIMIT 3",
        NUMBERS,
    ),
)
def target_correlation(spark, sf_dir):
    return rounded(profile.target_correlation(claims_view(spark, sf_dir, NUMBERS), "AMT_PAID", k=3), ["abs_r"], 8)


@add(
    "linear_trend",
    over_claims(
        ", f AS (SELECT regr_slope(AMT_PAID, AMT_BILLED) AS slope, regr_intercept(AMT_PAID, AMT_BILLED) AS intercept, "
        "min(AMT_BILLED) AS low, max(AMT_BILLED) AS high FROM claims) "
        "SELECT CAST(i AS INTEGER) AS point, round(low + i * ((high - low) / 99), 4) AS x, "
        "round(slope * (low + i * ((high - low) / 99)) + intercept, 4) AS y, round(slope, 8) AS slope, round(intercept, 4) AS intercept "
        "FROM f, range(100) t(i)",
        ["AMT_PAID", "AMT_BILLED"],
    ),
)
def linear_trend(spark, sf_dir):
    trend = profile.linear_trend(claims_view(spark, sf_dir, ["AMT_PAID", "AMT_BILLED"]), "AMT_BILLED", "AMT_PAID")
    return rounded(rounded(trend, ["x", "y", "intercept"]), ["slope"], 8)


PROFILED = ["CLAIM_ID_KEY", *NUMBERS, "ICD_DIAG_02", "SV_STAT"]


@add(
    "table_profile",
    over_claims(
        f"SELECT count(*) AS rows, {len(PROFILED)} AS columns, "
        + " + ".join(f"CAST(count({c}) < count(*) AS INTEGER)" for c in PROFILED)
        + " AS columns_with_nulls, round(avg(AMT_PAID), 4) AS mean FROM claims",
        PROFILED,
    ),
)
def table_profile(spark, sf_dir):
    return rounded(profile.table_profile(claims_view(spark, sf_dir, PROFILED), "AMT_PAID"), ["mean"])


# --- deduplication ------------------------------------------------------------------------

DEDUP = ["CLAIM_ID_KEY", "SV_LINE", "AMT_PAID", "AMT_BILLED", "SV_STAT", "CLIENT_LOS"]


@add(
    "dedup_keep",
    over_claims(
        ", r AS (SELECT *, row_number() OVER (PARTITION BY CLAIM_ID_KEY, SV_LINE ORDER BY AMT_PAID, AMT_BILLED, SV_STAT, "
        "CLIENT_LOS NULLS FIRST) AS up, row_number() OVER (PARTITION BY CLAIM_ID_KEY, SV_LINE ORDER BY AMT_PAID DESC, AMT_BILLED DESC, "
        "SV_STAT DESC, CLIENT_LOS DESC NULLS LAST) AS down, count(*) OVER (PARTITION BY CLAIM_ID_KEY, SV_LINE) AS n FROM claims) "
        + union(
            f"SELECT '{kept}' AS keep, {', '.join(DEDUP)} FROM r WHERE {test}"
            for kept, test in (("first", "up = 1"), ("last", "down = 1"), ("none", "n = 1"))
        ),
        DEDUP,
    ),
)
def dedup_keep(spark, sf_dir):
    df = claims_view(spark, sf_dir, DEDUP)
    parts = [
        clean.dedup_keep(df, ["CLAIM_ID_KEY", "SV_LINE"], keep, ["AMT_PAID"]).select(F.lit(label).alias("keep"), *DEDUP)
        for label, keep in (("first", "first"), ("last", "last"), ("none", False))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# --- checks -------------------------------------------------------------------------------


def shown(df, *details):
    """Results with the named details as columns."""
    picked = [F.col("details")[d].alias(d) for d in details]
    return df.select("check_name", "passed", "severity", "message", *picked)


def one_check(spark, sf_dir, columns, build, *details):
    df = claims_view(spark, sf_dir, columns)
    return shown(quality.run_checks(df, [build(df)]), *details)


def check_sql(name, severity, passed, message, source="claims", columns=None, ctes="", **details):
    extra = "".join(f", {v} AS {k}" for k, v in details.items())
    return over_claims(
        f"{ctes} SELECT '{name}' AS check_name, {passed} AS passed, '{severity}' AS severity, {message} AS message{extra} FROM {source}", columns
    )


NOT_EMPTY = ("Not Empty Check", "critical", "count(*) > 0", "'Claims Data has ' || format('{:,}', count(*)) || ' rows'")


@add("check_not_empty", check_sql(*NOT_EMPTY, columns=["AMT_PAID"], rows="CAST(count(*) AS VARCHAR)", columns_="'1'").replace("columns_", "columns"))
def check_not_empty(spark, sf_dir):
    return one_check(spark, sf_dir, ["AMT_PAID"], lambda df: quality.check_not_empty(df, "Claims Data"), "rows", "columns")


@add(
    "check_required_columns",
    check_sql(
        "Required Columns Check", "error", "false", "'Missing columns: [''AMT_COPAY'']'", columns=["AMT_PAID"],
        missing_columns="'AMT_COPAY'", total_required="'2'", rows="CAST(count(*) AS VARCHAR)",
    ),
)
def check_required_columns(spark, sf_dir):
    return one_check(
        spark, sf_dir, ["AMT_PAID"], lambda df: quality.check_required_columns(df, ["AMT_PAID", "AMT_COPAY"]),
        "missing_columns", "total_required", "rows",
    )


KEYS = ["CLAIM_ID_KEY", "SV_LINE"]
COPIES = ", d AS (SELECT count(*) AS n, count(*) - (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM claims)) AS copies FROM claims)"
DUPLICATES = (
    "Duplicate Check", "warning", "copies / n <= 0.01",
    "format('{:,}', copies) || ' duplicates (' || printf('%.2f', copies / n * 100) || '%)'",
)


@add("check_no_duplicates", check_sql(*DUPLICATES, "d", KEYS, COPIES.format(keys="CLAIM_ID_KEY, SV_LINE"), n_duplicates="CAST(copies AS VARCHAR)"))
def check_no_duplicates(spark, sf_dir):
    return one_check(spark, sf_dir, KEYS, lambda df: quality.check_no_duplicates(df, KEYS), "n_duplicates")


def missing_share(c):
    return f"(count(*) - count({c})) / count(*)"


def missing_sql(columns, limit):
    exceeding = " || ".join(f"CASE WHEN {missing_share(c)} > {limit} THEN ',{c}' ELSE '' END" for c in columns)
    count = " + ".join(f"CAST({missing_share(c)} > {limit} AS INTEGER)" for c in columns)
    return exceeding, count


EXCEEDING, N_EXCEEDING = missing_sql(NULLABLE, 0.08)


@add(
    "check_missing_values",
    check_sql(
        "Missing Values Check", "warning", f"{N_EXCEEDING} = 0", f"CAST({N_EXCEEDING} AS VARCHAR) || ' columns exceed 8% missing threshold'",
        columns=NULLABLE, columns_exceeding=f"ltrim({EXCEEDING}, ',')",
        ratios="ltrim(" + " || ".join(f"CASE WHEN {missing_share(c)} > 0.08 THEN ',{c}:' || printf('%.2f', {missing_share(c)} * 100) || '%' ELSE '' END" for c in NULLABLE) + ", ',')",
    ),
)
def check_missing_values(spark, sf_dir):
    return one_check(spark, sf_dir, NULLABLE, lambda df: quality.check_missing_values(df, 0.08), "columns_exceeding", "ratios")


@add(
    "check_data_types",
    check_sql(
        "Data Types Check", "error", "false", "'1 columns have unexpected types'", columns=["AMT_PAID", "SV_STAT"],
        type_issues="'SV_STAT:string'", expected="'SV_STAT:NumericType'", rows="CAST(count(*) AS VARCHAR)",
    ),
)
def check_data_types(spark, sf_dir):
    expected = {"AMT_PAID": T.NumericType, "SV_STAT": T.NumericType}
    return one_check(spark, sf_dir, ["AMT_PAID", "SV_STAT"], lambda df: quality.check_data_types(df, expected), "type_issues", "expected", "rows")


@add(
    "check_value_ranges",
    check_sql(
        "Value Range Check", "warning", "(min(AMT_PAID) >= 0) AND (max(AMT_PAID) <= 50000) AND (min(CLIENT_LOS) >= 0)",
        "CAST(CAST(min(AMT_PAID) < 0 AS INTEGER) + CAST(max(AMT_PAID) > 50000 AS INTEGER) + CAST(min(CLIENT_LOS) < 0 AS INTEGER) AS VARCHAR) "
        "|| ' range violations found'",
        columns=["AMT_PAID", "CLIENT_LOS"],
        violations="ltrim(CASE WHEN min(AMT_PAID) < 0 THEN ',AMT_PAID:min' ELSE '' END || CASE WHEN max(AMT_PAID) > 50000 THEN ',AMT_PAID:max' ELSE '' END "
        "|| CASE WHEN min(CLIENT_LOS) < 0 THEN ',CLIENT_LOS:min' ELSE '' END, ',')",
        values="ltrim(CASE WHEN min(AMT_PAID) < 0 THEN ',AMT_PAID:min:' || printf('%.2f', min(AMT_PAID)) || ' beyond 0.00' ELSE '' END || "
        "CASE WHEN max(AMT_PAID) > 50000 THEN ',AMT_PAID:max:' || printf('%.2f', max(AMT_PAID)) || ' beyond 50000.00' ELSE '' END || "
        "CASE WHEN min(CLIENT_LOS) < 0 THEN ',CLIENT_LOS:min:' || printf('%.2f', min(CLIENT_LOS)) || ' beyond 0.00' ELSE '' END, ',')",
    ),
)
def check_value_ranges(spark, sf_dir):
    ranges = {"AMT_PAID": (0, 50000), "CLIENT_LOS": (0, None)}
    return one_check(spark, sf_dir, ["AMT_PAID", "CLIENT_LOS"], lambda df: quality.check_value_ranges(df, ranges), "violations", "values")


def negative_sql(columns):
    found = " || ".join(f"CASE WHEN count(*) FILTER ({c} < 0) > 0 THEN ',{c}:' || count(*) FILTER ({c} < 0) ELSE '' END" for c in columns)
    count = " + ".join(f"CAST(count(*) FILTER ({c} < 0) > 0 AS INTEGER)" for c in columns)
    return f"ltrim({found}, ',')", f"({count})"


NEGATIVES, N_NEGATIVE = negative_sql(AMOUNTS)
NON_NEGATIVE = (
    "Non-Negative Values Check", "error", f"{N_NEGATIVE} = 0", f"CAST({N_NEGATIVE} AS VARCHAR) || ' columns have negative values'",
)


@add("check_no_negative_values", check_sql(*NON_NEGATIVE, columns=AMOUNTS, columns_with_negatives=NEGATIVES))
def check_no_negative_values(spark, sf_dir):
    return one_check(spark, sf_dir, AMOUNTS, lambda df: quality.check_no_negative_values(df, AMOUNTS), "columns_with_negatives")


@add(
    "check_categorical_values",
    over_claims(
        ", invalid AS (SELECT DISTINCT PROC_CODE AS v FROM claims WHERE PROC_CODE IS NOT NULL AND PROC_CODE NOT IN "
        "(SELECT CAST(90000 + p_partkey AS VARCHAR) FROM part WHERE p_size > 3)), "
        "ten AS (SELECT string_agg(v, ',' ORDER BY v) AS listed FROM (SELECT v FROM invalid ORDER BY v LIMIT 10)) "
        "SELECT 'Categorical Check: PROC_CODE' AS check_name, count(*) = 0 AS passed, 'warning' AS severity, "
        "CASE WHEN count(*) = 0 THEN 'All values valid' ELSE count(*) || ' invalid values found' END AS message, "
        "(SELECT listed FROM ten) AS invalid_values FROM invalid",
        ["PROC_CODE"],
    ),
)
def check_categorical_values(spark, sf_dir):
    part = spark.read.parquet(f"{sf_dir}/part.parquet").filter("p_size > 3").selectExpr("CAST(90000 + p_partkey AS string) AS code")
    return one_check(spark, sf_dir, ["PROC_CODE"], lambda df: quality.check_categorical_values(df, "PROC_CODE", part), "invalid_values")


@add(
    "check_unique_values",
    check_sql(
        "Uniqueness Check: CLAIM_ID_KEY", "info", "count(DISTINCT CLAIM_ID_KEY) = count(*)",
        "'Column is ' || CASE WHEN count(DISTINCT CLAIM_ID_KEY) = count(*) THEN 'unique' ELSE 'not unique' END || ': ' || "
        "format('{:,}', count(DISTINCT CLAIM_ID_KEY)) || '/' || format('{:,}', count(*))",
        columns=["CLAIM_ID_KEY"], n_unique="CAST(count(DISTINCT CLAIM_ID_KEY) AS VARCHAR)", n_total="CAST(count(*) AS VARCHAR)",
    ),
)
def check_unique_values(spark, sf_dir):
    return one_check(spark, sf_dir, ["CLAIM_ID_KEY"], lambda df: quality.check_unique_values(df, "CLAIM_ID_KEY"), "n_unique", "n_total")


CHECKED = ["CLAIM_ID_KEY", "SV_LINE", *AMOUNTS, "ICD_DIAG_02", "CLIENT_LOS"]
_, N_MISSING = missing_sql(CHECKED, 0.5)


def claim_checks_sql():
    select = "SELECT '{}' AS check_name, {} AS passed, '{}' AS severity, {} AS message FROM {}"
    def row(check, source="claims"):
        name, severity, passed, message = check
        return select.format(name, passed, severity, message, source)
    return union(
        [
            row(NOT_EMPTY),
            select.format("Required Columns Check", "count(*) >= 0", "error", "'All required columns present'", "claims"),
            row(NON_NEGATIVE),
            row(("Missing Values Check", "warning", f"{N_MISSING} = 0", f"CAST({N_MISSING} AS VARCHAR) || ' columns exceed 50% missing threshold'")),
            row(DUPLICATES, "d"),
        ]
    )


ALL_COPIES = COPIES.format(keys="*")


@add("validate_claims", over_claims(f"{ALL_COPIES} {claim_checks_sql()}", CHECKED))
def validate_claims(spark, sf_dir):
    return shown(quality.validate_claims(claims_view(spark, sf_dir, CHECKED)))


@add(
    "validation_report",
    over_claims(
        f"{ALL_COPIES}, results AS ({claim_checks_sql()}), totals AS (SELECT count(*) AS total_checks, count(*) FILTER (passed) AS passed_checks, "
        "count(*) FILTER (NOT passed) AS failed_checks, bool_and(passed OR severity IN ('info', 'warning')) AS is_valid FROM results) "
        "SELECT *, 'Validation Report: ' || passed_checks || '/' || total_checks || ' checks passed. Valid: ' || "
        "CASE WHEN is_valid THEN 'True' ELSE 'False' END AS summary FROM totals",
        CHECKED,
    ),
)
def validation_report(spark, sf_dir):
    return quality.validation_report(quality.validate_claims(claims_view(spark, sf_dir, CHECKED)))
