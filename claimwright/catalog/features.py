"""Encoders, feature construction, scaling, selection and the composite workflows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean, features, scale, select
from ..plans import claims as plans
from ..plans.claims_view import claims_view, table
from ..session import scratch_path
from .profiles import correlation_sql, rounded, union
from .registry import Catalog, over_claims

catalog = Catalog()
add = catalog.add

LINE = ["CLAIM_ID_KEY", "SV_LINE"]
ICD = "ICD_DIAG_01_PRIMARY"


# --- row transforms -----------------------------------------------------------------------


@add("encode_gender", over_claims("SELECT CLAIM_ID_KEY, SV_LINE, CASE WHEN SEX = 'M' THEN 1 ELSE 0 END AS Gender_Code FROM claims", [*LINE, "SEX"]))
def encode_gender(spark, sf_dir):
    return clean.encode_gender(claims_view(spark, sf_dir, [*LINE, "SEX"]))


AGE_SQL = "CASE WHEN AGE = '90+' THEN 90 ELSE CAST(AGE AS INTEGER) END"


@add("encode_age", over_claims(f"SELECT CLAIM_ID_KEY, SV_LINE, {AGE_SQL} AS Age FROM claims", [*LINE, "AGE"]))
def encode_age(spark, sf_dir):
    return clean.encode_age(claims_view(spark, sf_dir, [*LINE, "AGE"]))


LETTER_SQL = f"coalesce(substr({ICD}, 1, 1), 'U')"


@add("code_category", over_claims(f"SELECT CLAIM_ID_KEY, SV_LINE, {LETTER_SQL} AS ICD_Category FROM claims", [*LINE, ICD]))
def code_category(spark, sf_dir):
    return clean.code_category(claims_view(spark, sf_dir, [*LINE, ICD]), ICD, "ICD_Category")


NUM_DIAG_SQL = f"CAST({ICD} IS NOT NULL AS INTEGER) + CAST(ICD_DIAG_02 IS NOT NULL AS INTEGER)"


@add("count_non_null", over_claims(f"SELECT *, {NUM_DIAG_SQL} AS Num_diag FROM claims", [*LINE, ICD, "ICD_DIAG_02"]))
def count_non_null(spark, sf_dir):
    return clean.count_non_null(claims_view(spark, sf_dir, [*LINE, ICD, "ICD_DIAG_02"]))


def merged_sql(letter):
    return (
        f"CASE WHEN {letter} IN ('W', 'X', 'Y') THEN 'V' WHEN {letter} = 'B' THEN 'A' WHEN {letter} = 'n' THEN 'N' "
        f"WHEN regexp_full_match({letter}, '[0-9]+') THEN 'num' ELSE {letter} END"
    )


@add("merge_categories", over_claims(f"SELECT CLAIM_ID_KEY, SV_LINE, {merged_sql(LETTER_SQL)} AS ICD_Category FROM claims", [*LINE, ICD]))
def merge_categories(spark, sf_dir):
    return clean.merge_categories(code_category(spark, sf_dir), "ICD_Category")


VALUES = {
    "SV_STAT": ["A", "N", "R"],
    "PRODUCT_TYPE": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
    "SEX": ["F", "M"],
}


def dummies_sql(values):
    return ", ".join(f'coalesce(CAST({c} = \'{v}\' AS INTEGER), 0) AS "{c}_{v}"' for c, vs in values.items() for v in vs)


@add("one_hot", over_claims(f"SELECT CLAIM_ID_KEY, SV_LINE, {dummies_sql(VALUES)} FROM claims", [*LINE, *VALUES]))
def one_hot(spark, sf_dir):
    return features.one_hot(claims_view(spark, sf_dir, [*LINE, *VALUES]), list(VALUES))


PAIR = ["AMT_BILLED", "AMT_DEDUCT"]


@add(
    "interactions",
    over_claims(
        "SELECT *, AMT_BILLED * AMT_DEDUCT AS AMT_BILLED_x_AMT_DEDUCT, AMT_BILLED / (AMT_DEDUCT + 1e-8) AS AMT_BILLED_div_AMT_DEDUCT, "
        "AMT_BILLED + AMT_DEDUCT AS AMT_BILLED_plus_AMT_DEDUCT, AMT_BILLED - AMT_DEDUCT AS AMT_BILLED_minus_AMT_DEDUCT FROM claims",
        [*LINE, *PAIR],
    ),
)
def interactions(spark, sf_dir):
    return features.interactions(claims_view(spark, sf_dir, [*LINE, *PAIR]), [tuple(PAIR)], features.OPERATIONS)


@add(
    "polynomial",
    over_claims(
        "SELECT *, round(pow(AMT_BILLED, 2) / 1e9, 9) AS AMT_BILLED_pow2, round(pow(AMT_BILLED, 3) / 1e13, 9) AS AMT_BILLED_pow3 FROM claims",
        [*LINE, "AMT_BILLED"],
    ),
)
def polynomial(spark, sf_dir):
    df = features.polynomial(claims_view(spark, sf_dir, [*LINE, "AMT_BILLED"]), ["AMT_BILLED"], 3)
    return df.withColumns(
        {
            "AMT_BILLED_pow2": F.round(F.col("AMT_BILLED_pow2") / 1e9, 9),
            "AMT_BILLED_pow3": F.round(F.col("AMT_BILLED_pow3") / 1e13, 9),
        }
    )


def quantile_code_sql(column, bins):
    """Distinct percentile edges without the ends; the code counts those below the value."""
    shares = ", ".join(f"{i / bins!r}::DOUBLE" for i in range(bins + 1))
    return (
        f"SELECT list_sort(list_distinct(quantile_cont({column}, [{shares}]))) AS e FROM claims",
        f"CASE WHEN len(e) < 2 OR {column} IS NULL THEN NULL ELSE CAST(len(list_filter(e[2:-2], lambda s: s < {column})) AS INTEGER) END",
    )


EDGES, CODE = quantile_code_sql("AMT_BILLED", 5)


@add(
    "bin_quantile",
    over_claims(f", q AS ({EDGES}) SELECT claims.*, {CODE} AS AMT_BILLED_binned FROM claims, q", [*LINE, "AMT_BILLED"]),
)
def bin_quantile(spark, sf_dir):
    return features.bin_quantile(claims_view(spark, sf_dir, [*LINE, "AMT_BILLED"]), ["AMT_BILLED"], 5)


@add(
    "bin_uniform",
    over_claims(
        ", r AS (SELECT min(AMT_BILLED) AS low, (max(AMT_BILLED) - min(AMT_BILLED)) / 4 AS step FROM claims) "
        "SELECT claims.*, CAST(low + 1 * step < AMT_BILLED AS INTEGER) + CAST(low + 2 * step < AMT_BILLED AS INTEGER) "
        "+ CAST(low + 3 * step < AMT_BILLED AS INTEGER) AS AMT_BILLED_binned FROM claims, r",
        [*LINE, "AMT_BILLED"],
    ),
)
def bin_uniform(spark, sf_dir):
    return features.bin_uniform(claims_view(spark, sf_dir, [*LINE, "AMT_BILLED"]), ["AMT_BILLED"], 4)


@add(
    "log_feature",
    over_claims("SELECT *, round(ln(1 + greatest(AMT_PAID, 0)), 9) AS AMT_PAID_log FROM claims", [*LINE, "AMT_PAID"]),
)
def log_feature(spark, sf_dir):
    df = features.log_feature(claims_view(spark, sf_dir, [*LINE, "AMT_PAID"]), ["AMT_PAID"])
    return rounded(df, ["AMT_PAID_log"], 9)


# --- scaling ------------------------------------------------------------------------------

SCALED = [*LINE, "AMT_PAID", "CLIENT_LOS"]


def zscore_sql(c, digits=6, table="claims"):
    return f"round((CAST({c} AS DOUBLE) - (SELECT avg({c}) FROM {table})) / (SELECT stddev_pop({c}) FROM {table}), {digits})"


def minmax_sql(c, digits=9):
    return f"round((CAST({c} AS DOUBLE) - (SELECT min({c}) FROM claims)) / (SELECT max({c}) - min({c}) FROM claims), {digits})"


ZSCORED = over_claims(f"SELECT CLAIM_ID_KEY, SV_LINE, {zscore_sql('AMT_PAID')} AS AMT_PAID, {zscore_sql('CLIENT_LOS')} AS CLIENT_LOS FROM claims", SCALED)


@add("scale_zscore", ZSCORED)
def scale_zscore(spark, sf_dir):
    return rounded(scale.scale_zscore(claims_view(spark, sf_dir, SCALED), ["AMT_PAID", "CLIENT_LOS"]), ["AMT_PAID", "CLIENT_LOS"], 6)


@add(
    "scale_minmax",
    over_claims(f"SELECT CLAIM_ID_KEY, SV_LINE, {minmax_sql('AMT_PAID')} AS AMT_PAID, {minmax_sql('CLIENT_LOS')} AS CLIENT_LOS FROM claims", SCALED),
)
def scale_minmax(spark, sf_dir):
    return rounded(scale.scale_minmax(claims_view(spark, sf_dir, SCALED), ["AMT_PAID", "CLIENT_LOS"]), ["AMT_PAID", "CLIENT_LOS"], 9)


@add(
    "fit_scalers",
    over_claims(
        "SELECT 'zscore' AS method, 'AMT_PAID' AS \"column\", round(avg(AMT_PAID), 4) AS center, round(stddev_pop(AMT_PAID), 4) AS scale FROM claims "
        "UNION ALL SELECT 'zscore', 'CLIENT_LOS', round(avg(CLIENT_LOS), 4), round(stddev_pop(CLIENT_LOS), 4) FROM claims "
        "UNION ALL SELECT 'minmax', 'AMT_PAID', round(min(AMT_PAID), 4), round(max(AMT_PAID) - min(AMT_PAID), 4) FROM claims "
        "UNION ALL SELECT 'minmax', 'CLIENT_LOS', min(CLIENT_LOS), max(CLIENT_LOS) - min(CLIENT_LOS) FROM claims",
        SCALED,
    ),
)
def fit_scalers(spark, sf_dir):
    df = claims_view(spark, sf_dir, SCALED)
    fitted = [s for m in ("zscore", "minmax") for s in scale.fit_scalers(df, ["AMT_PAID", "CLIENT_LOS"], m)]
    rows = [(s.method, s.column, s.center, s.scale) for s in fitted]
    return rounded(spark.createDataFrame(rows, "method string, column string, center double, scale double"), ["center", "scale"])


TRAIN_MOD = "CLAIM_ID_KEY % 4 <> 0"


@add(
    "transform_scalers",
    over_claims(
        f", seen AS (SELECT * FROM claims WHERE {TRAIN_MOD}) SELECT CLAIM_ID_KEY, SV_LINE, {zscore_sql('AMT_PAID', table='seen')} AS AMT_PAID, "
        f"{zscore_sql('CLIENT_LOS', table='seen')} AS CLIENT_LOS FROM claims",
        SCALED,
    ),
)
def transform_scalers(spark, sf_dir):
    """Fitted on the training share of the claims, applied to all of them."""
    df = claims_view(spark, sf_dir, SCALED)
    fitted = scale.fit_scalers(df.filter(TRAIN_MOD), ["AMT_PAID", "CLIENT_LOS"], "standard")
    return rounded(scale.transform_scalers(df, fitted, ["AMT_PAID", "CLIENT_LOS", "NOT_THERE"]), ["AMT_PAID", "CLIENT_LOS"], 6)


PREPARED = [*LINE, "AMT_PAID", "AMT_BILLED", "CLIENT_LOS", "SV_STAT", "PRODUCT_TYPE"]
PREPARED_DUMMIES = dummies_sql({c: VALUES[c] for c in ("SV_STAT", "PRODUCT_TYPE")})
PREPARED_SQL = over_claims(
    f"SELECT CLAIM_ID_KEY, SV_LINE, {zscore_sql('AMT_BILLED')} AS AMT_BILLED, {zscore_sql('CLIENT_LOS')} AS CLIENT_LOS, {PREPARED_DUMMIES}, "
    "AMT_PAID FROM claims",
    PREPARED,
)


def prepared(df, state=None):
    return features.prepare_feature_set(df, "AMT_PAID", ["SV_STAT", "PRODUCT_TYPE"], ["AMT_BILLED", "CLIENT_LOS"], state=state)


@add("prepare_feature_set", PREPARED_SQL)
def prepare_feature_set(spark, sf_dir):
    return rounded(prepared(claims_view(spark, sf_dir, PREPARED)).data, ["AMT_BILLED", "CLIENT_LOS"], 6)


@add(
    "save_state",
    over_claims(
        "SELECT part, name FROM (VALUES ('scaler', 'AMT_BILLED'), ('scaler', 'CLIENT_LOS'), ('vocabulary', 'SV_STAT'), "
        "('vocabulary', 'PRODUCT_TYPE'), ('features', '')) t(part, name) WHERE (SELECT count(*) FROM claims) > 0",
        PREPARED,
    ),
)
def save_state(spark, sf_dir):
    path = scratch_path(spark, "state")
    features.save_state(spark, prepared(claims_view(spark, sf_dir, PREPARED)).state, path)
    return spark.read.parquet(path).select("part", "name")


@add("load_state", PREPARED_SQL)
def load_state(spark, sf_dir):
    """Fit, save, load, and prepare the claims with what was loaded."""
    df, path = claims_view(spark, sf_dir, PREPARED), scratch_path(spark, "state")
    features.save_state(spark, prepared(df).state, path)
    return rounded(prepared(df, features.load_state(spark, path)).data, ["AMT_BILLED", "CLIENT_LOS"], 6)


# --- selection ----------------------------------------------------------------------------

NUMBERS = ["AMT_BILLED", "AMT_DEDUCT", "AMT_COINS", "CLIENT_LOS", "SV_LINE"]


@add(
    "select_variance",
    over_claims(
        ", v AS ("
        + union(f"SELECT '{c}' AS feature, var_pop({c}) AS variance FROM claims" for c in NUMBERS)
        + ") SELECT feature, round(variance, 3) AS variance, variance > 5 AS kept FROM v",
        NUMBERS,
    ),
)
def select_variance(spark, sf_dir):
    df = claims_view(spark, sf_dir, NUMBERS)
    kept = select.select_variance(df, 5)[0].columns
    return rounded(select.variances(df).withColumn("kept", F.col("feature").isin(kept)), ["variance"], 3)


def f_score_sql(c):
    r = correlation_sql(c, "AMT_PAID")
    n = f"(count(*) FILTER ({c} IS NOT NULL AND AMT_PAID IS NOT NULL) - 2)"
    return f"SELECT '{c}' AS feature, ({r}) * ({r}) / nullif(1 - ({r}) * ({r}), 0) * {n} AS f_score FROM claims"


@add(
    "select_k_best_f",
    over_claims(
        f", f AS ({union(f_score_sql(c) for c in NUMBERS)}) SELECT feature, round(f_score, 3) AS f_score FROM f "
        "ORDER BY f.f_score DESC NULLS LAST, feature LIMIT 3",
        [*NUMBERS, "AMT_PAID"],
    ),
)
def select_k_best_f(spark, sf_dir):
    return rounded(select.select_k_best_f(claims_view(spark, sf_dir, [*NUMBERS, "AMT_PAID"]), "AMT_PAID", 3), ["f_score"], 3)


def mi_sql(columns, target, bins):
    def cells(c):
        return (
            f"SELECT '{c}' AS feature, {quantile_code_sql('x', bins)[1].replace('(e', '(qa.e').replace('(qa.e[', '(e[').replace('e[', 'qa.e[')} AS a, "
            f"{quantile_code_sql('y', bins)[1].replace('(e', '(qb.e').replace('(qb.e[', '(e[').replace('e[', 'qb.e[')} AS b "
            f"FROM (SELECT CAST({c} AS DOUBLE) AS x, CAST({target} AS DOUBLE) AS y FROM claims), "
            f"({quantile_code_sql('x', bins)[0].replace('FROM claims', f'FROM (SELECT CAST({c} AS DOUBLE) AS x FROM claims)')}) qa, "
            f"({quantile_code_sql('y', bins)[0].replace('FROM claims', f'FROM (SELECT CAST({target} AS DOUBLE) AS y FROM claims)')}) qb"
        )
    return (
        f", long AS ({union(cells(c) for c in columns)}), cells AS (SELECT feature, a, b, CAST(count(*) AS DOUBLE) AS n FROM long "
        "WHERE a IS NOT NULL AND b IS NOT NULL GROUP BY ALL), sized AS (SELECT *, sum(n) OVER (PARTITION BY feature) AS t, "
        "sum(n) OVER (PARTITION BY feature, a) AS na, sum(n) OVER (PARTITION BY feature, b) AS nb FROM cells), "
        "mi AS (SELECT feature, sum(n / t * ln(n * t / (na * nb))) AS mi FROM sized GROUP BY feature) "
    )


@add(
    "mutual_information",
    over_claims(
        mi_sql(NUMBERS, "AMT_PAID", 10) + "SELECT feature, round(mi, 9) AS mi FROM mi ORDER BY mi.mi DESC, feature LIMIT 4",
        [*NUMBERS, "AMT_PAID"],
    ),
)
def mutual_information(spark, sf_dir):
    """Between quantile bins; the nearest-neighbour estimator needs none."""
    found = select.mutual_information(claims_view(spark, sf_dir, [*NUMBERS, "AMT_PAID"]), "AMT_PAID")
    return rounded(select.top_features(found, "mi", 4), ["mi"], 9)


PART_NUMBERS = ["p_partkey", "p_size"]


def neighbours_sql(names, target, source, k=3):
    """The estimator by a self join: k-th distances, then counts within them in each coordinate."""
    steps = "CAST(round_even({c} / CAST(printf('%.4g', (SELECT stddev_pop({c}) FROM {s})) AS DOUBLE) * 4294967296.0, 0) AS BIGINT)"
    rows = union(f"SELECT '{c}' AS feature, row_number() OVER () AS id, {steps.format(c=c, s=source)} AS x, {steps.format(c=target, s=source)} AS y FROM {source}" for c in names)
    return (
        f"WITH p AS ({rows}), d AS (SELECT a.feature, a.id, greatest(abs(a.x - b.x), abs(a.y - b.y)) AS far FROM p a JOIN p b ON a.feature = b.feature AND a.id <> b.id), "
        f"r AS (SELECT feature, id, greatest(list_sort(min(far, {k}))[{k}] - 1, 0) AS r FROM d GROUP BY feature, id), "
        "c AS (SELECT a.feature, a.id, count(*) FILTER (abs(a.x - b.x) <= r.r) AS nx, count(*) FILTER (abs(a.y - b.y) <= r.r) AS ny "
        "FROM p a JOIN r ON r.feature = a.feature AND r.id = a.id JOIN p b ON b.feature = a.feature GROUP BY a.feature, a.id), "
        "h AS (SELECT n, coalesce(sum(1.0::DOUBLE / n) OVER (ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) - 0.5772156649015329 AS psi "
        f"FROM (SELECT unnest(range(1, (SELECT count(*) FROM {source}) + 1)) AS n)) "
        f"SELECT c.feature, greatest(0, (SELECT max(psi) FROM h) + (SELECT psi FROM h WHERE n = {k}) - avg(hx.psi + hy.psi)) AS mi FROM c JOIN h hx ON hx.n = nx JOIN h hy ON hy.n = ny GROUP BY c.feature"
    )


@add("select_k_best_mi", f"SELECT feature, round(mi, 8) AS mi FROM ({neighbours_sql(PART_NUMBERS, 'p_retailprice', 'part')}) ORDER BY mi DESC, feature LIMIT 2")
def select_k_best_mi(spark, sf_dir):
    """Over all parts: the self join of the SQL is quadratic, the query is not."""
    parts = table(spark, sf_dir, "part").select(*PART_NUMBERS, "p_retailprice")
    return rounded(select.select_k_best_mi(parts, "p_retailprice", 2), ["mi"], 8)


@add("select_importance")
def select_importance(spark, sf_dir):
    df = claims_view(spark, sf_dir, [*NUMBERS, "AMT_PAID"])
    return select.select_importance(df, "AMT_PAID", 3)


@add("select_rfe")
def select_rfe(spark, sf_dir):
    df = claims_view(spark, sf_dir, [*NUMBERS, "AMT_PAID"]).persist()
    kept = select.select_rfe(df, "AMT_PAID", 2, 2)
    df.unpersist()
    return select.f_scores(df, "AMT_PAID", kept)


CORRELATED = ["AMT_BILLED", "AMT_DEDUCT", "AMT_PAID"]


def kept_sql(column, earlier, threshold):
    """The column's rows, unless its correlation with an earlier column is above the threshold."""
    low = " OR ".join(f"abs(corr({e}, {column})) > {threshold}" for e in earlier) or "false"
    return f"SELECT CLAIM_ID_KEY, SV_LINE, '{column}' AS feature, {column} AS amount FROM claims WHERE NOT (SELECT {low} FROM claims)"


@add("drop_correlated", over_claims(union(kept_sql(c, CORRELATED[:i], 0.95) for i, c in enumerate(CORRELATED)).replace("(SELECT false FROM claims)", "false"), [*LINE, *CORRELATED]))
def drop_correlated(spark, sf_dir):
    """The columns that are left, one row per value."""
    left, _ = select.drop_correlated(claims_view(spark, sf_dir, [*LINE, *CORRELATED]), 0.95, CORRELATED)
    return left.unpivot(LINE, [c for c in left.columns if c not in LINE], "feature", "amount")


@add(
    "top_features",
    over_claims(
        ", v AS ("
        + union(f"SELECT '{c}' AS feature, var_pop({c}) AS score FROM claims" for c in NUMBERS)
        + ") SELECT feature, round(score, 3) AS score FROM v ORDER BY v.score DESC, feature LIMIT 2",
        NUMBERS,
    ),
)
def top_features(spark, sf_dir):
    scores = select.variances(claims_view(spark, sf_dir, NUMBERS)).withColumnRenamed("variance", "score")
    return rounded(select.top_features(scores, "score", 2), ["score"], 3)


# --- composite workflows ------------------------------------------------------------------


@add(
    "clean_claims",
    over_claims(
        f"SELECT FORM_TYPE, SV_STAT, PRODUCT_TYPE, AMT_BILLED, AMT_PAID, AMT_DEDUCT, AMT_COINS, coalesce(CLIENT_LOS, 0) AS CLIENT_LOS, "
        f"{NUM_DIAG_SQL} AS Num_diag, CASE WHEN SEX = 'M' THEN 1 ELSE 0 END AS Gender_Code, {AGE_SQL} AS Age, "
        f"{merged_sql(LETTER_SQL)} AS ICD_DIAG_01_PRIMARY_categories FROM claims "
        "WHERE AMT_BILLED >= 0 AND AMT_PAID >= 0 AND AMT_COINS >= 0 AND AMT_DEDUCT >= 0 AND PRODUCT_TYPE IS NOT NULL AND AGE IS NOT NULL"
    ),
)
def clean_claims(spark, sf_dir):
    return plans.clean_claims(claims_view(spark, sf_dir))


NOTEBOOK = [
    "CLAIM_ID_KEY", "AGE", "SEX", "AMT_BILLED", "AMT_PAID", "AMT_DEDUCT", "AMT_COINS", "FORM_TYPE", "SV_STAT", "PRODUCT_TYPE", ICD, "CLIENT_LOS",
]
NOTEBOOK_VALUES = {
    "FORM_TYPE": ["F", "O"],
    "SV_STAT": VALUES["SV_STAT"],
    "PRODUCT_TYPE": VALUES["PRODUCT_TYPE"],
    "ICD_Category": ["4", "A", "B", "M", "W", "X", "Y", "Z", "n"],
}
NOTEBOOK_NUMBERS = ["AMT_BILLED", "AMT_DEDUCT", "AMT_COINS", "CLIENT_LOS", "Age", "Gender_Code", "AMT_BILLED_log"]


@add(
    "feature_notebook",
    over_claims(
        ", rows_ AS (SELECT * REPLACE (coalesce(CLIENT_LOS, 0) AS CLIENT_LOS) FROM claims WHERE AMT_BILLED >= 0 AND AMT_PAID >= 0 AND "
        f"AMT_DEDUCT >= 0 AND AMT_COINS >= 0 AND SEX IS NOT NULL AND {ICD} IS NOT NULL AND AGE IS NOT NULL AND PRODUCT_TYPE IS NOT NULL), "
        f"coded AS (SELECT AMT_BILLED, AMT_DEDUCT, AMT_COINS, CLIENT_LOS, {AGE_SQL} AS AgeN, CASE WHEN SEX = 'M' THEN 1 ELSE 0 END AS Gender_Code, "
        f"ln(1 + AMT_BILLED) AS AMT_BILLED_log, {LETTER_SQL} AS ICD_Category, FORM_TYPE, SV_STAT, PRODUCT_TYPE, AMT_PAID FROM rows_) SELECT "
        + ", ".join(f"{zscore_sql('AgeN' if c == 'Age' else c, table='coded')} AS {c}" for c in NOTEBOOK_NUMBERS)
        + f", {dummies_sql(NOTEBOOK_VALUES)}, AMT_PAID FROM coded",
        NOTEBOOK,
    ),
)
def feature_notebook(spark, sf_dir):
    return rounded(plans.feature_notebook(claims_view(spark, sf_dir, NOTEBOOK))[0], NOTEBOOK_NUMBERS, 6)
