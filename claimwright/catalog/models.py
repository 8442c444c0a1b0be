"""Training, tuning, registry, scoring and evaluation."""

from __future__ import annotations

import json
import re
from statistics import NormalDist

from pyspark.sql import functions as F

from ..operators import evaluate, models, sampling, scale, scoring, tuning
from ..operators.clean import fill_missing
from ..operators.features import FeatureState
from ..operators.registry import ModelRegistry
from ..plans import workflows
from ..plans.claims_view import claims_view
from ..session import scratch_path
from ..streaming.score import stream_score
from .profiles import histogram_sql, rounded, union
from .registry import Catalog, key_sql, over_claims

catalog = Catalog()
add = catalog.add

LINE = ["CLAIM_ID_KEY", "SV_LINE"]
LABEL = "AMT_PAID"
INPUTS = ["AMT_BILLED", "AMT_COINS"]


# --- linear models against their closed forms ---------------------------------------------


def linear_rows(spark, sf_dir):
    """Standardised billed and coinsurance amounts with the paid amount."""
    return scale.scale_zscore(claims_view(spark, sf_dir, [*LINE, *INPUTS, LABEL]), INPUTS)


def fold_sides(rows):
    """(train, test): all folds but the first, and the first."""
    folded = sampling.k_folds(rows, FOLDS, LINE)
    return folded.filter("fold <> 0").drop("fold"), folded.filter("fold = 0").drop("fold")


def coefficients(spark, model):
    terms = [*zip(model.feature_names, model.regressor.coefficients.toArray().tolist()), ("intercept", model.regressor.intercept)]
    return rounded(spark.createDataFrame([(t, float(v)) for t, v in terms], "term string, value double"), ["value"], 2)


FOLDS = 5
STANDARD_SQL = (
    f", m AS (SELECT avg({INPUTS[0]}) AS m1, stddev_pop({INPUTS[0]}) AS s1, avg({INPUTS[1]}) AS m2, stddev_pop({INPUTS[1]}) AS s2 FROM claims), "
    f"z AS (SELECT ({INPUTS[0]} - m1) / s1 AS a, ({INPUTS[1]} - m2) / s2 AS b, {LABEL} AS y, {key_sql(LINE)} % {FOLDS} AS fold FROM claims, m)"
)


def solution_sql(i, l1, l2, where):
    """CTE f{i}: the weights of two features, from (S + l2 I) w = c - l1 sign(w) over the given rows.

    The signs are those of the solution without the L1 part; the L1 weight is far too small
    here to move a coefficient to zero or across it.
    """
    return (
        f", g{i} AS (SELECT count(*) AS n, var_pop(a) AS aa, var_pop(b) AS bb, covar_pop(a, b) AS ab, covar_pop(a, y) AS ay, "
        f"covar_pop(b, y) AS by_, avg(a) AS ma, avg(b) AS mb, avg(y) AS my FROM z WHERE {where}), "
        f"o{i} AS (SELECT *, aa + {l2} AS p11, bb + {l2} AS p22 FROM g{i}), "
        f"p{i} AS (SELECT *, ay - {l1} * sign(ay * p22 - by_ * ab) AS r1, by_ - {l1} * sign(by_ * p11 - ay * ab) AS r2 FROM o{i}), "
        f"w{i} AS (SELECT *, (r1 * p22 - r2 * ab) / (p11 * p22 - ab * ab) AS w1, (r2 * p11 - r1 * ab) / (p11 * p22 - ab * ab) AS w2 FROM p{i}), "
        f"f{i} AS (SELECT n, w1, w2, my - w1 * ma - w2 * mb AS w0 FROM w{i})"
    )


def closed_form(l1, l2):
    rows = [(INPUTS[0], "w1"), (INPUTS[1], "w2"), ("intercept", "w0")]
    return over_claims(
        STANDARD_SQL + solution_sql(0, l1, l2, "true") + " " + union(f"SELECT '{t}' AS term, round({w}, 2) AS value FROM f0" for t, w in rows),
        [*LINE, *INPUTS, LABEL],
    )


def scored_sql(i, l1, l2, train, test):
    """CTE e{i}: actual, prediction and error on the test rows of a fit on the train rows."""
    return solution_sql(i, l1, l2, train) + (
        f", e{i} AS (SELECT y, w0 + w1 * a + w2 * b AS p, y - (w0 + w1 * a + w2 * b) AS e FROM z, f{i} WHERE {test})"
    )


R2 = "1 - avg(e * e) / var_pop(y)"

SUMS = {"n": "1", "a": "a", "b": "b", "y": "y", "aa": "a * a", "bb": "b * b", "ab": "a * b", "ay": "a * y", "by_": "b * y", "yy": "y * y"}


def fits_sql(points, shares=(1.0,)):
    """CTE fits: r2 on both sides of the fit of every point, share and fold.

    ``points`` are (name, l1, l2) in SQL; the l2 may use n. Sums per fold and slice are added up for
    each fit. The two weights solve their equations with the signs that they have without l1, or one
    of them is 0 where that is the lasso's solution.
    """
    step = f"(({key_sql(LINE)} // {FOLDS}) % 1000000) / 1000000.0"
    at = " + ".join(f"CAST({step} >= {e} AS INTEGER)" for e in shares)
    sums = ", ".join(f"sum({x}) AS {c}" for c, x in SUMS.items())
    added = ", ".join(f"sum(c.{c}) AS {c}" for c in SUMS)
    named = union(f"SELECT {i} AS point, '{p}' AS params" for i, (p, _, _) in enumerate(points))
    l1 = "CASE point " + " ".join(f"WHEN {i} THEN {x}" for i, (_, x, _) in enumerate(points)) + " END"
    l2 = "CASE point " + " ".join(f"WHEN {i} THEN {x}" for i, (_, _, x) in enumerate(points)) + " END"
    left = "yy + n * w0 * w0 + w1 * w1 * aa + w2 * w2 * bb - 2 * w0 * y - 2 * w1 * ay - 2 * w2 * by_ + 2 * w0 * w1 * a + 2 * w0 * w2 * b + 2 * w1 * w2 * ab"
    score = f"1 - ({left}) / (yy - y * y / n)"
    return (
        f", zs AS (SELECT a, b, y, fold, {at} AS slice FROM z), "
        f"cells AS (SELECT fold, slice, {sums} FROM zs GROUP BY fold, slice), "
        f"grid AS (SELECT f.fold AS held, s.slice AS upto, s.share FROM (SELECT unnest(range({FOLDS})) AS fold) f, "
        f"({union(f'SELECT {i} AS slice, {e}::DOUBLE AS share' for i, e in enumerate(shares))}) s), "
        f"train AS (SELECT held, share, {added} FROM grid JOIN cells c ON c.fold <> held AND c.slice <= upto GROUP BY held, share), "
        f"test AS (SELECT fold AS held, {added.replace('c.', '')} FROM cells GROUP BY fold), "
        f"mo AS (SELECT p.point, p.params, t.*, aa / n - a / n * a / n AS saa, bb / n - b / n * b / n AS sbb, ab / n - a / n * b / n AS sab, "
        f"ay / n - a / n * y / n AS say, by_ / n - b / n * y / n AS sby FROM train t, ({named}) p), "
        f"q AS (SELECT *, {l1} AS l1, saa + {l2} AS p11, sbb + {l2} AS p22 FROM mo), "
        "r AS (SELECT *, sign(say * p22 - sby * sab) AS s1, sign(sby * p11 - say * sab) AS s2, p11 * p22 - sab * sab AS det FROM q), "
        "u AS (SELECT *, ((say - l1 * s1) * p22 - (sby - l1 * s2) * sab) / det AS v1, ((sby - l1 * s2) * p11 - (say - l1 * s1) * sab) / det AS v2, "
        "sign(say) * greatest(abs(say) - l1, 0) / p11 AS x1, sign(sby) * greatest(abs(sby) - l1, 0) / p22 AS x2 FROM r), "
        "v AS (SELECT *, CASE WHEN v1 * s1 >= 0 AND v2 * s2 >= 0 THEN v1 WHEN abs(sby - sab * x1) <= l1 THEN x1 ELSE 0 END AS w1, "
        "CASE WHEN v1 * s1 >= 0 AND v2 * s2 >= 0 THEN v2 WHEN abs(sby - sab * x1) <= l1 THEN 0 ELSE x2 END AS w2 FROM u), "
        "w AS (SELECT *, y / n - w1 * a / n - w2 * b / n AS w0 FROM v), "
        f"fits AS (SELECT w.params, w.share, w.held AS fold, w.n, w.train_r2, (SELECT {score} FROM test t WHERE t.held = w.held) AS r2 "
        f"FROM (SELECT *, {score} AS train_r2 FROM w) w)"
    )


def scored_folds_sql(points, tail, shares=(1.0,)):
    """The SQL over standardised claims that ends in ``tail`` over fits."""
    with_keys = STANDARD_SQL.replace("z AS (SELECT (", "z AS (SELECT CLAIM_ID_KEY, SV_LINE, (")
    return over_claims(with_keys + fits_sql(points, shares) + " " + tail, [*LINE, *INPUTS, LABEL])


def fit_linear(rows, model_type, params=None):
    return models.train_model(model_type, rows, rows, INPUTS, LABEL, params, "1")


@add("train_lasso", closed_form("0.1", "0"))
def train_lasso(spark, sf_dir):
    return coefficients(spark, fit_linear(linear_rows(spark, sf_dir), "lasso").model)


RIDGE = closed_form("0", "0.5 / n")


@add("train_ridge", RIDGE)
def train_ridge(spark, sf_dir):
    return coefficients(spark, fit_linear(linear_rows(spark, sf_dir), "ridge").model)


@add("train_elasticnet", closed_form("0.05", "0.05"))
def train_elasticnet(spark, sf_dir):
    return coefficients(spark, fit_linear(linear_rows(spark, sf_dir), "elasticnet").model)


# --- tree models --------------------------------------------------------------------------

FEATURES = ["AMT_BILLED", "AMT_DEDUCT", "AMT_COINS", "CLIENT_LOS", "SV_LINE"]


def model_rows(spark, sf_dir):
    """(train, validation): all claims, an absent length of stay counted as 0, split by an exact seeded fifth."""
    rows = fill_missing(claims_view(spark, sf_dir, ["CLAIM_ID_KEY", *FEATURES, LABEL]), {"CLIENT_LOS": 0})
    tagged = models.training_cache(sampling.tag_test_rows(rows, 0.2, LINE))
    return tagged.filter("NOT is_test").drop("is_test"), tagged.filter("is_test").drop("is_test")


def trained(spark, sf_dir, model_type, params=None):
    train, held_out = model_rows(spark, sf_dir)
    return models.train_model(model_type, train, held_out, FEATURES, LABEL, params, "1")


def result_rows(spark, results):
    return rounded(models.metrics_table(spark, results), ["train_r2", "r2", "rmse", "mae"], 6)


@add("train_forest")
def train_forest(spark, sf_dir):
    return result_rows(spark, {"random_forest": trained(spark, sf_dir, "random_forest")})


@add("train_gbt")
def train_gbt(spark, sf_dir):
    return result_rows(spark, {"gradient_boosting": trained(spark, sf_dir, "gradient_boosting")})


@add("train_adaboost")
def train_adaboost(spark, sf_dir):
    return result_rows(spark, {"adaboost": trained(spark, sf_dir, "adaboost")})


@add(
    "train_model",
    over_claims(
        STANDARD_SQL + scored_sql(0, "0", "0.5 / n", "fold <> 0", "fold = 0") + ", v AS (SELECT " + R2 + " AS r2 FROM e0) "
        + union(f"SELECT '{c}' AS feature, round(abs({w}), 2) AS importance, round(r2, 8) AS validation_r2, n AS training_samples FROM f0, v"
                for c, w in zip(INPUTS, ("w1", "w2"))),
        [*LINE, *INPUTS, LABEL],
    ),
)
def train_model(spark, sf_dir):
    train, test = fold_sides(linear_rows(spark, sf_dir))
    result = models.train_model("ridge", train, test, INPUTS, LABEL, None, "1")
    scores = spark.createDataFrame(list(result.importances.items()), "feature string, importance double")
    return rounded(scores, ["importance"], 2).withColumns(
        {
            "validation_r2": F.round(F.lit(result.scores["validation"]["r2"]), 8),
            "training_samples": F.lit(result.rows).cast("bigint"),
        }
    )


@add("train_all")
def train_all(spark, sf_dir):
    train, held_out = model_rows(spark, sf_dir)
    return result_rows(spark, models.train_all(train, held_out, FEATURES, LABEL))


FEW = ["SV_LINE", "CLIENT_LOS"]
# deep enough, on all features, without sampling: trees that end in the mean of every combination
EXACT_TREES = {
    "random_forest": {"n_estimators": 3, "max_depth": None, "max_features": None, "bootstrap": False},
    "gradient_boosting": {"n_estimators": 3, "max_depth": 13, "learning_rate": 0.1},
}


@add(
    "train_trees",
    over_claims(
        f", g AS (SELECT SV_LINE, coalesce(CLIENT_LOS, 0) AS los, avg({LABEL}) AS p FROM claims GROUP BY ALL), "
        f"e AS (SELECT {LABEL} AS y, {LABEL} - p AS e FROM claims JOIN g ON g.SV_LINE = claims.SV_LINE AND g.los = coalesce(CLIENT_LOS, 0)) "
        + union(f"SELECT '{m}' AS model, round({R2}, 8) AS train_r2, round({R2}, 8) AS r2, round(sqrt(avg(e * e)), 4) AS rmse, round(avg(abs(e)), 4) AS mae FROM e" for m in EXACT_TREES),
        ["SV_LINE", "CLIENT_LOS", LABEL],
    ),
)
def train_trees(spark, sf_dir):
    """Forest and boosting on features of few values, where both must give the mean of each combination."""
    rows = models.training_cache(fill_missing(claims_view(spark, sf_dir, [*FEW, LABEL]), {"CLIENT_LOS": 0}))
    fitted = {kind: models.train_model(kind, rows, rows, FEW, LABEL, params, "1") for kind, params in EXACT_TREES.items()}
    shown = models.metrics_table(spark, fitted).drop("error")
    return rounded(rounded(shown, ["train_r2", "r2"], 8), ["rmse", "mae"], 4)


# --- tuning -------------------------------------------------------------------------------


def tuned(spark, points):
    rows = [(json.dumps(p, sort_keys=True), s) for p, s in points]
    return rounded(spark.createDataFrame(rows, "params string, mean_r2 double"), ["mean_r2"], 8)


def points_sql(kind, alphas):
    forms = {"ridge": ("0", "{a}::DOUBLE / n"), "lasso": ("{a}::DOUBLE", "0")}
    return [(json.dumps({"alpha": a}), *[f.format(a=a) for f in forms[kind]]) for a in alphas]


MEAN_R2 = "SELECT params, round(avg(r2), 8) AS mean_r2 FROM fits GROUP BY params"


@add("tune_grid", scored_folds_sql(points_sql("ridge", models.GRIDS["ridge"]["alpha"]), MEAN_R2))
def tune_grid(spark, sf_dir):
    """All alphas of the ridge grid over five folds, from one scan."""
    return tuned(spark, tuning.tune_grid("ridge", linear_rows(spark, sf_dir), INPUTS, LABEL, fold_keys=LINE)[2])


LASSO_CHOICE = [p["alpha"] for p in tuning.grid_points(models.GRIDS["lasso"], 3)]


@add("tune_random", scored_folds_sql(points_sql("lasso", LASSO_CHOICE), MEAN_R2))
def tune_random(spark, sf_dir):
    """Three seeded points of the lasso grid over five folds, from one scan."""
    return tuned(spark, tuning.tune_random("lasso", linear_rows(spark, sf_dir), INPUTS, LABEL, 3, fold_keys=LINE)[2])


@add(
    "cross_validate",
    scored_folds_sql(
        points_sql("ridge", [0.5]),
        "SELECT CAST(fold AS INTEGER) AS fold, round(r2, 8) AS r2, (SELECT round(avg(r2), 8) FROM fits) AS mean_r2, (SELECT round(stddev_pop(r2), 8) FROM fits) AS std_r2 FROM fits",
    ),
)
def cross_validate(spark, sf_dir):
    found = tuning.cross_validate("ridge", linear_rows(spark, sf_dir), INPUTS, LABEL, FOLDS, fold_keys=LINE)
    scores = spark.createDataFrame(list(enumerate(found["scores"])), "fold int, r2 double")
    shown = scores.withColumns({"mean_r2": F.lit(found["mean_r2"]), "std_r2": F.lit(found["std_r2"])})
    return rounded(shown, ["r2", "mean_r2", "std_r2"], 8)


# --- registry -----------------------------------------------------------------------------


MODELS = {"paid_ridge": ("ridge", [50.0, 0.5]), "paid_lasso": ("lasso", [0.1])}  # alphas of the versions


def fitted_state(spark, sf_dir):
    """(raw claims, state): z-scores of the two amounts, learnt from all claims."""
    claims = claims_view(spark, sf_dir, [*LINE, *INPUTS, LABEL])
    return claims, FeatureState(scale.fit_scalers(claims, INPUTS, "zscore"), {}, INPUTS)


def filled_registry(spark, sf_dir):
    """All versions of ``MODELS``, trained on raw claims through one state, saved in a fresh registry."""
    registry, (claims, state) = ModelRegistry(spark, scratch_path(spark, "registry")), fitted_state(spark, sf_dir)
    for name, (kind, alphas) in MODELS.items():
        for version, alpha in enumerate(alphas, 1):
            registry.save(models.train_model(kind, claims, claims, INPUTS, LABEL, {"alpha": alpha}, str(version), state), name)
    return registry


# the r2 of every version over all claims, from which SQL tells them apart
VERSIONS = [(f"{name}/{v}", f"{a}::DOUBLE" if kind == "lasso" else "0", "0" if kind == "lasso" else f"{a}::DOUBLE / n") for name, (kind, alphas) in MODELS.items() for v, a in enumerate(alphas, 1)]
SAVED = STANDARD_SQL + "".join(scored_sql(i, l1, l2, "true", "true") for i, (_, l1, l2) in enumerate(VERSIONS)) + ", saved AS (" + union(
    f"SELECT '{name.split('/')[0]}' AS model, '{name.split('/')[1]}' AS version, {i} AS seq, count(*) AS training_samples, round({R2}, 8) AS r2 FROM e{i}" for i, (name, _, _) in enumerate(VERSIONS)
) + ") "


@add("registry_save", over_claims(SAVED + "SELECT model, version, training_samples, r2 FROM saved", [*LINE, *INPUTS, LABEL]))
def registry_save(spark, sf_dir):
    """What the registry's tables say of all saved versions."""
    registry = filled_registry(spark, sf_dir)
    scores = registry.metrics().where("side = 'validation' AND metric = 'r2'").select("model", "version", F.round("value", 8).alias("r2"))
    return registry.events().select("model", "version", F.col("rows").alias("training_samples")).join(scores, ["model", "version"])


@add("registry_load", RIDGE)
def registry_load(spark, sf_dir):
    """The latest ridge version, read back from its files."""
    return coefficients(spark, filled_registry(spark, sf_dir).load("paid_ridge"))


@add(
    "registry_list",
    over_claims(
        SAVED + "SELECT model, string_agg(version, ',' ORDER BY seq) AS versions, arg_max(version, seq) AS latest, arg_max(r2, seq) AS r2 FROM saved GROUP BY model",
        [*LINE, *INPUTS, LABEL],
    ),
)
def registry_list(spark, sf_dir):
    """Versions in order, the latest, and how the latest does when it is read back and scores all claims."""
    registry, (claims, _) = filled_registry(spark, sf_dir), fitted_state(spark, sf_dir)
    listed = registry.list_models().withColumn("versions", F.array_join("versions", ","))
    scores = [(r["model"], evaluate.evaluate_model(registry.load(r["model"], r["latest"]), claims, LABEL)[0].first()["r2"]) for r in listed.collect()]
    return listed.join(rounded(spark.createDataFrame(scores, "model string, r2 double"), ["r2"], 8), "model")


@add("registry_promote", over_claims(SAVED + "SELECT model, version FROM saved WHERE model = 'paid_ridge' ORDER BY r2 DESC LIMIT 1", [*LINE, *INPUTS, LABEL]))
def registry_promote(spark, sf_dir):
    """The ridge version of the best r2 is promoted after the lasso."""
    registry = filled_registry(spark, sf_dir)
    registry.promote("paid_lasso")
    found = registry.metrics().where("model = 'paid_ridge' AND side = 'validation' AND metric = 'r2'")
    registry.promote("paid_ridge", found.orderBy(F.desc("value")).first()["version"])
    return registry.production_pointer()


@add("registry_production", RIDGE)
def registry_production(spark, sf_dir):
    registry = filled_registry(spark, sf_dir)
    registry.promote("paid_lasso")
    registry.promote("paid_ridge", "2")
    return coefficients(spark, registry.production()[0])


# the split side of every row, in SQL: the fifth with the smallest keys, as the split counts them
TEST_FIFTH = f"row_number() OVER (ORDER BY {key_sql(LINE)}, CLAIM_ID_KEY, SV_LINE) <= (SELECT ceil(0.2 * count(*)) FROM claims)"
TRAIN_FLOW = (
    f", t AS (SELECT CLAIM_ID_KEY, SV_LINE, {INPUTS[0]}, {INPUTS[1]}, {LABEL}, {TEST_FIFTH} AS held FROM claims), "
    f"m AS (SELECT avg({INPUTS[0]}) AS m1, stddev_pop({INPUTS[0]}) AS s1, avg({INPUTS[1]}) AS m2, stddev_pop({INPUTS[1]}) AS s2 FROM t WHERE NOT held), "
    f"z AS (SELECT ({INPUTS[0]} - m1) / s1 AS a, ({INPUTS[1]} - m2) / s2 AS b, {LABEL} AS y, held FROM t, m)"
    + scored_sql(0, "0", "0.5 / n", "NOT held", "held") + scored_sql(1, "0.1", "0", "NOT held", "held")
    + f", r AS ({union(f'SELECT {chr(39)}{k}{chr(39)} AS best, {i} AS i, {R2} AS r2 FROM e{i}' for i, k in enumerate(('ridge', 'lasso')))}), "
    "best AS (SELECT best, i FROM r ORDER BY r2 DESC LIMIT 1), e AS (SELECT 0 AS i, * FROM e0 UNION ALL SELECT 1, * FROM e1)"
)


@add(
    "train_workflow",
    over_claims(
        TRAIN_FLOW + f" SELECT any_value(best) AS best, '1' AS version, round({R2}, 8) AS r2, round(sqrt(avg(e * e)), 4) AS rmse, round(avg(abs(e)), 4) AS mae, count(*) AS n "
        "FROM e JOIN best USING (i)",
        [*LINE, *INPUTS, LABEL],
    ),
)
def train_workflow(spark, sf_dir):
    """Split, features, two models, the best one registered, promoted, read back and evaluated on raw rows."""
    registry = ModelRegistry(spark, scratch_path(spark, "registry"))
    rows = claims_view(spark, sf_dir, [*LINE, *INPUTS, LABEL])
    done = workflows.train(rows, registry, LABEL, scaled=INPUTS, model_types=["ridge", "lasso"], key_columns=LINE)
    shown = rounded(rounded(done.metrics.select("r2", "rmse", "mae"), ["r2"], 8), ["rmse", "mae"], 4)
    return shown.withColumns({"best": F.lit(done.best), "version": F.lit(done.version), "n": F.lit(done.scored.count()).cast("bigint")})


# --- scoring ------------------------------------------------------------------------------

REQUEST = {
    "amt_billed": "AMT_BILLED",
    "amt_deduct": "AMT_DEDUCT",
    "amt_coins": "AMT_COINS",
    "client_los": "CLIENT_LOS",
    "sv_stat": "SV_STAT",
    "form_type": "FORM_TYPE",
    "icd_category": "substr(ICD_DIAG_01_PRIMARY, 1, 1)",
}
REQUEST_CLAIMS = [*LINE, "AMT_BILLED", "AMT_DEDUCT", "AMT_COINS", "CLIENT_LOS", "SV_STAT", "FORM_TYPE", "ICD_DIAG_01_PRIMARY"]


def requests(spark, sf_dir):
    return claims_view(spark, sf_dir, REQUEST_CLAIMS).selectExpr(*LINE, *[f"{v} AS {k}" for k, v in REQUEST.items()])


def fixed_dummies():
    given = {"SV_STAT": "SV_STAT", "FORM_TYPE": "FORM_TYPE", "ICD_Category": "coalesce(substr(ICD_DIAG_01_PRIMARY, 1, 1), 'Z')"}
    for name, (source, values) in scoring.DUMMY_FEATURES.items():
        for v in values:
            yield f"CAST({given.get(name, repr(scoring.REQUEST_DEFAULTS[source]))} = '{v}' AS INTEGER) AS \"{name}_{v}\""


@add(
    "score_features",
    over_claims(
        "SELECT CLAIM_ID_KEY, SV_LINE, AMT_BILLED, AMT_DEDUCT, AMT_COINS, 45.0::DOUBLE AS Age, 0.0::DOUBLE AS Gender_Code, "
        f"CAST(coalesce(CLIENT_LOS, 0) AS DOUBLE) AS CLIENT_LOS, round(ln(1 + AMT_BILLED), 9) AS AMT_BILLED_log, {', '.join(fixed_dummies())} FROM claims",
        REQUEST_CLAIMS,
    ),
)
def score_features(spark, sf_dir):
    return rounded(scoring.score_features(requests(spark, sf_dir), None, LINE), ["AMT_BILLED_log"], 9)


def interval_sql(fit, version, where="true"):
    """Amounts as decimals; the interval is 1.96 * 0.15 of the amount on both sides. ``fit`` is a CTE of weights."""
    return (
        "SELECT CLAIM_ID_KEY, SV_LINE, CAST(CAST(amount AS DECIMAL(18,2)) AS DOUBLE) AS predicted_amount, "
        "CAST(CAST(amount * CAST(0.706 AS DECIMAL(4,3)) AS DECIMAL(18,2)) AS DOUBLE) AS lower, "
        f"CAST(CAST(amount * CAST(1.294 AS DECIMAL(4,3)) AS DECIMAL(18,2)) AS DOUBLE) AS upper, '{version}' AS model_version FROM ("
        "SELECT *, greatest(CAST(w0 + w1 * a + w2 * b AS DECIMAL(20,6)), CAST(0 AS DECIMAL(20,6))) AS amount FROM "
        f"(SELECT CLAIM_ID_KEY, SV_LINE, (coalesce({INPUTS[0]}, 0) - m1) / s1 AS a, (coalesce({INPUTS[1]}, 0) - m2) / s2 AS b FROM claims, m) r, {fit}) WHERE {where}"
    )


def flat_scores(df):
    return df.withColumns(
        {
            "predicted_amount": F.col("predicted_amount").cast("double"),
            "lower": F.col("confidence_interval.lower").cast("double"),
            "upper": F.col("confidence_interval.upper").cast("double"),
        }
    ).drop("confidence_interval")


SCORED_CLAIMS = list(dict.fromkeys([*REQUEST_CLAIMS, *INPUTS, LABEL]))


@add("score_batch", over_claims(STANDARD_SQL + solution_sql(0, "0", "0.5 / n", "true") + " " + interval_sql("f0", "2"), SCORED_CLAIMS))
def score_batch(spark, sf_dir):
    """Every claim as a request, scored by the registered ridge model in production and its state."""
    registry = filled_registry(spark, sf_dir)
    registry.promote("paid_ridge", "2")
    return flat_scores(scoring.score_batch(registry.production()[0], requests(spark, sf_dir), LINE, "2"))


BROKEN = "CLAIM_ID_KEY % 50 = 7"


def streamed_sql(fit, version, where):
    rows = interval_sql(fit, version, f"NOT ({BROKEN}) AND {where}").replace("SELECT CLAIM_ID_KEY, SV_LINE, ", "SELECT CLAIM_ID_KEY || '-' || SV_LINE AS request_id, true AS success, CAST(NULL AS VARCHAR) AS error, ", 1)
    bad = f"SELECT NULL, false, 'not a JSON record', NULL, NULL, NULL, '{version}' FROM claims WHERE {BROKEN} AND {where}"
    return f"{rows} UNION ALL {bad}"


@add(
    "stream_score",
    over_claims(
        STANDARD_SQL + solution_sql(0, "0", "50.0 / n", "true") + solution_sql(1, "0", "0.5 / n", "true") + " "
        + streamed_sql("f0", "1", "CLAIM_ID_KEY % 2 = 0") + " UNION ALL " + streamed_sql("f1", "2", "CLAIM_ID_KEY % 2 = 1"),
        SCORED_CLAIMS,
    ),
)
def stream(spark, sf_dir):
    """Claims arrive as JSON requests in two batches, with a promotion between them; one order in fifty is cut short."""
    registry, rows = filled_registry(spark, sf_dir), requests(spark, sf_dir)
    body = F.to_json(F.struct(F.concat_ws("-", *LINE).alias("request_id"), *[F.col(c) for c in REQUEST]))
    broken = F.when(F.expr(BROKEN), F.substring(body, 1, 20)).otherwise(body)
    landing, output, state = (scratch_path(spark, f"score-{n}") for n in ("requests", "output", "state"))
    for version, parity in (("1", 0), ("2", 1)):
        rows.where(F.col("CLAIM_ID_KEY") % 2 == parity).select(broken.alias("value")).write.mode("append").text(landing)
        registry.promote("paid_ridge", version)
        stream_score(spark, landing, output, state, registry)
    return flat_scores(spark.read.parquet(output).drop("batch"))


# --- evaluation ---------------------------------------------------------------------------

# Two stand-in predictions, so that the metrics can be repeated in SQL.
GUESSES = {"steady": "0.95D * AMT_BILLED - 2000D", "rough": "0.8D * AMT_BILLED - 500D"}
EVALUATED = [*LINE, "AMT_BILLED", LABEL]


def sql_guess(name):
    return re.sub(r"(\d)D\b", r"\1::DOUBLE", GUESSES[name])


def predictions(spark, sf_dir):
    return claims_view(spark, sf_dir, EVALUATED).withColumns({k: F.expr(v) for k, v in GUESSES.items()})


def metrics_sql(name):
    e = f"({LABEL} - ({sql_guess(name)}))"
    return (
        f"round(1 - avg({e} * {e}) / var_pop({LABEL}), 8) AS r2, round(sqrt(avg({e} * {e})), 4) AS rmse, round(avg(abs({e})), 4) AS mae, "
        f"round(avg(abs({e}) / abs({LABEL})) FILTER ({LABEL} <> 0), 6) AS mape, round(1 - var_pop({e}) / var_pop({LABEL}), 8) AS explained_variance, "
        f"round(avg({e}), 4) AS residual_mean, round(stddev_pop({e}), 4) AS residual_std"
    )


def shown_metrics(df):
    return rounded(rounded(rounded(df, ["r2", "explained_variance"], 8), ["rmse", "mae", "residual_mean", "residual_std"]), ["mape"], 6)


@add("regression_metrics", over_claims(f"SELECT {metrics_sql('steady')} FROM claims", EVALUATED))
def regression_metrics(spark, sf_dir):
    return shown_metrics(evaluate.regression_metrics(predictions(spark, sf_dir), LABEL, "steady"))


EVALUATED_RIDGE = STANDARD_SQL + scored_sql(0, "0", "0.5 / n", "fold <> 0", "fold = 0")
TEST_METRICS = (
    f"round({R2}, 8) AS r2, round(sqrt(avg(e * e)), 4) AS rmse, round(avg(abs(e)), 4) AS mae, "
    "round(avg(abs(e) / abs(y)) FILTER (y <> 0), 6) AS mape, round(1 - var_pop(e) / var_pop(y), 8) AS explained_variance, "
    "round(avg(e), 4) AS residual_mean, round(stddev_pop(e), 4) AS residual_std"
)


@add("evaluate_model", over_claims(f"{EVALUATED_RIDGE} SELECT {TEST_METRICS} FROM e0", [*LINE, *INPUTS, LABEL]))
def evaluate_model(spark, sf_dir):
    train, test = fold_sides(linear_rows(spark, sf_dir))
    result = models.train_model("ridge", train, test, INPUTS, LABEL, None, "1")
    return shown_metrics(evaluate.evaluate_model(result.model, test, LABEL)[0])


COMPARED = {"ridge": ("0", "0.5 / n"), "lasso": ("0.1", "0"), "elasticnet": ("0.05", "0.05")}
COMPARED_SQL = STANDARD_SQL + "".join(scored_sql(i, l1, l2, "fold <> 0", "fold = 0") for i, (l1, l2) in enumerate(COMPARED.values()))


def compared(spark, sf_dir):
    train, test = fold_sides(linear_rows(spark, sf_dir))
    fitted = {kind: models.train_model(kind, train, test, INPUTS, LABEL, None, "1").model for kind in COMPARED}
    return evaluate.compare_models(fitted, test, LABEL)


@add("compare_models", over_claims(COMPARED_SQL + " " + union(f"SELECT '{m}' AS model, {TEST_METRICS} FROM e{i}" for i, m in enumerate(COMPARED)), [*LINE, *INPUTS, LABEL]))
def compare_models(spark, sf_dir):
    """Three models fitted on four folds score the fifth."""
    return shown_metrics(compared(spark, sf_dir))


@add(
    "compare_predictions",
    over_claims(union(f"SELECT '{m}' AS model, {metrics_sql(m)} FROM claims" for m in GUESSES), EVALUATED),
)
def compare_predictions(spark, sf_dir):
    return shown_metrics(evaluate.compare_predictions(predictions(spark, sf_dir), LABEL, {m: m for m in GUESSES}))


@add(
    "best_model",
    over_claims(COMPARED_SQL + f", r AS ({union(f'SELECT {chr(39)}{m}{chr(39)} AS model, {R2} AS r2 FROM e{i}' for i, m in enumerate(COMPARED))}) SELECT model, round(r2, 8) AS r2 FROM r ORDER BY r.r2 DESC, model LIMIT 1", [*LINE, *INPUTS, LABEL]),
)
def best_model(spark, sf_dir):
    return rounded(models.best_model(compared(spark, sf_dir)).select("model", "r2"), ["r2"], 8)


@add(
    "business_impact",
    over_claims(
        f", e AS (SELECT avg({LABEL}) AS mean_actual, avg(abs({LABEL} - ({sql_guess('rough')}))) AS mae FROM claims) "
        "SELECT round(mean_actual, 4) AS mean_actual, round(mae, 4) AS mae, round(mae / mean_actual, 8) AS mae_share FROM e",
        EVALUATED,
    ),
)
def business_impact(spark, sf_dir):
    df = evaluate.business_impact(predictions(spark, sf_dir), LABEL, "rough")
    return rounded(rounded(df, ["mean_actual", "mae"]), ["mae_share"], 8)


@add(
    "pred_vs_actual_data",
    over_claims(
        f", p AS (SELECT {LABEL} AS actual, {sql_guess('rough')} AS predicted FROM claims) SELECT actual, predicted, actual - predicted AS residual, "
        "(SELECT least(min(actual), min(predicted)) FROM p) AS low, (SELECT greatest(max(actual), max(predicted)) FROM p) AS high FROM p",
        EVALUATED,
    ),
)
def pred_vs_actual_data(spark, sf_dir):
    df = predictions(spark, sf_dir)
    ends = evaluate.shared_line(df, LABEL, "rough").first()
    return evaluate.pred_vs_actual_data(df, LABEL, "rough").withColumns({"low": F.lit(ends["low"]), "high": F.lit(ends["high"])})


RESIDUAL = f"{LABEL} - ({sql_guess('rough')})"


@add(
    "residual_histogram",
    histogram_sql(RESIDUAL, extra=", (SELECT round(avg(x), 4) FROM v) AS mean_residual", columns=EVALUATED),
)
def residual_histogram(spark, sf_dir):
    df = evaluate.residual_histogram(predictions(spark, sf_dir), LABEL, "rough")
    return rounded(rounded(df, ["lower", "upper"], 6), ["mean_residual"])


QQ = [(i / 100, NormalDist().inv_cdf(i / 100)) for i in range(1, 100)]


@add(
    "qq_points",
    over_claims(
        f", q AS (SELECT share, theoretical FROM (VALUES {', '.join(f'({s!r}::DOUBLE, {z!r}::DOUBLE)' for s, z in QQ)}) t(share, theoretical)), "
        f"l AS (SELECT quantile_cont({RESIDUAL}, [{', '.join(repr(s) for s, _ in QQ)}]) AS r FROM claims) "
        "SELECT share, theoretical, round(r[CAST(round(share * 100) AS INTEGER)], 6) AS residual FROM q, l",
        EVALUATED,
    ),
)
def qq_points(spark, sf_dir):
    return rounded(evaluate.qq_points(predictions(spark, sf_dir), LABEL, "rough"), ["residual"], 6)


@add(
    "importance_rank",
    over_claims(
        ", c AS ("
        + union(f"SELECT '{c}' AS feature, round(covar_pop({c}, {LABEL}) / 1e6, 4) AS score FROM claims" for c in ["CLIENT_LOS", "AMT_BILLED", "SV_LINE", "AMT_DEDUCT"])
        + ") SELECT * FROM c ORDER BY abs(score) DESC, feature LIMIT 3",
        ["CLIENT_LOS", "AMT_BILLED", "SV_LINE", "AMT_DEDUCT", LABEL],
    ),
)
def importance_rank(spark, sf_dir):
    names = ["CLIENT_LOS", "AMT_BILLED", "SV_LINE", "AMT_DEDUCT"]
    one = claims_view(spark, sf_dir, [*names, LABEL]).agg(*[F.round(F.covar_pop(c, LABEL) / 1e6, 4).alias(c) for c in names])
    scores = one.unpivot([], names, "feature", "score")
    return evaluate.importance_rank(scores, "score", 3)


@add(
    "learning_curve_data",
    scored_folds_sql(
        points_sql("ridge", [0.5]),
        "SELECT share, round(avg(train_r2), 8) AS train_mean, round(stddev_pop(train_r2), 8) AS train_std, round(avg(r2), 8) AS validation_mean, "
        "round(stddev_pop(r2), 8) AS validation_std FROM fits GROUP BY share",
        tuning.SHARES,
    ),
)
def learning_curve_data(spark, sf_dir):
    """Ridge on five growing shares of the claims, over five folds, from one scan."""
    scores = tuning.learning_curve("ridge", linear_rows(spark, sf_dir), INPUTS, LABEL, fold_keys=LINE)
    return rounded(evaluate.learning_curve_data(scores, "share"), ["train_mean", "train_std", "validation_mean", "validation_std"], 8)


@add(
    "evaluation_report",
    over_claims(
        f"{EVALUATED_RIDGE} SELECT {TEST_METRICS}, round(least(min(y), min(p)), 4) AS low, round(greatest(max(y), max(p)), 4) AS high, "
        "count(*) AS n FROM e0",
        [*LINE, *INPUTS, LABEL],
    ),
)
def evaluation_report(spark, sf_dir):
    train, test = fold_sides(linear_rows(spark, sf_dir))
    result = models.train_model("ridge", train, test, INPUTS, LABEL, None, "1")
    report = evaluate.evaluation_report(result.model, test, LABEL)
    ends = report["line"].first()
    return shown_metrics(report["metrics"]).withColumns(
        {"low": F.round(F.lit(ends["low"]), 4), "high": F.round(F.lit(ends["high"]), 4), "n": F.lit(report["predictions"].count()).cast("bigint")}
    )
