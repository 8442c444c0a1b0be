import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F, types as T

from claimwright.operators import products, evaluate, profile, quality


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(5)
    n = 500
    frame = pd.DataFrame({"a": rng.exponential(3, n), "b": rng.normal(size=n), "flat": 0.1})
    frame.loc[rng.random(n) < 0.2, "b"] = None
    return frame


@pytest.fixture(scope="module")
def df(spark, frame):
    rows = [tuple(None if pd.isna(v) else float(v) for v in r) for r in frame.itertuples(index=False)]
    return spark.createDataFrame(rows, "a double, b double, flat double").repartition(7).persist()


def test_describe_and_target_match_pandas(df, frame):
    got = {r["column"]: r for r in profile.describe_numeric(df, digits=10).collect()}
    want = frame.describe()
    for c in frame.columns:
        for mine, theirs in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")):
            assert got[c][mine] == pytest.approx(want.loc[theirs, c], abs=1e-9), (c, mine)
    assert profile.target_stats(df, "a").first()["skew"] == pytest.approx(frame.a.skew())
    assert profile.target_stats(df, "flat").first()["skew"] is None


def test_histogram_matches_numpy(df, frame, spark):
    for c in ("a", "b", "flat"):
        counts, edges = np.histogram(frame[c].dropna(), bins=13)
        got = profile.histogram(df, c, 13).orderBy("bin").collect()
        assert [r["n"] for r in got] == counts.tolist()
        assert [r["lower"] for r in got] == pytest.approx(edges[:-1].tolist())
    exact = spark.createDataFrame([(x / 10,) for x in range(11)], "x double")
    want = np.histogram([x / 10 for x in range(11)], bins=10)[0].tolist()
    assert [r["n"] for r in profile.histogram(exact, "x", 10).orderBy("bin").collect()] == want
    assert profile.histogram(exact.filter("x > 5"), "x").count() == 0


def test_correlation_is_pairwise_complete(df, frame):
    got = {(r["x"], r["y"]): r["r"] for r in profile.correlation_matrix(df).collect()}
    assert got[("a", "b")] == pytest.approx(frame.corr().loc["a", "b"])
    assert got[("a", "flat")] is None and got[("b", "flat")] is None
    assert [r["feature"] for r in profile.target_correlation(df, "a").collect()] == ["b", "flat"]


def test_wide_correlation_uses_blocks(df, monkeypatch):
    whole = sorted(map(tuple, profile.correlation_matrix(df).collect()), key=str)
    monkeypatch.setattr(products, "BLOCK", 2)
    got = sorted(map(tuple, profile.correlation_matrix(df).collect()), key=str)
    assert [g[:2] for g in got] == [w[:2] for w in whole]
    assert [g[2] for g in got] == [None if w[2] is None else pytest.approx(w[2]) for w in whole]


def test_pair_sums_of_far_and_constant_columns(spark):
    rows = [(1e9 + i, 1e9 + (i % 5), 7.3, None if i % 3 else float(i * i), 0.1 if i % 3 else float(i)) for i in range(90)]
    frame = spark.createDataFrame(rows, "a double, b double, flat double, holes double, part double").repartition(4)
    got = {(r["x"], r["y"]): r["r"] for r in profile.correlation_matrix(frame).collect()}
    want = frame.toPandas().corr()
    for (x, y), r in got.items():
        assert r is None if "flat" in (x, y) else r == pytest.approx(want.loc[x, y])
    wide = spark.range(40).select(*[((F.col("id") * (i + 3)) % 17).cast("double").alias(f"c{i}") for i in range(63)])
    assert profile.correlation_matrix(wide).count() == 63 * 62 / 2


def test_counts(df, frame, spark):
    missing = profile.missing_profile(df).collect()
    n = int(frame.b.isna().sum())
    assert [tuple(r) for r in missing] == [("b", n, round(n / 5, 2))]
    row = profile.table_profile(df, "a").first()
    assert (row["rows"], row["columns"], row["columns_with_nulls"]) == (500, 3, 1)
    words = spark.createDataFrame([("x", "p")] * 3 + [("y", None)] * 2 + [(None, None)], "k string, m string")
    assert {tuple(r) for r in profile.value_counts_topk(words, k=1).collect()} == {("k", "x", 3, 1), ("m", "p", 3, 1)}
    assert {tuple(r) for r in profile.distinct_count(words, ["k", "m"]).collect()} == {("k", 2), ("m", 1)}
    assert {tuple(r) for r in profile.distinct_count(words, ["k", "m"], True).collect()} == {("k", 2), ("m", 1)}
    box = profile.boxplot_stats(spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 100]], "x double"), "x").first()
    assert (box["whisker_low"], box["whisker_high"], box["n_low"], box["n_high"]) == (1.0, 4.0, 0, 1)


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([(100, 110), (200, 190), (300, 310), (400, 390), (500, 510)], "y long, p long")
    row = evaluate.regression_metrics(df, "y", "p").first()
    assert row["r2"] == pytest.approx(0.995) and row["rmse"] == pytest.approx(10) and row["mae"] == 10
    assert row["residual_mean"] == -2 and row["residual_std"] == pytest.approx(96 ** 0.5)


def test_metrics_edge_cases(spark):
    flat = spark.createDataFrame([(0.1, 0.1)] * 9, "y double, p double").repartition(4)
    row = evaluate.regression_metrics(flat, "y", "p").first()
    assert row["r2"] == 1.0 and row["explained_variance"] == 1.0
    assert evaluate.regression_metrics(flat.withColumn("p", F.lit(0.2)), "y", "p").first()["r2"] == 0.0
    zero = spark.createDataFrame([(0.0, 1.0), (0.0, 2.0)], "y double, p double")
    assert evaluate.regression_metrics(zero, "y", "p").first()["mape"] is None


def checks(df, *built):
    return {r["check_name"]: r for r in quality.run_checks(df, built).collect()}


def test_empty_is_invalid_and_small_claims_valid(spark):
    empty = spark.createDataFrame([], T.StructType([]))
    assert not quality.validation_report(quality.validate_claims(empty)).first()["is_valid"]
    claims = spark.createDataFrame([(100, 50), (200, 100), (300, 150)], "AMT_BILLED long, AMT_PAID long")
    report = quality.validation_report(quality.validate_claims(claims)).first()
    assert report["is_valid"] and report["summary"] == "Validation Report: 5/5 checks passed. Valid: True"
    copies = claims.unionByName(claims).unionByName(claims)
    report = quality.validation_report(quality.validate_claims(copies)).first()
    assert report["failed_checks"] == 1 and report["is_valid"]  # a failed warning does not invalidate
    bad = claims.withColumn("AMT_PAID", F.lit(-1))
    assert not quality.validation_report(quality.validate_claims(bad)).first()["is_valid"]


def test_single_checks(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", 5), (2, "b", 5)], "x int, k string, n int")
    got = checks(
        df,
        quality.check_no_duplicates(df), quality.check_unique_values(df, "k"), quality.check_missing_values(df, 0.3),
        quality.check_data_types(df, {"x": T.NumericType, "k": T.NumericType, "absent": T.StringType}),
        quality.check_value_ranges(df, {"x": (2, 1), "n": (None, 9), "absent": (0, 0)}),
        quality.check_categorical_values(df, "k", ["a"]), quality.check_categorical_values(df, "absent", ["a"]),
    )
    assert got["Duplicate Check"]["message"] == "1 duplicates (33.33%)"
    assert got["Uniqueness Check: k"]["message"] == "Column is not unique: 2/3"
    assert got["Missing Values Check"]["details"]["columns_exceeding"] == "n"
    assert got["Missing Values Check"]["details"]["ratios"] == "n:33.33%"
    assert got["Data Types Check"]["details"] == {"type_issues": "k:string", "expected": "k:NumericType", "rows": "3"}
    assert got["Value Range Check"]["details"] == {"violations": "x:min,x:max", "values": "x:min:1.00 beyond 2.00,x:max:2.00 beyond 1.00"}
    assert got["Categorical Check: k"]["details"]["invalid_values"] == "b"
    assert got["Categorical Check: absent"]["severity"] == "error"
    nulls = spark.createDataFrame([(1,), (None,)], "x int")
    assert not checks(nulls, quality.check_unique_values(nulls, "x"))["Uniqueness Check: x"]["passed"]
    assert checks(df, quality.check_unique_values(df, "k", False))["Uniqueness Check: k"]["passed"]
    with pytest.raises(ValueError):
        quality.check_unique_values(df, "absent")
    none = df.filter("x > 9")
    assert checks(none, quality.check_missing_values(none))["Missing Values Check"]["passed"]
    assert checks(none, quality.check_no_duplicates(none))["Duplicate Check"]["passed"]


def test_fused_checks_scan_once(spark):
    df = spark.range(10).select(F.col("id").alias("AMT_PAID"), F.col("id").alias("AMT_BILLED"))
    plan = quality.run_checks(df, [quality.check_not_empty(df), quality.check_missing_values(df), quality.check_no_negative_values(df, df.columns)])
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("Range (0, 10") == 1


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0, 1), (float("nan"), 2), (None, 3), (3.0, 4)], "x double, y int")
    assert [tuple(r) for r in profile.missing_profile(df).collect()] == [("x", 2, 50.0)]
    row = profile.describe_numeric(df, ["x"]).first()
    assert (row["count"], row["mean"], row["std"], row["min"], row["max"]) == (2, 2.0, 1.41, 1.0, 3.0)
    bins = profile.histogram(df, "x", 2).orderBy("bin").collect()
    assert [(r["lower"], r["upper"], r["n"]) for r in bins] == [(1.0, 2.0, 1), (2.0, 3.0, 1)]
    assert profile.target_stats(df, "x").first()["mean"] == 2.0
    got = checks(df, quality.check_value_ranges(df, {"x": (0, 5)}), quality.check_missing_values(df, 0.4))
    assert got["Value Range Check"]["passed"] and got["Missing Values Check"]["details"]["ratios"] == "x:50.00%"
    assert profile.table_profile(df, "x").first()["mean"] == 2.0
    matrix = profile.correlation_matrix(df, ["x", "y"]).first()
    assert abs(matrix["r"] - 1.0) < 1e-12


def test_distinct_values_by_value(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (None,), (2.0,)], "x double")
    assert profile.distinct_count(df, ["x"]).first()["n_distinct"] == 2


def test_checks_read_their_table(spark):
    df = spark.range(7).select(F.col("id").alias("AMT_PAID"))
    got = checks(df, quality.check_required_columns(df, ["AMT_PAID", "absent"]))
    assert got["Required Columns Check"]["details"]["rows"] == "7"
