import pytest
from pyspark.errors import NumberFormatException
from pyspark.sql import functions as F

from claimwright.functions import columns as fx
from claimwright.operators import clean
from claimwright.plans.claims import clean_claims

NAN = float("nan")


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_missing_means_null_or_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (NAN, "b"), (None, "c"), (-1.0, "d")], "x double, k string")
    assert rows(fx.nan_to_null(df), "k") == [(1.0, "a"), (None, "b"), (None, "c"), (-1.0, "d")]
    assert rows(clean.filter_non_negative(df, ["x", "absent"])) == [(1.0, "a")]
    assert rows(clean.drop_missing_rows(df), "k") == [(1.0, "a"), (-1.0, "d")]
    assert rows(clean.drop_missing_rows(df, ["k"]), "k")[0][1] == "a"


def test_absent_columns_are_a_no_op(spark):
    df = spark.createDataFrame([(1,)], "x int")
    for out in (
        clean.drop_columns(df, ["y"]), clean.fill_missing(df, {"y": 0}), clean.encode_gender(df), clean.encode_age(df),
        clean.code_category(df, "y", "z"), clean.count_non_null(df), clean.merge_categories(df, "y"),
    ):
        assert out.columns == ["x"]


def test_drop_high_missing_counts_strictly_and_zero_is_a_threshold(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, 5), (3, 1, 6)], "a int, b int, c int")
    assert clean.drop_high_missing(df, 1)[1] == ["b"]
    assert clean.drop_high_missing(df, 2)[1] == []
    assert clean.drop_high_missing(df, 0, ["b"])[1] == ["c"]
    many = df.crossJoin(spark.range(100)).drop("id")
    assert clean.drop_high_missing(many)[1] == clean.drop_high_missing(df)[1]  # the default is a share of the rows


def test_encoders(spark):
    df = spark.createDataFrame([("M", "90+", "W01"), (None, "45", None), ("F", None, "401")], "SEX string, AGE string, ICD string")
    assert [r[0] for r in clean.encode_gender(df).select("Gender_Code").collect()] == [1, 0, 0]
    assert [r[0] for r in clean.encode_age(df).select("Age").collect()] == [90, 45, None]
    letters = clean.code_category(df, "ICD", "L")
    assert [r[0] for r in letters.select("L").collect()] == ["W", "U", "4"]
    assert [r[0] for r in clean.merge_categories(letters, "L").select("L").collect()] == ["V", "U", "num"]
    bad = spark.createDataFrame([("x",)], "AGE string")
    assert clean.encode_age(bad, strict=False).collect()[0][0] is None
    with pytest.raises(NumberFormatException):
        clean.encode_age(bad).collect()


def test_merge_map_applies_in_order():
    assert fx.closed_map({"a": "b", "b": "c"}) == {"a": "c", "b": "c"}
    assert fx.closed_map({"b": "c", "a": "b"}) == {"b": "c", "a": "b"}


def test_merge_categories_keeps_null(spark):
    df = spark.createDataFrame([("a",), (None,), ("12",), ("1x",)], "k string")
    assert [r[0] for r in clean.merge_categories(df, "k", {}).collect()] == ["a", None, "num", "1x"]


def test_dedup(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (1, 2, "b"), (2, 9, None), (None, 4, "n"), (None, 5, "m")], "k int, t int, v string")
    assert rows(clean.dedup_keep(df, ["k"], "first", ["t"]), "k") == [(None, 4, "n"), (1, 1, "a"), (2, 9, None)]
    assert rows(clean.dedup_keep(df, ["k"], "last", ["t"]), "k") == [(None, 5, "m"), (1, 3, "c"), (2, 9, None)]
    assert rows(clean.dedup_keep(df, ["k"], False)) == [(2, 9, None)]
    copies = df.unionByName(df.filter("k = 2"))
    assert copies.transform(clean.dedup_keep).count() == 6
    assert clean.dedup_keep(copies, keep=False).count() == 5
    with pytest.raises(ValueError):
        clean.dedup_keep(df, ["absent"])
    with pytest.raises(ValueError):
        clean.dedup_keep(df, ["k"], "middle")


def test_required_columns(spark):
    df = spark.createDataFrame([(1,)], "x int")
    assert clean.require_columns(df, ["x"]) is df
    with pytest.raises(ValueError, match="y"):
        clean.require_columns(df, ["x", "y"])
    with pytest.raises(ValueError):
        clean.split_features_target(df, "y")


def test_safe_divide(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (None, 1.0)], "a double, b double")
    assert [r[0] for r in df.select(fx.safe_divide(F.col("a"), F.col("b"), 9.0)).collect()] == [0.5, 9.0, None]


def test_clean_claims_is_one_stage_after_the_null_counts(spark):
    df = spark.createDataFrame(
        [("M", "90+", "99213", "W01", None, 10.0, 5.0, 0.0, 0.0), ("F", "30", None, None, 2, 10.0, -5.0, 0.0, 0.0)],
        "SEX string, AGE string, PROC_CODE string, ICD_DIAG_01_PRIMARY string, CLIENT_LOS int, AMT_BILLED double, AMT_PAID double, "
        "AMT_DEDUCT double, AMT_COINS double",
    )
    out = clean_claims(df)
    assert out.count() == 1
    row = out.first().asDict()
    assert row["Age"] == 90 and row["Gender_Code"] == 1 and row["Num_diag"] == 1 and row["CLIENT_LOS"] == 0
    assert row["ICD_DIAG_01_PRIMARY_categories"] == "V" and "Proc_Code_letters" not in row
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
