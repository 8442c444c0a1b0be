import numpy as np
import pytest
from pyspark.sql import functions as F

from claimwright.operators import quantiles
from claimwright.operators.quantiles import exact_percentiles

SHARES = [0.0, 0.01, 0.25, 0.333, 0.5, 0.75, 0.9, 0.999, 1.0]


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of column a is one value; b is heavy-tailed; c has nulls and NaN; d is constant."""
    rng = np.random.default_rng(7)
    n = 20_000
    a = np.where(rng.random(n) < 0.34, 5.0, rng.normal(5, 3, n))
    b = np.exp(rng.normal(0, 6, n))
    c = [None if x < 0.1 else (float("nan") if x < 0.15 else float(x)) for x in rng.random(n)]
    rows = [(float(x), float(y), z, 2.5) for x, y, z in zip(a, b, c)]
    return spark.createDataFrame(rows, "a double, b double, c double, d double").persist()


def expected(df, column):
    values = [r[0] for r in df.select(column).collect()]
    return np.quantile([v for v in values if v is not None and v == v], SHARES).tolist()


@pytest.mark.parametrize("leaf", [250_000, 500, 20])
def test_matches_numpy_on_all_paths(skewed, monkeypatch, leaf):
    monkeypatch.setattr(quantiles, "LEAF_ROWS", leaf)
    found = exact_percentiles(skewed, {c: SHARES for c in "abcd"})
    for c in "abcd":
        assert found[c] == pytest.approx(expected(skewed, c), rel=1e-13), c


def test_hot_value_edge_is_exact(skewed):
    assert exact_percentiles(skewed, {"a": [0.5]})["a"][0] == 5.0


def test_empty_and_single(spark):
    empty = spark.createDataFrame([], "x double")
    assert exact_percentiles(empty, {"x": [0.5]}) == {"x": [None]}
    one = spark.range(1).select(F.lit(3).alias("x"))
    assert exact_percentiles(one, {"x": [0.1, 0.9]}) == {"x": [3.0, 3.0]}


def test_two_scans_for_any_number_of_shares(skewed, spark, monkeypatch):
    """The sketch scan and the listing; a leaf smaller than what the sketch leaves open takes one more of each kind at most."""
    shares = [i / 400 for i in range(401)]
    for leaf, scans in ((1_000_000, 2), (200, 4)):
        monkeypatch.setattr(quantiles, "LEAF_ROWS", leaf)
        made = []
        for name in ("_intervals", "_listed"):
            body = getattr(quantiles, name)
            monkeypatch.setattr(quantiles, name, lambda *a, body=body: made.append(1) or body(*a))
        found = exact_percentiles(skewed, {"a": shares, "b": shares})
        assert len(made) <= scans
        for c in "ab":
            values = [r[0] for r in skewed.select(c).collect()]
            assert found[c] == pytest.approx(np.quantile(values, shares).tolist(), rel=1e-13)


def test_infinities_and_signed_zeros(spark):
    df = spark.createDataFrame([(float("inf"),), (float("-inf"),), (0.0,), (-0.0,), (1.0,)] * 3, "x double")
    assert exact_percentiles(df, {"x": [0.0, 0.5, 1.0]})["x"] == [float("-inf"), 0.0, float("inf")]
