import math

import pytest
from pyspark.sql import functions as F

from claimwright.operators import sampling

M = 2147483647


def key(values, seed=42):
    k = seed
    for v in values:
        part = M - 1 if v is None else v % M
        step = ((k + part + 12345) * 1103515245) % M
        k = ((step ^ (step >> 15)) * 16807) % M
    return k


@pytest.fixture(scope="module")
def lines(spark):
    """1000 lines: a third are copies of one row, a third share one key but differ."""
    rows = [(7, 1, 0.5)] * 333 + [(8, 1, float(i)) for i in range(333)] + [(100 + i, i % 5, float(i)) for i in range(334)]
    return spark.createDataFrame(rows, "id bigint, line int, x double").repartition(5).persist()


def brute_split(rows, size):
    ordered = sorted(rows, key=lambda r: (key((r[0], r[1])), r))
    n = math.ceil(len(rows) * size)
    return ordered[:n], ordered[n:]


@pytest.mark.parametrize("tied", [2_000_000, 1])
@pytest.mark.parametrize("size", [0.001, 0.2, 0.37, 0.5, 0.64, 0.9, 1.0])
def test_split_is_exact_under_skew(lines, monkeypatch, tied, size):
    monkeypatch.setattr(sampling, "TIED_ROWS", tied)
    rows = [tuple(r) for r in lines.collect()]
    want_test, want_train = brute_split(rows, size)
    train, test = sampling.train_test_split(lines, size, ["id", "line"])
    assert sorted(map(tuple, test.collect())) == sorted(want_test)
    assert sorted(map(tuple, train.collect())) == sorted(want_train)


def test_split_800_200(spark):
    df = spark.range(1000)
    train, test = sampling.train_test_split(df, 0.2)
    assert (train.count(), test.count()) == (800, 200)
    assert train.intersect(test).count() == 0


def test_split_of_different_rows_is_a_filter(spark):
    """The edge is known, so either side is one pass over the source without a shuffle."""
    df = spark.range(5000).select("id", (F.col("id") % 3).alias("s"), F.when(F.col("id") % 7 > 0, F.col("id") * 0.5).alias("x"))
    for stratum in (None, "s"):
        plan = sampling.tag_test_rows(df, 0.2, ["id"], stratum)._jdf.queryExecution().sparkPlan().toString()
        assert plan.count("Range (") == 1 and "Exchange" not in plan and "Window" not in plan and "Aggregate" not in plan


@pytest.mark.parametrize("inline", [10_000, 1])
def test_strata_with_copies(lines, monkeypatch, inline):
    """Per stratum the rows before the edge, and as many copies of the edge as its quota asks for."""
    monkeypatch.setattr(sampling, "INLINE_STRATA", inline)
    rows = [tuple(r) for r in lines.collect()]
    for size in (0.2, 0.5):
        got = sampling.tag_test_rows(lines, size, ["id", "line"], "line").collect()
        assert sorted(tuple(r)[:3] for r in got) == sorted(rows)
        assert sum(r["is_test"] for r in got) == math.ceil(len(rows) * size)
        for stratum in {r[1] for r in rows}:
            ordered = sorted((r for r in rows if r[1] == stratum), key=lambda r: (key(r[:2]), r))
            picked = sorted(tuple(r)[:3] for r in got if r["line"] == stratum and r["is_test"])
            assert picked == sorted(ordered[: len(picked)])


@pytest.mark.parametrize("inline", [10_000, 1])
def test_stratified_quotas(spark, monkeypatch, inline):
    monkeypatch.setattr(sampling, "INLINE_STRATA", inline)
    df = spark.range(1001).select("id", F.when(F.col("id") < 501, "a").when(F.col("id") < 801, "b").when(F.col("id") < 998, "c").alias("s"))
    tagged = sampling.tag_test_rows(df, 0.25, ["id"], "s")
    got = {r["s"]: (r["n"], r["t"]) for r in tagged.groupBy("s").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect()}
    assert {s: n for s, (n, _) in got.items()} == {"a": 501, "b": 300, "c": 197, None: 3}
    assert sum(t for _, t in got.values()) == math.ceil(1001 * 0.25)
    for n, t in got.values():
        assert abs(t - n * 0.25) < 1


def test_split_with_nulls(spark):
    df = spark.createDataFrame([(None, "x")] * 50 + [(i, None) for i in range(50)], "id bigint, v string")
    train, test = sampling.train_test_split(df, 0.3, ["id"])
    assert (train.count(), test.count()) == (70, 30)


def test_repeat_rows_spreads_large_counts(spark, monkeypatch):
    monkeypatch.setattr(sampling, "COPIES_PER_ROW", 10)
    df = spark.createDataFrame([("a", 37), ("b", 1), ("c", 10)], "k string, n bigint")
    got = {r["k"]: r["count"] for r in sampling.repeat_rows(df, "n").groupBy("k").count().collect()}
    assert got == {"a": 37, "b": 1, "c": 10}


def test_sample_by_key(lines, spark):
    ids = sorted({r[0] for r in lines.select("id").collect()}, key=lambda i: (key((i,)), i))
    for n in (1, 50, 335, 336):
        got = sampling.sample_by_key(lines, "id", n)
        assert {r[0] for r in got.select("id").collect()} == set(ids[:n])
        assert got.count() == lines.filter(F.col("id").isin(ids[:n])).count()
    assert sampling.sample_by_key(lines, "id", 10_000).count() == 1000
    assert sampling.sample_by_key(lines, "id", 0).count() == 0
    texts = spark.createDataFrame([("a", 1), (None, 2), ("b", 3), ("a", 4)], "id string, x int")
    assert sum(sampling.sample_by_key(texts, "id", 2).groupBy("id").count().count() for _ in range(1)) == 2


def test_sample_rows_agrees_on_both_paths(lines, monkeypatch):
    direct = sorted(map(tuple, sampling.sample_rows(lines, 420, ["id", "line"]).collect()))
    monkeypatch.setattr(sampling, "DIRECT_LIMIT", 10)
    assert sorted(map(tuple, sampling.sample_rows(lines, 420, ["id", "line"]).collect())) == direct
    assert sampling.sample_rows(lines, 5000).count() == 1000


def test_folds(lines):
    folds = sampling.k_folds(lines, 3, ["id", "line"])
    assert {(r["id"], r["line"], r["fold"]) for r in folds.collect()} == {
        (r["id"], r["line"], key((r["id"], r["line"])) % 3) for r in lines.collect()
    }


def test_semi_join_with_a_hot_key(lines, spark):
    wanted = spark.createDataFrame([(7,), (7,), (100,), (None,)], "k bigint")
    rows = [tuple(r) for r in lines.collect()]
    got = sampling.semi_join_ids(lines, "id", wanted)
    assert sorted(map(tuple, got.collect())) == sorted(r for r in rows if r[0] in (7, 100))


def test_semi_join_by_list_and_by_frame(lines, spark):
    ids = spark.createDataFrame([(7,), (7,), (101,)], "any bigint")
    assert sampling.semi_join_ids(lines, "id", ids).count() == 334
    assert sampling.semi_join_ids(lines, "id", [7, 101]).count() == 334
    assert sampling.semi_join_ids(lines, "id", []).count() == 0
