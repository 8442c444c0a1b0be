"""Boosted trees over binned rows against MLlib's trees, and how much work they are."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
from pyspark.sql import functions as F

from claimwright.operators import boost, models
from claimwright.operators.registry import ModelRegistry

NAMES = ["f1", "f2", "f3"]


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(7)
    x = np.c_[rng.normal(size=(900, 2)), rng.integers(-2, 4, 900)]
    frame = pd.DataFrame(x, columns=NAMES).assign(y=100 + 20 * x[:, 0] + 9 * x[:, 1] * x[:, 2] + rng.normal(size=900), i=range(900))
    return models.assemble(spark.createDataFrame(frame).repartition(3), NAMES).persist()


def predicted(model, df):
    return [r[0] for r in model.transform(df).orderBy("i").select("prediction").collect()]


def jobs(spark, body):
    """How many Spark jobs ``body`` takes."""
    spark.sparkContext.setJobGroup("counted", "counted")
    try:
        before = len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
        body()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted")) - before
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("leaf", [1, 20])
def test_gradient_boosting_matches_mllib(vectors, leaf):
    ours = boost.GradientBoosting("y", 12, 0.3, 4, leaf, checkpoint_every=5).fit(vectors)
    theirs = GBTRegressor(labelCol="y", maxIter=12, maxDepth=4, stepSize=0.3, minInstancesPerNode=leaf, seed=42).fit(vectors)
    assert predicted(ours, vectors) == pytest.approx(predicted(theirs, vectors))
    assert ours.importances() == pytest.approx(theirs.featureImportances.toArray().tolist())


def test_gradient_boosting_takes_one_job_a_level(spark, vectors):
    assert jobs(spark, lambda: models.fit_regressor("gradient_boosting", vectors, "y", {"n_estimators": 20, "max_depth": 2})) <= 20 * 2 + 20


def test_rows_of_equal_bins_are_one_row_with_their_number_and_mean(spark, monkeypatch):
    rng = np.random.default_rng(3)
    frame = pd.DataFrame({"a": rng.integers(0, 6, 4000) * 1.0, "b": rng.integers(0, 5, 4000) * 1.0, "y": rng.normal(1e6, 3, 4000), "i": range(4000)})
    rows = models.assemble(spark.createDataFrame(frame).repartition(2), ["a", "b"])
    counted = []
    merged = boost.merged_rows
    monkeypatch.setattr(boost, "merged_rows", lambda *a: counted.append([len(y) for _, y, _ in boost.arrays_of(merged(*a).toArrow().to_batches(), np.uint8)]) or merged(*a))
    want = frame.groupby(["a", "b"]).y.mean()
    for most in (boost.MERGED_ROWS, 7):  # with more keys than a task holds, rows stay in pieces
        monkeypatch.setattr(boost, "MERGED_ROWS", most)
        got = boost.GradientBoosting("y", 1, 0.1, 9).fit(rows).transform(rows).select("a", "b", "prediction").distinct().collect()
        assert {(r["a"], r["b"]): r["prediction"] for r in got} == pytest.approx(want.to_dict(), rel=1e-12) and len(got) == 30
    assert all(30 <= sum(c) <= 30 * 2 for c in counted) and len(counted) == 2


def test_rows_of_one_partition_are_spread(spark, monkeypatch):
    rows = spark.range(0, 80_000, 1, 1).selectExpr("id % 17 * 1.0D as f", "id % 31 * 1.0D as y")
    seen = []
    persist = type(rows).persist
    monkeypatch.setattr(type(rows), "persist", lambda df, *a: seen.append(df.rdd.getNumPartitions()) or persist(df, *a))
    models.fit_regressor("gradient_boosting", models.assemble(rows, ["f"]), "y", {"n_estimators": 2})
    assert seen and min(seen) >= 3  # blocks of 2^15 rows at least


def test_adaboost_takes_two_jobs_a_round_besides_its_levels(spark, vectors):
    assert jobs(spark, lambda: boost.AdaBoostR2("y", rounds=12, max_depth=2, checkpoint_every=100).fit(vectors)) <= 12 * 4 + 20


def test_features_of_many_values_are_cut_by_quantiles_of_all_rows(vectors, monkeypatch):
    monkeypatch.setattr(boost, "EXACT", 50)
    cells = boost.cells_of(vectors.select(boost.vector_to_array("features").alias("x")), 3)
    assert cells.exact == [False, False, True] and len(cells.values[0]) > 400
    exact = predicted(GBTRegressor(labelCol="y", maxIter=8, maxDepth=3, seed=42).fit(vectors), vectors)
    rough = predicted(boost.GradientBoosting("y", 8, 0.1, 3).fit(vectors), vectors)
    assert np.corrcoef(exact, rough)[0, 1] > 0.99


def test_deep_levels_may_take_several_scans(vectors, monkeypatch):
    whole = boost.GradientBoosting("y", 2, 0.1, 12).fit(vectors)
    monkeypatch.setattr(boost, "SUM_BYTES", 24 * 3 * boost.BINS * 3)  # three nodes a scan
    assert predicted(boost.GradientBoosting("y", 2, 0.1, 12).fit(vectors), vectors) == predicted(whole, vectors)


def test_odd_labels_and_values(spark, vectors):
    with pytest.raises(ValueError):
        boost.GradientBoosting("y").fit(vectors.withColumn("y", F.when(F.col("i") > 3, F.col("y"))))
    with pytest.raises(ValueError):
        boost.AdaBoostR2("y").fit(vectors.where("false"))
    constant = vectors.withColumn("y", F.lit(0.1))
    model = boost.GradientBoosting("y", 3).fit(constant)
    assert [len(t.feature) for t in model.trees] == [1, 1, 1] and predicted(model, constant)[0] == pytest.approx(0.1)
    stump = boost.GradientBoosting("y", 1, 0.1, 0).fit(vectors)
    assert predicted(stump, vectors)[0] == pytest.approx(vectors.agg(F.avg("y")).first()[0])
    few = vectors.where("i < 3").withColumn("y", F.col("i").cast("double"))
    tree = DecisionTreeRegressor(labelCol="y", maxDepth=3).fit(few)
    assert predicted(boost.GradientBoosting("y", 1, 0.1, 3).fit(few), few) == predicted(tree, few)


def test_boosted_models_come_back_from_the_registry(spark, vectors, tmp_path):
    registry = ModelRegistry(spark, str(tmp_path / "registry"))
    df = vectors.drop("features")
    for kind in ("gradient_boosting", "adaboost"):
        result = models.train_model(kind, df, df, NAMES, "y", {"n_estimators": 3}, "1")
        registry.save(result, kind)
        loaded = registry.load(kind)
        assert predicted(loaded, df) == predicted(result.model, df)
        assert models.importances_of(loaded.regressor, NAMES) == result.importances


def test_small_trees_descend_as_large_ones_do(monkeypatch):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3, 500))
    trees = [boost.Tree([0, 1, -1, 2, -1, -1, -1], [rng.normal(), rng.normal(), 0.0, rng.normal(), 0.0, 0.0, 0.0], [1, 3, 0, 5, 0, 0, 0], list(rng.integers(0, 4, 7) * 1.0), [], 3) for _ in range(30)]
    trees.append(boost.Tree())
    flat, weights, taken = boost.FlatTrees.of(trees), rng.random(31), []
    plain = np.stack([[t.value[walk(t, row)] for row in x.T] for t in trees])
    monkeypatch.setattr(flat, "scored", lambda x, kind, merge, each=None: taken.append(merge((each or flat.each)(x), x.shape[1]).to_numpy()))
    for most in (boost.SMALL, 0):
        monkeypatch.setattr(boost, "SMALL", most)
        assert (np.stack(list(flat.each(x))) == plain).all()
        flat.medians(x, weights)
        order = np.argsort(plain, axis=0, kind="stable")
        first = (np.cumsum(weights[order], axis=0) >= sum(weights) / 2).argmax(axis=0)
        assert (taken.pop() == np.take_along_axis(plain, np.take_along_axis(order, first[None], axis=0), axis=0)[0]).all()


def walk(tree, row):
    node = 0
    while tree.feature[node] >= 0:
        node = tree.left[node] + (row[tree.feature[node]] > tree.threshold[node])
    return node


def test_adaboost_takes_one_job_a_round_besides_its_deeper_levels_and_loss(spark, vectors):
    """The root's sums come with those of the cells."""
    assert jobs(spark, lambda: boost.AdaBoostR2("y", rounds=12, max_depth=2, checkpoint_every=100).fit(vectors)) <= 12 * 4 + 12
