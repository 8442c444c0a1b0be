"""Importances from sums by combination of bins, against scans of the rows and MLlib's forest."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.regression import RandomForestRegressor

from claimwright.operators import bagged, models

NAMES = ["a", "b", "c"]


def test_importances_equal_scans_and_are_near_mllib(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = np.c_[rng.integers(0, 9, 4000), rng.integers(0, 7, 4000), rng.integers(0, 3, 4000)].astype(float)
    frame = pd.DataFrame(x, columns=NAMES).assign(y=3 * x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(size=4000))
    vectors = models.assemble(spark.createDataFrame(frame).repartition(2), NAMES).persist()
    forest = bagged.BaggedTrees("y", 12, 4)
    scanned = []
    scan = bagged.grow
    monkeypatch.setattr(bagged, "grow", lambda *a: scanned.append(1) or scan(*a))
    summed = forest.importances(vectors)
    assert not scanned  # all trees from one scan
    monkeypatch.setattr(bagged, "TABLE_BYTES", 16 * 12 * 50)  # a task's sums leave it in pieces
    assert forest.importances(vectors) == pytest.approx(summed, rel=1e-9)
    theirs = RandomForestRegressor(labelCol="y", numTrees=12, maxDepth=4, featureSubsetStrategy="all", seed=1).fit(vectors).featureImportances.toArray()
    assert summed == pytest.approx(theirs, abs=0.02) and sum(summed) == pytest.approx(1)
    monkeypatch.setattr(bagged, "AGREEING", 10_000)
    few = bagged.BaggedTrees("y", 2, 3)
    by_rows = few.importances(vectors)
    monkeypatch.setattr(bagged, "AGREEING", 1)
    assert len(scanned) == 2 and by_rows == pytest.approx(few.importances(vectors), rel=1e-9)
    vectors.unpersist()
