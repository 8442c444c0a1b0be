import math

import numpy as np
import pytest

from claimwright.operators import neighbours, select


def psi(n):
    return -0.5772156649015329 + sum(1 / i for i in range(1, int(n)))


def brute(x, y, k=3):
    """The estimator from all distances, over the same integer coordinates."""
    both = np.isfinite(x) & np.isfinite(y)
    x, y = (np.rint(v[both] / neighbours.unit(v[both].std()) * neighbours.STEPS).astype(np.int64) for v in (x, y))
    if len(x) <= k:
        return None
    dx, dy = np.abs(x[:, None] - x), np.abs(y[:, None] - y)
    far = np.maximum(dx, dy)
    np.fill_diagonal(far, 2**62)
    r = np.sort(far, axis=1)[:, k - 1]
    reach = np.maximum(r - 1, 0)[:, None]
    nx, ny = (dx <= reach).sum(axis=1), (dy <= reach).sum(axis=1)
    return max(0.0, psi(len(x)) + psi(k) - np.mean([psi(a) + psi(b) for a, b in zip(nx, ny)]))


def sample(n=2000, seed=2):
    rng = np.random.default_rng(seed)
    a = rng.normal(size=n)
    return {
        "a": a, "b": rng.normal(size=n), "few": rng.integers(0, 7, n).astype(float), "one": np.full(n, 4.0), "holes": np.where(rng.random(n) < 0.3, np.nan, a**2),
        "hot": np.where(rng.random(n) < 0.5, 1.0, a), "rare": np.where(np.arange(n) < 3, a, np.nan), "y": np.where(rng.random(n) < 0.1, 0.0, a + 0.5 * rng.normal(size=n)),
    }


@pytest.mark.parametrize("cell", [50_000, 150])
def test_equals_brute_force(spark, cell):
    columns = sample()
    names = list(columns)
    rows = [tuple(None if math.isnan(v) else float(v) for v in r) for r in zip(*columns.values())]
    frame = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(3)
    got = {r["feature"]: r["mi"] for r in neighbours.neighbour_information(frame, "y", cell=cell).collect()}
    want = {n: brute(columns[n], columns["y"]) for n in names if n != "y"}
    assert got.pop("rare") is None and want.pop("rare") is None
    assert got == pytest.approx(want, abs=1e-9) and got["a"] > 0.5 > got["b"]
    if cell < 1000:
        best = select.select_k_best_mi(frame, "y", 2)
        assert select.selected(frame, "y", best).columns == [n for n in names if n in {r["feature"] for r in best.collect()} or n == "y"]


def test_neighbours_of_few_points():
    x = np.array([0, 0, 10, 30])
    got = neighbours.kth_distances(x, x * 0, x, x * 0, 3)
    assert got.tolist() == [[0, 0, 10], [0, 0, 10], [0, 10, 10], [0, 20, 30]]
    assert (neighbours.kth_distances(x, x, x[:0], x[:0], 2) == neighbours.FAR).all()


def test_empty(spark):
    frame = spark.createDataFrame([], "a double, y double")
    assert [tuple(r) for r in neighbours.neighbour_information(frame, "y").collect()] == [("a", None)]
    assert neighbours.neighbour_information(frame, "y", ["y"]).count() == 0
