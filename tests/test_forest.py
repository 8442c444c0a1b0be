import numpy as np
import pytest
from pyspark.sql import functions as F

from claimwright.operators import forest, models
from claimwright.operators.registry import ModelRegistry

NAMES = ["a", "b", "c"]


def brute(x, y, w, depth=None, least=2):
    """One tree over all features by trying every cut; a function from a row to its value."""
    if depth == 0 or len(y) < least or y.min() == y.max() or not len(y):
        return lambda row, v=np.average(y, weights=w): v
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for a, b in zip(values[:-1], values[1:]):
            left = x[:, f] <= a
            error = sum((w[s] * (y[s] - np.average(y[s], weights=w[s])) ** 2).sum() for s in (left, ~left))
            if best is None or error < best[0] - 1e-9:
                best = (error, f, (a + b) / 2)
    if best is None:
        return lambda row, v=np.average(y, weights=w): v
    _, f, cut = best
    left = x[:, f] <= cut
    deeper = None if depth is None else depth - 1
    low, high = (brute(x[s], y[s], w[s], deeper, least) for s in (left, ~left))
    return lambda row: low(row) if row[f] <= cut else high(row)


def sample(n=400, seed=1):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 6, n), rng.normal(size=n) ** 3])
    return x, 5 * x[:, 0] + x[:, 1] * (x[:, 2] > 0) + rng.normal(size=n)


@pytest.mark.parametrize(("depth", "least"), [(None, 2), (3, 2), (None, 20), (1, 2)])
def test_one_tree_in_memory_equals_brute_force(depth, least):
    x, y = sample()
    w = forest.weights_of(np.arange(len(y)), 3, 42, True)
    got = forest.grow(forest.Ranked(x), y, w, forest.Growth(3, depth, least), 3)
    held = w > 0
    tree = brute(x[held], y[held], w[held], depth, least)
    # rows out of the sample may go another way where cuts of two features are equally good
    assert got.predict(x[held]) == pytest.approx([tree(r) for r in x[held]])


def test_levels_of_many_rows_are_split_in_groups_to_the_same_tree(monkeypatch):
    x, y = sample(3000, 9)
    w = forest.weights_of(np.arange(len(y)), 1, 42, True)
    ranked, growth = forest.Ranked(x), forest.Growth(2, None, 2)
    whole = forest.grow(ranked, y, w, growth, 1)
    sizes, cuts = [], forest.best_cuts
    monkeypatch.setattr(forest, "NEAR_ROWS", 100)
    monkeypatch.setattr(forest, "best_cuts", lambda codes, *rest: sizes.append((codes.shape[1], len(rest[2]))) or cuts(codes, *rest))
    parts = forest.grow(ranked, y, w, growth, 1)
    assert max(rows for rows, nodes in sizes if nodes > 1) <= 200  # a larger node is alone
    assert (parts.feature == whole.feature).all() and (parts.left == whole.left).all() and len(parts.feature) > 2000
    assert parts.threshold == pytest.approx(whole.threshold) and parts.value == pytest.approx(whole.value) and parts.gains == pytest.approx(whole.gains)
    assert (forest.Subtree.of(parts.sealed()).predict(x) == parts.predict(x)).all()


def test_weights_are_poisson_and_repeatable():
    w = forest.weights_of(np.arange(200_000), 5, 42, True)
    assert abs(w.mean() - 1) < 0.01 and abs((w == 0).mean() - np.exp(-1)) < 0.01
    assert (w[1000:2000] == forest.weights_of(np.arange(1000, 2000), 5, 42, True)).all()
    assert abs(np.corrcoef(w, forest.weights_of(np.arange(200_000), 6, 42, True))[0, 1]) < 0.01


@pytest.fixture(scope="module")
def frame(spark):
    x, y = sample(600, 4)
    rows = [(*map(float, r), float(v), i) for i, (r, v) in enumerate(zip(x, y))] + [(0.0, 1.0, 2.0, None, 9999)]
    return spark.createDataFrame(rows, "a double, b double, c double, y double, i int").repartition(3).persist()


def predictions(model, frame):
    return {r["i"]: r["prediction"] for r in model.transform(models.assemble(frame, NAMES)).select("i", "prediction").collect()}


def fitted(frame, **options):
    return forest.RandomForest("y", **options).fit(models.assemble(frame, NAMES))


def test_full_trees_return_the_values_of_distinct_rows(frame, monkeypatch):
    """Without bootstrap a full tree over all features gives every training row its own value."""
    want = {r["i"]: r["y"] for r in frame.where("y is not null").collect()}
    for size in (forest.SUBTREE_BYTES, 60 * 40):  # the second bound of 60 rows needs several scans
        monkeypatch.setattr(forest, "SUBTREE_BYTES", size)
        model = fitted(frame, trees=3, bootstrap=False)
        got = predictions(model, frame)
        assert {i: got[i] for i in want} == pytest.approx(want) and 9999 in got
        assert sum(model.importances) == pytest.approx(1) and max(model.importances) == model.importances[0]
    assert all(len(t.feature) > 1 for t in model.tops) and model.subtrees.count() > 20
    assert model.subtrees.selectExpr("max(nodes)").first()[0] < 2 * 60


def test_first_split_by_scans_equals_the_one_in_memory(frame, monkeypatch):
    """Fewer values than bins, so the binned cut is exact."""
    few = frame.selectExpr("round(a, 1) as a", "b", "round(c) as c", "y", "i")
    exact = fitted(few, trees=1, max_depth=2, bootstrap=False)
    monkeypatch.setattr(forest, "SUBTREE_BYTES", 150 * 40)
    monkeypatch.setattr(forest, "PASS_BYTES", 1)  # one node a scan
    scanned = fitted(few, trees=1, max_depth=2, bootstrap=False)
    assert len(scanned.tops[0].feature) > 1
    assert predictions(scanned, frame) == pytest.approx(predictions(exact, frame))
    assert scanned.importances == pytest.approx(exact.importances)


def test_hot_and_constant_values_end(spark, monkeypatch):
    monkeypatch.setattr(forest, "SUBTREE_BYTES", 20 * 40)
    rows = [(0.0, 1.0, 7.0, float(i % 3), i) for i in range(200)] + [(1e9, 1.0, 7.0, 50.0, 300), (1.0, 1.0, 7.0, 60.0, 301)]
    frame = spark.createDataFrame(rows, "a double, b double, c double, y double, i int")
    got = predictions(fitted(frame, trees=2, bootstrap=False), frame)
    assert got[300] == 50 and got[301] == 60 and got[5] == pytest.approx(sum(i % 3 for i in range(200)) / 200)
    with pytest.raises(ValueError):
        fitted(frame.limit(0), trees=1)


def test_large_nodes_without_a_split_are_leaves_and_send_no_rows(spark, monkeypatch):
    """No task gets more rows than the bound, however many rows are alike or however shallow the trees are."""
    monkeypatch.setattr(forest, "SUBTREE_BYTES", 20 * 40)
    rows = [(float(i % 2), 1.0, 7.0, float(i % 3), i) for i in range(200)] + [(1e9, 1.0, 7.0, 50.0, 300), (5.0, 1.0, 7.0, 60.0, 301)]
    frame = spark.createDataFrame(rows, "a double, b double, c double, y double, i int")
    x = np.array([r[:3] for r in rows])
    for options in ({"bootstrap": False}, {"max_depth": 1}, {"max_depth": 0}):
        model = fitted(frame, trees=3, **options)
        for (tree, node), _ in forest.units_of(model.tops)[0].items():
            assert (forest.descend(x, *model.tops[tree].arrays()) == node).sum() <= 20
        got = predictions(model, frame)
        assert len(got) == len(rows) and all(0 <= v <= 60 for v in got.values())
        if "bootstrap" in options:
            assert got[300] == 50 and got[301] == 60
            assert [got[0], got[1]] == pytest.approx([np.mean([i % 3 for i in range(k, 200, 2)]) for k in (0, 1)])
        if options.get("max_depth") == 0:
            assert len(set(got.values())) == 1


def test_scored_rows_travel_once_per_group_of_trees(frame, monkeypatch):
    want = predictions(fitted(frame, trees=7), frame)
    rows = models.assemble(frame, NAMES).selectExpr("cast(i as long) as row").withColumn("x", F.array(F.lit(1.0), F.lit(2.0), F.lit(3.0)))
    sent = rows.mapInArrow(forest._dealt(3, 4, 2), "slot int, block binary").collect()
    for slot in range(8):
        assert sum(len(forest.unsealed(r["block"])[0]) for r in sent if r["slot"] % 2 == slot % 2) == 4 * sum(len(forest.unsealed(r["block"])[0]) for r in sent if r["slot"] == slot)
    assert sum(len(forest.unsealed(r["block"])[0]) for r in sent) == 4 * 601
    monkeypatch.setattr(forest, "SCORED_TREES", 2)
    monkeypatch.setattr(forest, "SCORED_BYTES", 200 * 24)
    monkeypatch.setattr(forest, "SUBTREE_BYTES", 60 * 40)
    monkeypatch.setattr(forest, "TREES", 3)
    split = fitted(frame, trees=7)
    assert len(split.tops[0].feature) > 1
    got = predictions(split, frame)
    assert got.keys() == want.keys() and np.corrcoef([got[i] for i in want], list(want.values()))[0, 1] > 0.95
    monkeypatch.undo()
    assert predictions(split, frame) == pytest.approx(got)  # in one block, all trees together


def test_a_forest_is_saved_and_loaded(spark, frame, tmp_path):
    train = frame.where("y is not null")
    result = models.train_model("random_forest", train, train, NAMES, "y", {"n_estimators": 20, "max_depth": None, "min_samples_split": 5}, "1")
    assert result.scores["validation"]["r2"] > 0.8 and max(result.importances, key=result.importances.get) == "a"
    registry = ModelRegistry(spark, str(tmp_path))
    registry.save(result, "forest")
    loaded = registry.load("forest")
    want, got = ({r["i"]: r["prediction"] for r in m.transform(frame).collect()} for m in (result.model, loaded))
    assert got == pytest.approx(want)
