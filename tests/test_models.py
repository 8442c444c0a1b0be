import numpy as np
import pandas as pd
import pytest
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from claimwright.operators import evaluate, linear, models, sampling, scoring, tuning
from claimwright.operators.registry import ModelRegistry
from claimwright.plans import workflows

NAMES = ["f1", "f2", "f3"]


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(42)
    x = rng.normal(size=(1000, 3))
    y = 100 + 20 * x[:, 0] + 10 * x[:, 1] + 5 * rng.normal(size=1000)
    return pd.DataFrame(x, columns=NAMES).assign(y=y)


@pytest.fixture(scope="module")
def df(spark, frame):
    return spark.createDataFrame(frame).repartition(4).persist()


@pytest.fixture(scope="module")
def split(df):
    train, held_out = sampling.train_test_split(df, 0.2)
    return train.persist(), held_out.persist()


def descend(x, y, l1, l2, rounds=3000):
    """Coordinate descent on mean squared error / 2 + l1 |w| + l2 w^2 / 2, with an intercept."""
    x, y = x - x.mean(0), y - y.mean()
    w, n = np.zeros(x.shape[1]), len(y)
    for _ in range(rounds):
        for j in range(len(w)):
            rho = x[:, j] @ (y - x @ w + x[:, j] * w[j]) / n
            w[j] = np.sign(rho) * max(abs(rho) - l1, 0) / (x[:, j] @ x[:, j] / n + l2)
    return w


@pytest.mark.parametrize(
    "kind,params,l1,l2",
    [("lasso", {"alpha": 2.0}, 2.0, 0.0), ("ridge", {"alpha": 50.0}, 0.0, 50.0 / 1000), ("elasticnet", {"alpha": 1.0, "l1_ratio": 0.3}, 0.3, 0.7)],
)
def test_linear_models_match_coordinate_descent(df, frame, kind, params, l1, l2):
    result = models.train_model(kind, df, df, NAMES, "y", params, "1")
    want = descend(frame[NAMES].to_numpy(), frame.y.to_numpy(), l1, l2)
    assert result.model.regressor.coefficients.toArray() == pytest.approx(want, abs=1e-5)
    assert list(result.importances.values()) == pytest.approx(np.abs(want), abs=1e-5)


def test_split_and_metrics(split):
    train, held_out = split
    assert (train.count(), held_out.count()) == (800, 200)
    result = models.train_model("lasso", train, held_out, NAMES, "y", version="v1")
    assert result.scores["validation"]["r2"] > 0.9 and result.rows == 800
    metrics, scored = evaluate.evaluate_model(result.model, held_out, "y")
    assert metrics.first()["r2"] == pytest.approx(result.scores["validation"]["r2"])
    assert scored.count() == 200


def test_forest_and_boosting(split):
    train, held_out = split
    forest = models.train_model("random_forest", train, held_out, NAMES, "y", {"n_estimators": 10, "max_depth": None, "min_samples_split": 5})
    assert set(forest.importances) == set(NAMES) and max(forest.importances, key=forest.importances.get) == "f1"
    boosted = models.train_model("gradient_boosting", train, held_out, NAMES, "y", {"n_estimators": 15, "max_depth": 3, "learning_rate": 0.3})
    assert boosted.scores["validation"]["r2"] > 0.7


def brute_boost(x, y, fit, rounds, rate):
    """AdaBoost.R2 with linear loss, weights used directly; a small in-memory check."""
    w, learners, votes = np.ones(len(y)), [], []
    for i in range(rounds):
        predict = fit(w, i)
        e = np.abs(predict - y)
        loss = (w * e / e.max()).sum() / w.sum()
        if loss >= 0.5:
            break
        beta = loss / (1 - loss)
        learners.append(predict)
        votes.append(rate * np.log(1 / beta))
        w = w * beta ** ((1 - e / e.max()) * rate)
    p, v = np.array(learners), np.array(votes)
    order = np.argsort(p, axis=0)
    reached = np.cumsum(v[order], axis=0) >= v.sum() / 2
    pick = order[reached.argmax(axis=0), np.arange(len(y))]
    return p[pick, np.arange(len(y))], votes


def test_adaboost_matches_brute_force(spark, frame):
    small = frame.head(200).assign(i=range(200))
    df = models.assemble(spark.createDataFrame(small), NAMES).persist()
    model = models.AdaBoostR2("y", rounds=6, learning_rate=0.7, max_depth=2, checkpoint_every=2).fit(df)

    def fit(w, i):
        weighted = spark.createDataFrame(small.assign(w=w))
        tree = DecisionTreeRegressor(labelCol="y", weightCol="w", maxDepth=2, seed=42 + i).fit(models.assemble(weighted, NAMES))
        return np.array([r[0] for r in tree.transform(df).orderBy("i").select("prediction").collect()])

    want, votes = brute_boost(None, small.y.to_numpy(), fit, 6, 0.7)
    assert model.weights == pytest.approx(votes)
    got = [r[0] for r in model.transform(df).orderBy("i").select("prediction").collect()]
    assert got == pytest.approx(want.tolist())


def test_boosted_trees_score_in_one_projection(df):
    vectors = models.assemble(df, NAMES)
    model = models.AdaBoostR2("y", rounds=12).fit(vectors)
    scored = model.transform(vectors)
    assert scored._jdf.queryExecution().optimizedPlan().toString().count("Project") <= 2
    one = vectors
    for i, tree in enumerate(model.trees):
        one = tree.copy({tree.predictionCol: f"p{i}"}).transform(one)
    rows = one.withColumn("all", models.FlatTrees.of(model.trees).predictions(models.vector_to_array("features"))).collect()
    assert all(r["all"] == [r[f"p{i}"] for i in range(len(model.trees))] for r in rows)


def test_adaboost_perfect_fit_stops(spark):
    df = models.assemble(spark.createDataFrame([(float(i % 2), float(i % 2)) for i in range(40)], "f double, y double"), ["f"])
    model = models.AdaBoostR2("y", rounds=5).fit(df)
    assert len(model.trees) == 1 and model.transform(df).filter("prediction = y").count() == 40


def test_train_all_shows_failures_and_best(spark, split, caplog):
    train, held_out = split
    results = models.train_all(train, held_out, NAMES, "y", ["lasso", "nonsense", "ridge"], {"lasso": {"alpha": 30.0}})
    assert results["nonsense"].model is None and "unknown model type" in results["nonsense"].error
    assert models.best_result(results) is results["ridge"]
    table = models.metrics_table(spark, results)
    assert models.best_model(table).first()["model"] == "ridge"
    assert {r["model"]: r["error"] is None for r in table.collect()} == {"lasso": True, "nonsense": False, "ridge": True}
    assert models.best_result({}) is None
    with pytest.raises(ValueError):
        models.train_model("nonsense", train, held_out, NAMES, "y")
    ranked = evaluate.compare_models({k: r.model for k, r in results.items() if r.model}, held_out, "y").collect()
    assert [r["model"] for r in ranked] == ["ridge", "lasso"]


def test_tuning(df):
    best, score, points = tuning.tune_grid("ridge", df, NAMES, "y", {"alpha": [0.1, 1e5]}, cv=3)
    assert best == {"alpha": 0.1} and score > 0.9 and len(points) == 2
    assert tuning.tune("adaboost", df, NAMES, "y") == ({}, 0.0, [])
    assert len(tuning.grid_points(models.GRIDS["random_forest"])) == 72
    assert tuning.grid_points({"a": [1, 2, 3]}, 2, seed=1) == tuning.grid_points({"a": [1, 2, 3]}, 2, seed=1)
    scores = tuning.cross_validate("lasso", df, NAMES, "y", cv=4)
    assert len(scores["scores"]) == 4 and scores["std_r2"] == pytest.approx(np.std(scores["scores"]))


def test_registry(spark, split, tmp_path):
    train, held_out = split
    registry = ModelRegistry(spark, str(tmp_path / "registry"))
    assert registry.production() is None and registry.list_models().count() == 0
    with pytest.raises(ValueError):
        registry.load("paid")
    first = models.train_model("ridge", train, held_out, NAMES, "y", {"alpha": 500.0}, "1")
    second = models.train_model("adaboost", train, held_out, NAMES, "y", {"n_estimators": 3}, "2")
    registry.save(first, "paid")
    registry.save(second, "paid")
    row = registry.list_models().first()
    assert row["versions"] == ["1", "2"] and row["latest"] == "2"
    saved = {(r["version"], r["side"], r["metric"]): r["value"] for r in registry.metrics().collect()}
    assert saved["1", "validation", "r2"] == first.scores["validation"]["r2"] and len(saved) == 12
    registry.promote("paid", "1")
    model, version = registry.production()
    assert version == "1" and model.feature_names == NAMES and model.state is None
    want = [r[0] for r in first.model.transform(held_out).orderBy("f1").select("prediction").collect()]
    assert [r[0] for r in model.transform(held_out).orderBy("f1").select("prediction").collect()] == want
    assert registry.load("paid").regressor.weights == second.model.regressor.weights
    with pytest.raises(ValueError):
        registry.promote("paid", "9")
    with pytest.raises(ValueError):
        registry.save(models.TrainingResult("ridge", "3", error="lost"), "paid")


def test_a_model_keeps_its_fitted_features(spark, split, tmp_path):
    """Raw rows with a category go through the vocabulary and scalers that were saved with the model."""
    train, held_out = (s.withColumn("kind", F.when(F.col("f3") > 0, "up").otherwise("down")) for s in split)
    registry = ModelRegistry(spark, str(tmp_path / "registry"))
    done = workflows.train(train, registry, "y", ["kind"], ["f1", "f2"], ["ridge", "lasso"], version="7")
    assert done.version == "7" and done.model.state.vocabulary == {"kind": ["down", "up"]}
    assert [s.column for s in done.model.state.scalers] == ["f1", "f2"] and done.metrics.first()["r2"] > 0.9
    unseen = held_out.withColumn("kind", F.lit("sideways"))
    scored = done.model.transform(unseen)
    assert scored.columns == [*unseen.columns, "prediction"] and scored.where("prediction is null").isEmpty()
    with pytest.raises(ValueError):
        done.model.transform(held_out.drop("kind"))


def test_moments_add_up(spark):
    rng = np.random.default_rng(5)
    z = rng.normal(size=(300, 4)) + [1e6, 0, -5, 1e4]
    parts = [linear.Moments.of(z[:0]), linear.Moments.of(z[:7]), linear.Moments.of(z[7:])]
    total = linear.merged(parts, 4)
    assert total.n == 300 and total.products == pytest.approx(np.cov(z.T, ddof=0) * 300, rel=1e-6, abs=1e-6)
    assert linear.merged([], 4).n == 0 and linear.r2((np.zeros(3), 0.0), linear.merged([], 4)) is None


def test_one_scan_equals_separate_fits(spark, df, frame):
    """Folds, points and shares from moments against fits of the rows themselves."""
    keyed = df.withColumn("i", F.monotonically_increasing_id()).persist()
    points = [{"alpha": a} for a in (5.0, 0.01, 20.0)]
    got = tuning._scores("lasso", keyed, NAMES, "y", 3, points, 42, 2, ["i"])
    folds = sampling.k_folds(keyed, 3, ["i"], 42).toPandas()
    for point, scores in zip(points, got):
        for fold, score in enumerate(scores):
            train, test = folds[folds.fold != fold], folds[folds.fold == fold]
            w = descend(train[NAMES].to_numpy(), train.y.to_numpy(), point["alpha"], 0.0)
            left = test.y - test[NAMES].to_numpy() @ w - (train.y.mean() - train[NAMES].mean().to_numpy() @ w)
            assert score == pytest.approx(1 - (left**2).mean() / test.y.var(ddof=0), abs=1e-8)
    curve = tuning.learning_curve("ridge", keyed, NAMES, "y", [0.2, 1.0], 3, fold_keys=["i"]).toPandas()
    assert len(curve) == 6 and (curve.train_rows[curve.share == 1].sum() == 2000) and curve.train_rows[curve.share == 0.2].between(80, 190).all()
    whole = tuning.cross_validate("ridge", keyed, NAMES, "y", 3, fold_keys=["i"])["scores"]
    assert curve[curve.share == 1].sort_values("fold").validation.tolist() == pytest.approx(whole)
    deep = tuning.learning_curve("random_forest", keyed, NAMES, "y", [1.0], 2, {"n_estimators": 4, "max_depth": 3}, fold_keys=["i"]).toPandas()
    assert (deep.train > deep.validation).all() and (deep.validation > 0.5).all()


def test_empty_folds_have_no_score(spark):
    rows = spark.createDataFrame([(1.0, 2.0, 1)] * 40, "f double, y double, i int")
    for kind in ("ridge", "random_forest"):
        found = tuning.cross_validate(kind, rows, ["f"], "y", 3, {"n_estimators": 2} if kind == "random_forest" else None, fold_keys=["i"])
        assert found == {"mean_r2": None, "std_r2": None, "scores": [None] * 3}
    assert tuning.tune_grid("ridge", rows, ["f"], "y", cv=3, fold_keys=["i"])[1] is None


def test_training_cache_fills_all_cores(spark, df):
    lopsided = df.filter("f1 > 100").unionByName(df.coalesce(1))
    cached = models.training_cache(lopsided)
    sizes = [r["count"] for r in cached.groupBy(F.spark_partition_id()).count().collect()]
    assert cached.count() == 1000 and len(sizes) == spark.sparkContext.defaultParallelism and max(sizes) <= 300


def test_intervals(spark):
    rows = spark.createDataFrame([(100.0,), (-5.0,), (None,)], "prediction double")
    a, b, c = scoring.with_interval(rows, model_version="v").collect()
    assert float(a["predicted_amount"]) == 100 and float(a["confidence_interval"]["lower"]) == 70.6
    assert float(a["confidence_interval"]["upper"]) == 129.4 and a["model_version"] == "v"
    assert float(b["predicted_amount"]) == 0 and float(b["confidence_interval"]["upper"]) == 0
    assert c["predicted_amount"] is None and c["confidence_interval"]["lower"] is None


def test_score_features_defaults_and_order(spark):
    one = spark.createDataFrame([(1500.0, None, "I")], "amt_billed double, age int, form_type string")
    row = scoring.score_features(one).first().asDict()
    assert len(row) == 23 and row["Age"] == 45 and row["FORM_TYPE_I"] == 1 and row["FORM_TYPE_P"] == 0
    assert row["PRODUCT_TYPE_PPO"] == 1 and row["ICD_Category_Z"] == 1 and row["AMT_BILLED_log"] == pytest.approx(np.log1p(1500))
    assert scoring.score_features(one, ["Age", "unknown", "AMT_BILLED"]).first() == (45.0, 0, 1500.0)


def test_registered_tree_queries_use_the_defaults(spark, sf_dir, monkeypatch):
    from claimwright.catalog import all_queries, features as in_features, models as in_models

    settings, forests = [], []
    monkeypatch.setattr(in_models, "model_rows", lambda *a: (None, None))
    monkeypatch.setattr(in_models, "result_rows", lambda *a: None)
    monkeypatch.setattr(models, "train_model", lambda kind, train, held, names, label, params=None, *a: settings.append((kind, models.model_params(kind, params))))
    monkeypatch.setattr(models, "train_all", lambda train, held, names, label, kinds=None, params=None: settings.extend((k, models.model_params(k, (params or {}).get(k))) for k in kinds or models.DEFAULTS))
    for name in ("train_forest", "train_gbt", "train_adaboost", "train_all"):
        all_queries()[name](spark, sf_dir)
    assert len(settings) == 3 + len(models.DEFAULTS) and all(got == models.DEFAULTS[kind] for kind, got in settings)

    monkeypatch.setattr(in_features.select, "forest_importances", lambda df, target, names, trees, depth: forests.append((trees, depth)) or dict.fromkeys(names, 0.0))
    for name in ("select_importance", "select_rfe"):
        all_queries()[name](spark, sf_dir)
    assert set(forests) == {(100, 10), (50, 8)}


def test_boosting_keeps_two_copies_of_its_weights(spark, frame):
    import os

    from claimwright.session import shared_folder

    root = shared_folder(spark).removeprefix("file:")

    def files():
        return {os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.startswith("part-") and os.path.getsize(os.path.join(d, f))}

    df, before = models.assemble(spark.createDataFrame(frame.head(200)).coalesce(1), NAMES), files()
    model = models.AdaBoostR2("y", rounds=5, max_depth=2, checkpoint_every=1).fit(df)
    assert len(model.trees) == 5 and 0 < len({os.path.dirname(f) for f in files() - before}) <= 2


def test_selecting_forests_use_all_cores(spark, frame, monkeypatch):
    from claimwright.operators import select

    seen = []
    monkeypatch.setattr(select, "forest_importances", lambda df, target, names, *_: seen.append(df.rdd.getNumPartitions()) or {n: float(i) for i, n in enumerate(names)})
    df = spark.createDataFrame(frame).coalesce(1)
    select.select_importance(df, "y", 1, columns=NAMES)
    assert select.select_rfe(df, "y", 1, 1, columns=NAMES) == NAMES[-1:]
    assert len(seen) == len(NAMES) and min(seen) >= spark.sparkContext.defaultParallelism


def test_one_table_on_both_sides_is_scored_once_and_without_vectors(spark, df, monkeypatch):
    from claimwright.operators.features import FeatureState
    from claimwright.operators.scale import fit_scalers

    state, scored = FeatureState(fit_scalers(df, NAMES, "zscore"), {}, NAMES), []
    metrics = models._metrics
    monkeypatch.setattr(models, "_metrics", lambda rows, label: scored.append(rows) or metrics(rows, label))
    result = models.train_model("ridge", df, df, NAMES, "y", None, "1", state)
    assert len(scored) == 1 and set(result.scores["train"]) == set(result.scores["validation"]) == {"r2", "rmse", "mae"}
    assert result.scores["train"] == result.scores["validation"] and result.rows == 1000
    raw = result.model.transform(df)
    assert "UDF" not in raw._jdf.queryExecution().optimizedPlan().toString()
    through = result.model.regressor.transform(models.with_vectors(df, NAMES, state))
    assert sorted(r[0] for r in raw.select("prediction").collect()) == sorted(r[0] for r in through.select("prediction").collect())
