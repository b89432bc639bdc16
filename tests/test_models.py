import inspect

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tabfeat.catalog import queries
from tabfeat.operators import split
from tabfeat.plans import cells, huber, models, neighbours, runs, search
from tabfeat.plans.models import MODEL_TYPES, CosineFeatures, Regressor
from tabfeat.sources import frames
from tabfeat.spec import FeatureSpec

SPEC = FeatureSpec(("id",), ("a", "b", "c"), "y")


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(11)
    x = rng.normal(size=(400, 3)) * [1, 3, 0.5]
    y = 2 + x @ [1.5, -0.7, 2.0] + rng.normal(size=400)
    return x, y


@pytest.fixture(scope="module")
def df(spark, data):
    x, y = data
    rows = [(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id int, a double, b double, c double, y double").repartition(3).cache()


def test_ridge_and_ordinary_follow_the_normal_equations(df, data):
    x, y = data
    xc, yc = x - x.mean(0), y - y.mean()
    for kind, alpha in (("linear_regression", 0.0), ("ridge", 50.0)):
        want = np.linalg.solve(xc.T @ xc + alpha * np.eye(3), xc.T @ yc)
        model = Regressor(kind, {"alpha": alpha}).fit(df, SPEC).spark_model
        np.testing.assert_allclose(model.coefficients.toArray(), want, rtol=1e-8)
        assert model.intercept == pytest.approx(y.mean() - x.mean(0) @ want)


@pytest.mark.parametrize(("kind", "ratio"), [("lasso", 1.0), ("elastic_net", 0.5)])
def test_absolute_penalties_satisfy_their_optimality_conditions(df, data, kind, ratio):
    x, y = data
    alpha = 0.4
    w = Regressor(kind, {"alpha": alpha, "l1_ratio": ratio}).fit(df, SPEC).spark_model.coefficients.toArray()
    xc, yc = x - x.mean(0), y - y.mean()
    slope = xc.T @ (yc - xc @ w) / len(y) - alpha * (1 - ratio) * w
    for g, v in zip(slope, w):
        assert abs(g - alpha * ratio * np.sign(v)) < 1e-4 if v else abs(g) <= alpha * ratio + 1e-4


@pytest.mark.parametrize("kind", ["decision_tree", "random_forest", "gradient_boosting", "svr"])
def test_flexible_models_beat_the_mean_and_repeat(df, kind):
    frame = split.split_exact(df, SPEC).cache()
    params = {"n_estimators": 5, "components": 60}
    one = Regressor(kind, params).fit(frame, SPEC)
    val = frame.where("split = 'val'")
    score = one.score(val)
    assert score > 0.2 and Regressor(kind, params).fit(frame, SPEC).score(val) == pytest.approx(score)
    if kind != "svr":
        assert one.importance(frame).agg(F.sum("importance")).first()[0] == pytest.approx(1)


def _nearest(x, y, k):
    out = []
    for q in x:
        d = np.zeros(len(x))
        for j in range(x.shape[1]):
            d += (x[:, j] - q[j]) ** 2
        out.append(y[np.lexsort((np.arange(len(x)), d))[:k]].mean())
    return out


@pytest.mark.parametrize("block", [4096, 16])
def test_neighbours_are_exact_with_a_third_of_the_rows_on_one_spot(spark, monkeypatch, block):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", block)
    rng = np.random.default_rng(12)
    x = rng.normal(size=(240, 2))
    x[:80] = 0.5
    y = rng.normal(size=240)
    frame = spark.createDataFrame([(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))],
                                  "id int, a double, b double, y double")
    spec = FeatureSpec(("id",), ("a", "b"), "y")
    model = Regressor("knn", {"k": 7}).fit(frame, spec)
    got = [r["pred"] for r in model.predict(frame).orderBy("id").collect()]
    np.testing.assert_allclose(got, _nearest(x, y, 7), rtol=1e-12)


def test_cells_fit_a_block_at_a_hundred_blocks_of_rows_but_for_single_points(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 40)
    monkeypatch.setattr(neighbours, "FANOUT", 8)
    monkeypatch.setattr(neighbours, "_TASK_ROWS", 300)
    rng = np.random.default_rng(13)
    x = rng.normal(size=(4000, 2))
    x[:1300] = 0.25
    x[1300:2000] = x[1300:2000] * 1e-4 + 3
    y = rng.normal(size=4000)
    frame = spark.createDataFrame([(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))],
                                  "id int, a double, b double, y double")
    rows = frame.withColumnsRenamed({"id": "r_id", "y": "v"})
    tree = neighbours.cell_tree(rows, ["a", "b"], ["r_id"])
    sizes = tree.rows.groupBy("cell").agg(F.count("*").alias("n"), F.countDistinct("a", "b").alias("points")).collect()
    assert sum(r["n"] for r in sizes) == 4000 and len(tree.levels) > 2
    assert max(r["n"] for r in sizes if r["points"] > 1) <= 40
    assert {r["cell"]: r["n"] for r in sizes} == dict(tree.leaves.collect())
    assert max(n.groupBy("cell").count().agg(F.max("count")).first()[0] for n in tree.levels) <= 8
    asked = frame.where("id % 40 = 0")
    visits = neighbours.visited_cells(asked.select(F.col("id").alias("q_id"), F.col("a").alias("q_a"), F.col("b").alias("q_b")),
                                      tree, ["a", "b"], ["q_id"], 5)
    assert visits.count() < 0.2 * asked.count() * len(sizes)
    got = [r["pred"] for r in neighbours.nearest_mean(frame, asked, FeatureSpec(("id",), ("a", "b"), "y")).orderBy("id").collect()]
    want = [y[np.lexsort((np.arange(4000), (x[:, 0] - q[0]) ** 2 + (x[:, 1] - q[1]) ** 2))[:5]].mean() for q in x[::40]]
    np.testing.assert_allclose(got, want, rtol=1e-12)


def test_a_thousand_cosine_features_are_one_node(spark, df, data):
    lift = CosineFeatures.drawn(df, ["a", "b", "c"], 1000, 0.5, 3)
    frame = df.withColumn("lift", lift.column())
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and len(plan) < 5000
    x, _ = data
    rng = np.random.default_rng(3)
    directions, phases = rng.normal(0.0, 1.0, (1000, 3)), rng.uniform(0.0, 2 * np.pi, 1000)
    want = np.cos((x - x.mean(0)) / x.std(0) @ directions.T + phases) * np.sqrt(2 / 1000)
    got = np.array([r["lift"] for r in frame.orderBy("id").select("lift").collect()])
    np.testing.assert_allclose(got, want, atol=1e-9)
    gaps = df.withColumn("b", F.when(F.col("id") > 3, F.col("b"))).withColumn("lift", lift.column())
    assert gaps.where("lift IS NULL").count() == 4


def test_model_contract(df):
    model = Regressor("linear_regression").fit(df, SPEC)
    assert model.predict(df).count() == 400 and isinstance(model.score(df), float)
    with pytest.raises(ValueError):
        Regressor("nothing")
    with pytest.raises(ValueError):
        Regressor("ridge").fit(df, FeatureSpec(("id",), ("a",)))


def test_search(df):
    found = search.optimize(df, SPEC, n_trials=4, folds=2, families=["linear_regression", "ridge"])
    assert set(found.as_dict()) == {"best_score", "best_params"} and found.model.predict(df).count() == 400
    again = search.optimize(df, SPEC, n_trials=4, folds=2, families=["linear_regression", "ridge"], refit=False)
    assert (again.best_score, again.best_params) == (pytest.approx(found.best_score), found.best_params)
    assert found.trials.where("score IS NOT NULL").count() == 8 and found.unscored == 0
    short = search.optimize(df, SPEC, n_trials=50, timeout=0, folds=2, families=["ridge"], refit=False)
    assert short.trials.where("score IS NOT NULL").select("trial").distinct().count() == 1
    assert short.unscored == 49 and short.trials.where("score IS NULL").count() == 49
    full = sum(s for _, s in search.fold_scores(df, SPEC, Regressor("ridge", short.best_params), 2)) / 2
    assert short.best_score == pytest.approx(full)


@pytest.mark.parametrize("kind, params", [("linear_regression", {}), ("ridge", {"alpha": 30.0}), ("lasso", {"alpha": 0.2}),
                                          ("elastic_net", {"alpha": 0.3, "l1_ratio": 0.4})])
@pytest.mark.parametrize("scoring", ["neg_mean_squared_error", "neg_root_mean_squared_error", "r2"])
def test_folds_solved_from_moments_score_as_those_fitted_by_scans(df, monkeypatch, kind, params, scoring):
    rows = df.withColumn("b", F.col("b") + 1e5)
    solved = search.fold_scores(rows, SPEC, Regressor(kind, params), 3, scoring)
    monkeypatch.setattr(search.gram, "FAMILIES", ())
    scanned = search.fold_scores(rows, SPEC, Regressor(kind, params), 3, scoring)
    assert [f for f, _ in solved] == [f for f, _ in scanned] == [0, 1, 2]
    assert [s for _, s in solved] == pytest.approx([s for _, s in scanned], rel=2e-4)


def test_a_search_of_linear_families_reads_its_rows_once(df, monkeypatch):
    calls = []
    moments = search.gram.fold_moments
    monkeypatch.setattr(search.gram, "fold_moments", lambda *a: calls.append(1) or moments(*a))
    monkeypatch.setattr(Regressor, "fit", lambda *a: pytest.fail("no model is fitted by a scan"))
    found = search.optimize(df, SPEC, families=list(search.gram.FAMILIES), refit=False)
    assert len(calls) == 1 and found.trials.where("score IS NOT NULL").count() == 500


def test_moments_refuse_gaps_and_know_constants(spark):
    df = spark.createDataFrame([(i, float(i), 0.1, 3.0 * i + 1, i % 2) for i in range(20)], "id int, a double, b double, y double, _fold int")
    spec = FeatureSpec(("id",), ("a", "b"), "y")
    moments = search.gram.fold_moments(df, spec)
    assert search.gram.moment_scores(moments, "linear_regression", {}, "r2") == [(0, pytest.approx(1)), (1, pytest.approx(1))]
    with pytest.raises(Exception, match="missing"):
        search.gram.fold_moments(df.withColumn("a", F.when(F.col("id") > 3, F.col("a"))), spec)


def test_cross_validation_fits_the_chain_in_each_fold(df):
    scores = search.cross_validate(df, SPEC, Regressor("linear_regression"), 3, chain="advanced")
    interval = search.confidence(scores).first()
    assert scores.count() == 3 and interval["low"] < interval["mean"] < min(0, interval["high"])


def test_thresholds_are_middles_or_equal_shares():
    assert cells.thresholds(np.array([1.0, 1.0, 4.0, 2.0])) == [1.5, 3.0]
    many = cells.thresholds(np.arange(640.0))
    assert len(many) == 31 and np.ptp(np.diff(many)) <= 1


def test_boosting_learns_from_cells_as_from_rows(spark, df, data):
    (x, y), kind = data, "gradient_boosting"
    found, table, share = models._added_up(df.union(df).union(df), SPEC, {})
    assert table.count() <= 400 and share >= 3
    assert table.agg(F.sum("n")).first()[0] == 1200
    model = Regressor(kind, {"n_estimators": 4}).fit(df, SPEC)
    got = np.array([r[0] for r in model.predict(df).orderBy("id").select("pred").collect()])
    plain = models._FITTERS[kind].__closure__[0].cell_contents({"n_estimators": 4}).setFeaturesCol("_x").setLabelCol("y")
    # Spark's own tree of the rows, which may place a threshold elsewhere between two rows.
    own = plain.setPredictionCol("pred").fit(models.assembled(df, SPEC.features))
    want = np.array([r[0] for r in own.transform(models.assembled(df, SPEC.features)).orderBy("id").select("pred").collect()])
    assert np.mean((got - y) ** 2) == pytest.approx(np.mean((want - y) ** 2), rel=0.1)


def test_forest_draws_rows_and_learns_from_cells(spark, df, data, monkeypatch):
    x, y = data
    rough = df.select("id", *[F.round(c).alias(c) for c in "abc"], "y")
    rows = rough.crossJoin(spark.range(12).toDF("copy")).drop("copy")
    monkeypatch.setattr(cells, "DRAWN_ROWS", 500)
    monkeypatch.setattr(cells, "DRAWN_BYTES", 12 * 6 * 50)
    found, table, share = models._added_up(rows, SPEC, {})
    assert share >= models.ROWS_A_CELL
    path = cells.drawn_cells(rows, found, "y", 6, 3)
    sums = spark.read.parquet(path).groupBy("tree").agg(F.sum("n"), F.sum(F.col("n") * F.col("y"))).orderBy("tree").collect()
    assert len(sums) == 6 and len({s[1] for s in sums}) > 1
    for _, n, total in sums:
        assert abs(n - 4800) < 6 * 70 and total / n == pytest.approx(y.mean(), abs=0.5)
    model = Regressor("random_forest", {"n_estimators": 6, "max_depth": 4}).fit(rows, SPEC)
    assert model.spark_model is None and model.score(rough) > 0.5
    assert model.predict(rough).count() == 400
    assert model.importance(df).agg(F.sum("importance")).first()[0] == pytest.approx(1)


def test_trees_refuse_missing_features_and_stand_constants(spark, df):
    with pytest.raises(ValueError, match="missing"):
        Regressor("gradient_boosting").fit(df.withColumn("a", F.when(F.col("id") > 3, F.col("a"))), SPEC)
    flat = df.select("id", *[F.lit(1.0).alias(c) for c in "abc"], "y")
    pred = Regressor("gradient_boosting", {"n_estimators": 2}).fit(flat, SPEC).predict(flat).agg(F.min("pred"), F.max("pred"), F.avg("y")).first()
    assert pred[0] == pred[1] == pytest.approx(pred[2])


def test_kernel_model_reads_its_rows_a_few_times_and_finds_the_minimum(df, data, monkeypatch):
    scans, added_up = [], huber._added_up
    monkeypatch.setattr(huber, "_added_up", lambda *a: scans.append(1) or added_up(*a))
    lift = CosineFeatures.drawn(df, ["a", "b", "c"], 20, 0.3, 42)
    rows = df.withColumn("y", F.when(F.col("id") % 20 == 0, F.col("y") * 50).otherwise(F.col("y"))).select("a", "b", "c", "y")
    weights, intercept = huber.fit(rows, lift.lifted(), 20)
    assert 2 < len(scans) < 20
    cells = np.array(rows.collect())
    x, y = lift.lifted()(cells[:, :3]), cells[:, 3]
    deviation = x.std(axis=0, ddof=1)

    def loss(w, b, s):
        r = np.abs(y - x @ w - b)
        return np.where(r <= 1.35 * s, s + r * r / s, s + 2.7 * r - s * 1.35**2).mean() / 2 + 1e-4 / 2 * ((w * deviation)**2).sum()

    def best(w, b):
        return min(loss(w, b, s) for s in np.geomspace(0.01, 100, 4001))

    spark_model = LinearRegression(loss="huber", epsilon=1.35, regParam=1e-4, maxIter=500, tol=1e-12, featuresCol="v", labelCol="y").fit(
        rows.withColumn("v", array_to_vector(lift.column())))
    assert best(weights, intercept) <= best(spark_model.coefficients.toArray(), spark_model.intercept) * (1 + 1e-6)
    for j in range(20):
        step = np.eye(20)[j] * 1e-2 / deviation[j]
        assert min(best(weights + step, intercept), best(weights - step, intercept)) >= best(weights, intercept) * (1 - 1e-7)


def test_kernel_model_with_gaps_constants_and_nothing_to_explain(df):
    params = {"components": 10}
    model = Regressor("svr", params).fit(df.withColumn("c", F.lit(2.0)), SPEC)
    gaps = df.withColumn("b", F.when(F.col("id") > 3, F.col("b"))).withColumn("c", F.lit(2.0))
    assert model.predict(gaps).where("pred IS NULL").count() == 4
    flat = Regressor("svr", params).fit(df.withColumn("y", F.lit(7.0)), SPEC)
    assert flat.predict(df).agg(F.max(F.abs(F.col("pred") - 7))).first()[0] < 1e-9
    with pytest.raises(Exception, match="missing"):
        Regressor("svr", params).fit(gaps, SPEC)
    with pytest.raises(ValueError, match="without rows"):
        Regressor("svr", params).fit(df.where("id < 0"), SPEC)


@pytest.mark.parametrize("kind, trials, close", [
    ("decision_tree", [{"max_depth": d} for d in (1, 3, 6)], 1e-9), ("knn", [{"k": k} for k in (1, 4, 15)], 1e-9),
    ("gradient_boosting", [{"n_estimators": 4, "max_depth": 3, "learning_rate": 0.2}, {"n_estimators": 2, "max_depth": 2}], 1e-6),
    ("random_forest", [{"n_estimators": 30, "max_depth": 5}, {"n_estimators": 20, "max_depth": 3}], 0.2),
    ("svr", [{"epsilon": 1.2, "alpha": 1e-3, "components": 20}, {"epsilon": 1.9, "alpha": 1e-5, "components": 20}], 1e-5)])
def test_trials_scored_together_score_as_those_fitted_one_by_one(df, kind, trials, close):
    scoring = "r2" if kind in ("decision_tree", "knn") else "neg_mean_squared_error"
    rows = search._folded(df, SPEC, 3, 42).cache()
    found = search.fold_models.Folds(rows, SPEC).scores(kind, dict(enumerate(trials)), scoring)
    for i, params in enumerate(trials):
        want = search._scores(rows, SPEC, Regressor(kind, params), 3, scoring)
        assert [f for f, _ in found[i]] == [f for f, _ in want] == [0, 1, 2]
        assert [s for _, s in found[i]] == pytest.approx([s for _, s in want], rel=close)


def _lines(spark):
    """300 lines of their own with the features of ``LINE_INTER``."""
    rng = np.random.default_rng(5)
    rows = [(i, i % 7, i % 5, 1, i, *map(float, rng.normal(size=4)), ("test", "val", "train", "train", "train")[i % 5]) for i in range(300)]
    names = ", ".join([f"{c} bigint" for c in frames.LINE_KEY] + [f"{c} double" for c in frames.LINE_INTER.features])
    return spark.createDataFrame(rows, f"{names}, split string").withColumn(
        "discount_amount", F.col("l_discount") * 3 + F.col("l_tax")).cache()


@pytest.mark.parametrize("name, module, searches", [("optimize_wide", search, 1), ("run_grid", runs, 2)])
def test_searches_are_asked_for_a_hundred_trials_of_all_families(spark, monkeypatch, name, module, searches):
    lines, asked, search_all = _lines(spark), [], search.optimize

    def quick(df, spec, **given):
        asked.append(given)
        return search_all(df, spec, n_trials=1, folds=2)

    monkeypatch.setattr(frames, "line_inter_split", lambda *_: lines)
    monkeypatch.setattr(module, "optimize", quick)
    found = queries.QUERIES[name](spark, "")
    if name == "run_grid":
        assert {r[0] for r in found.select("model").distinct().collect()} == {f"{m}_{c}" for m in ("classical", "automl") for c in ("basic", "advanced")}
    defaults = {n: p.default for n, p in inspect.signature(search_all).parameters.items()}
    for given in asked:
        full = {**defaults, **given}
        assert full["n_trials"] == 100 and full["folds"] == 5 and set(full["families"] or MODEL_TYPES) == set(MODEL_TYPES)
    assert len(asked) == searches


def test_a_search_of_all_families_scores_every_trial(spark):
    found = search.optimize(_lines(spark), frames.LINE_INTER, n_trials=9, folds=2, refit=False)
    rows = found.trials.groupBy("family").agg(F.count("score")).collect()
    assert {r[0] for r in rows} == set(MODEL_TYPES) and {r[1] for r in rows} == {2} and found.unscored == 0
