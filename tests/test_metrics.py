import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tabfeat.fixed_values import METRICS
from tabfeat.operators import metrics, quantiles
from tabfeat.sources import io

SCHEMA = "model string, split string, i int, y double, pred double"


def table(spark, pairs, model="m", split="test"):
    return spark.createDataFrame([(model, split, i, float(y), float(p)) for i, (y, p) in enumerate(pairs)], SCHEMA)


def values(df):
    return {r["metric"]: r["value"] for r in metrics.all_metrics(df, ["i"]).collect()}


def test_golden_vector(spark):
    got = values(table(spark, [(1, 1.1), (2, 2.1), (3, 2.9), (4, 4.1), (5, 4.9)]))
    want = {"mse": 0.01, "rmse": 0.1, "mae": 0.1, "r2": 0.995, "mape": 4.566667, "smape": 4.456205, "median_ae": 0.1,
            "max_error": 0.1, "explained_variance": 0.9952, "mean_absolute_scaled_error": 0.1}
    assert set(got) == set(METRICS)
    for name, value in want.items():
        assert got[name] == pytest.approx(value, abs=1e-6), name


def test_zero_and_constant_targets(spark):
    zero = values(table(spark, [(0.0, 0.0), (0.0, 0.0)]))
    assert zero["mape"] == math.inf and zero["smape"] == math.inf
    assert zero["r2"] == 1.0 and zero["explained_variance"] == 1.0
    assert zero["mean_absolute_scaled_error"] == math.inf
    flat = values(table(spark, [(2.0, 2.5), (2.0, 2.5)]))
    assert flat["r2"] == 0.0 and flat["explained_variance"] == 0.0


def test_r2_is_not_squared_correlation(spark):
    assert values(table(spark, [(1, 10), (2, 20), (3, 30)]))["r2"] < -100


def test_one_row_and_no_rows(spark):
    assert values(table(spark, [(1.0, 2.0)]))["mean_absolute_scaled_error"] == math.inf
    empty = spark.createDataFrame([], SCHEMA)
    assert metrics.all_metrics(empty, ["i"]).count() == 0
    assert metrics.compare_models(metrics.all_metrics(empty, ["i"])).count() == 0
    assert metrics.best_model(metrics.all_metrics(empty, ["i"])).first()["model"] is None


def test_rows_without_target_are_ignored(spark):
    df = spark.createDataFrame([("m", "test", 0, 1.0, 1.5), ("m", "test", 1, None, 9.0)], SCHEMA)
    assert values(df)["mae"] == 0.5


def _many_groups(spark, groups, rows=4_000):
    rng = random.Random(3)
    data = [(f"m{rng.randrange(groups) if rng.random() > .35 else 0}", "test", i, round(rng.gauss(5, 2), 1), 5.0)
            for i in range(rows)]
    return spark.createDataFrame(data, SCHEMA)


def test_ten_groups_and_ten_thousand_take_the_same_path(spark):
    """A third of the rows in one group, groups of one row, ties, all kinds of magnitudes."""
    rng = random.Random(3)
    rows = [(None if k == 5 else k, rng.choice([0.0, 1.0, rng.random(), rng.gauss(0, 1e-9), rng.gauss(0, 1e200), -5e-324, float("inf")]))
            for k in (rng.randrange(10_000) if rng.random() > 0.35 else 0 for _ in range(30_000))]
    rows += [(None, None), (20_000, None), (20_001, 4.5)]
    by = {}
    for k, x in rows:
        if x is not None:
            by.setdefault(k, []).append(x)
    df = spark.createDataFrame(rows, "g int, x double").cache()

    def middle(xs):
        low, high = sorted(xs)[(len(xs) - 1) // 2], sorted(xs)[len(xs) // 2]
        return low if low == high else (low + high) / 2

    for few in (100_000, 50):
        got = dict(map(tuple, quantiles.grouped_medians(df, ["g"], F.col("x"), "m", few).collect()))
        assert got.keys() == by.keys() and all(got[k] == middle(xs) for k, xs in by.items())
    ten = df.where("x IS NOT NULL").select((F.col("g") % 10).alias("g"), F.lit("s").alias("h"), "x")
    want = {}
    for k, x in rows:
        if x is not None:
            want.setdefault(None if k is None else k % 10, []).append(x)
    got = {r["g"]: r["m"] for r in quantiles.grouped_medians(ten, ["g", "h"], F.col("x"), "m", 50).collect()}
    assert got == {k: middle(xs) for k, xs in want.items()}


def test_metrics_of_many_groups(spark):
    df = _many_groups(spark, 700).cache()
    rows = metrics.metric_table(df, ["i"]).collect()
    series = {}
    for r in sorted(df.collect(), key=lambda r: r["i"]):
        series.setdefault(r["model"], []).append(r["y"])
    assert len(rows) == len(series) > 500
    for r in rows:
        ys = series[r["model"]]
        errors, steps = [abs(y - 5) for y in ys], [abs(a - b) for a, b in zip(ys, ys[1:])]
        assert r["median_ae"] == pytest.approx(statistics.median(errors))
        scaled = math.inf if not sum(steps) else statistics.mean(errors) / statistics.mean(steps)
        assert r["mean_absolute_scaled_error"] == pytest.approx(scaled)


def test_order_based_error_runs_no_python(spark):
    plan = metrics.naive_errors(_many_groups(spark, 5), ["model"], ["i"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_dropped_rows_are_counted(spark):
    rows = [("m", "test", 0, 1.0, 1.5), ("m", "test", 1, None, 9.0), ("m", "test", 2, 2.0, None), ("m", "val", 3, None, None)]
    got = {(r["split"], r["n"], r["n_dropped"]) for r in metrics.scored_counts(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {("test", 1, 2), ("val", 0, 1)}


@pytest.mark.parametrize("partitions", [1, 4, 7])
def test_order_based_error_ignores_partitioning(spark, partitions):
    df = _many_groups(spark, 5).repartition(partitions)
    got = {r["model"]: (r["steps"], r["total"]) for r in metrics.naive_errors(df, ["model"], ["i"]).collect()}
    series = {}
    for r in sorted(df.collect(), key=lambda r: r["i"]):
        series.setdefault(r["model"], []).append(r["y"])
    for model, ys in series.items():
        steps = [abs(a - b) for a, b in zip(ys, ys[1:])]
        assert got[model][0] == len(steps) and got[model][1] == pytest.approx(sum(steps))


def test_best_model_knows_directions(spark):
    rows = [(m, "test", k, v) for m, k, v in (("a", "median_ae", 1.0), ("b", "median_ae", 2.0), ("a", "r2", 0.1), ("b", "r2", 0.9))]
    long = spark.createDataFrame(rows, "model string, split string, metric string, value double")
    assert metrics.best_model(long, "median_ae").first()["model"] == "a"
    assert metrics.best_model(long, "r2").first()["model"] == "b"
    assert metrics.best_model(long, "max_error").first()["model"] is None
    with pytest.raises(ValueError):
        metrics.best_model(long, "nothing")


def test_importance_average_counts_missing_as_zero(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("b", "x", 0.5), ("b", "z", 0.6)], "model string, feature string, importance double")
    rows = {r["feature"]: r["average"] for r in metrics.importance_pivot(df).collect()}
    assert rows == {"x": 0.75, "z": 0.3}


def test_steps_across_buckets_groups_and_nulls_sort_once(spark):
    rng = random.Random(5)
    keys = rng.sample(range(600), 600)
    rows = [(["a", "b", None][i % 3], k, None if k % 11 == 0 else rng.gauss(0, 1)) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "m string, k int, y double").repartition(4)
    found = metrics.naive_errors(df, ["m"], ["k"])
    got = {r[0]: (r[1], r[2]) for r in found.collect()}
    for m in ("a", "b", None):
        own = [y for _, y in sorted((k, y) for g, k, y in rows if g == m)]
        sizes = [abs(a - b) for a, b in zip(own, own[1:]) if a is not None and b is not None]
        assert got[m][0] == len(sizes) and got[m][1] == pytest.approx(sum(sizes))
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()


def test_results_are_written_without_a_sort_by_folder(spark, tmp_path):
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    with io._open_writers(spark):
        assert int(spark.conf.get(name)) >= 9
    assert spark.conf.get(name) == before
    rows = spark.range(90).selectExpr("concat('m', id % 3) model", "concat('s', id % 2) split", "id", "double(id) y", "double(-id) pred")
    table = spark.createDataFrame([("m0", "s0", "rmse", float("inf"))], "model string, split string, metric string, value double")
    io.save_results(table, rows, str(tmp_path))
    found, back = io.load_results(spark, str(tmp_path), rows.schema)
    assert sorted(map(tuple, back.select(*rows.columns).collect())) == sorted(map(tuple, rows.collect())) and found.first()[3] == float("inf")


def test_groups_with_the_same_series_are_sorted_once(spark, monkeypatch):
    rng = random.Random(9)
    ys = [rng.gauss(5, 2) for _ in range(300)]
    rows = [(m, "test" if i % 3 else None, i, y, y + 1 if m != "c" or i != 7 else None) for i, y in enumerate(ys) for m in "abc"]
    rows += [("d", "test", i, y if i != 8 else 99.0, 1.0) for i, y in enumerate(ys) if i % 3] + [("e", "test", i, ys[i] * 2, 1.0) for i in range(5)]
    df = spark.createDataFrame(rows, "model string, split string, i int, y double, pred double").repartition(5)
    sorted_rows, naive = [], metrics.naive_errors

    def counted(df, *args):
        sorted_rows.append(df.count())
        return naive(df, *args)

    monkeypatch.setattr(metrics, "naive_errors", counted)
    want = {(r["model"], r["split"]): r["total"] / r["steps"] for r in naive(df.where("pred IS NOT NULL"), ["model", "split"], ["i"]).collect()}
    for names in (["mean_absolute_scaled_error"], metrics.METRICS):
        table = metrics.metric_table(df, ["i"], metrics=names).collect()
        assert len(table) == len(want) == 8
        for r in table:
            mae = statistics.mean(abs(y - p) for m, s, _, y, p in rows if (m, s) == (r["model"], r["split"]) and p is not None)
            assert r["mean_absolute_scaled_error"] == pytest.approx(mae / want[r["model"], r["split"]])
    # a and b share both series, c one of them; d differs in one target, e in all.
    assert sorted_rows == [100 + 200 + 199 + 200 + 5] * 2
    monkeypatch.setattr(metrics, "BROADCAST_ROWS", 2)
    again = {(r[0], r[1]): r[2] for r in metrics.metric_table(df, ["i"], metrics=names[-1:]).collect()}
    assert sorted_rows[-1] == len(rows) - 1 and len(again) == 8
