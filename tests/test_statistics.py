"""Exact quantiles, global order, splits."""

import hashlib
import math
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabfeat.operators import plotdata, profile, quantiles, rank, selection, split
from tabfeat.spec import FeatureSpec, nan_to_null

PROBS = [0, 0.1, 0.25, 0.5, 0.75, 0.9, 1]


def _series():
    rng = np.random.default_rng(1)
    n = 5_000
    hot = rng.normal(size=n)
    hot[: n // 3] = 0.25
    return {
        "normal": rng.normal(size=n), "hot": hot, "tail": np.exp(rng.normal(size=n) * 8) * rng.choice([-1, 1], n),
        "few": rng.integers(0, 3, n).astype(float), "flat": np.full(n, 7.0), "tiny": 1e9 + rng.normal(size=n) * 1e-6,
    }


@pytest.mark.parametrize("limit", [quantiles.COLLECT_LIMIT, 300, 0])
def test_quantiles_are_exact_however_few_values_are_collected(spark, limit):
    data = _series()
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(*data.values())], ", ".join(f"{c} double" for c in data)).cache()
    got = quantiles.exact_quantiles(df, list(data), PROBS, collect_limit=limit)
    for c, x in data.items():
        np.testing.assert_allclose(got[c], np.quantile(x, PROBS), rtol=1e-12, err_msg=c)


def test_quantiles_of_nulls_infinities_and_ties(spark):
    df = spark.createDataFrame([(float(v), None, float("inf") if v > 8 else float(v)) for v in (1, 2, 2, 3, 4, 7, 9, 10)],
                               "a double, b double, c double")
    got = quantiles.exact_quantiles(df, ["a", "b", "c"], [0.25, 0.5, 0.75])
    assert got["a"] == [2.0, 3.5, 7.5] and got["b"] == [None] * 3 and got["c"][:2] == [2.0, 3.5]
    approx = quantiles.quantiles(df, ["a"], [0.5], "approx")
    assert approx["a"][0] in (3.0, 4.0)


@pytest.mark.parametrize("partitions", [1, 4, 7])
def test_global_rank(spark, partitions):
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("v")).repartition(partitions)
    got = [r["id"] for r in rank.global_rank(df, ["v", "id"]).orderBy("rank").collect()]
    assert got == sorted(range(1000), key=lambda i: (i % 3, i))
    assert rank.global_rank(df, ["v", "id"]).agg(F.min("rank"), F.max("rank")).first() == (1, 1000)


@pytest.mark.parametrize("limit", [20_000, 10])
def test_joint_cutoffs(spark, limit):
    columns = [F.md5(F.col("id").cast("string")), F.sha2(F.col("id").cast("string"), 256)]
    ordered = [sorted(kind(str(i).encode()).hexdigest() for i in range(3000)) for kind in (hashlib.md5, hashlib.sha256)]
    got = rank.joint_cutoffs(spark.range(3000), columns, lambda rows: [[0, 1, rows // 5, rows], [7, 0]], limit)
    assert got == [[None, ordered[0][0], ordered[0][599], ordered[0][2999]], [ordered[1][6], None]]


def test_nulls_and_split_are_cut_by_two_scans(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    spec = FeatureSpec(("id",), ("x",))
    plain = spark.range(5000).select("id", F.lit(1.0).alias("x"))
    joint = split.split_with_missing(plain.mapInArrow(counted, "id bigint, x double"), spec, split.SplitOptions(), "x", 0.1)
    assert seen.value == 2 * 5000
    apart = split.split_exact(split.inject_missing(plain, spec, "x", 0.1), spec)
    assert joint.orderBy("id").collect() == apart.orderBy("id").collect()
    assert joint.where("x IS NULL").count() == 500
    with pytest.raises(ValueError, match="key"):
        split.split_with_missing(plain, spec, split.SplitOptions(), "id", 0.1)


def test_repeated_keys_are_refused(spark):
    df = spark.createDataFrame([(1, 1.0)] * 10, "id int, x double")
    with pytest.raises(ValueError, match="key"):
        split.split_exact(df, FeatureSpec(("id",), ("x",)))


@pytest.mark.parametrize("rows", [0, 1, 5, 103])
@pytest.mark.parametrize("partitions", [1, 7])
def test_split_sizes(spark, rows, partitions):
    spec = FeatureSpec(("id",), ("x",))
    df = spark.range(rows).select("id", F.lit(1.0).alias("x")).repartition(partitions)
    counts = dict(split.split_exact(df, spec).groupBy("split").count().collect())
    test = math.ceil(0.2 * rows)
    val = math.ceil(0.2 / 0.8 * (rows - test))
    assert counts.get("test", 0) == test and counts.get("val", 0) == val and sum(counts.values()) == rows


def test_split_depends_only_on_key_and_seed(spark):
    spec = FeatureSpec(("id",), ("x",))
    df = spark.range(200).select("id", F.rand().alias("x"))
    one = {tuple(r) for r in split.split_exact(df.repartition(1), spec).select("id", "split").collect()}
    two = {tuple(r) for r in split.split_exact(df.repartition(5), spec).select("id", "split").collect()}
    other = {tuple(r) for r in split.split_exact(df, spec, split.SplitOptions(seed=7)).select("id", "split").collect()}
    assert one == two != other


@pytest.mark.parametrize("wrong", [{"seed": -1}, {"test_size": 0.0}, {"validation_size": 1.0}, {"test_size": 0.6, "validation_size": 0.5}])
def test_split_options_are_checked(wrong):
    with pytest.raises(ValueError):
        split.SplitOptions(**wrong)


def test_injected_gaps(spark):
    spec = FeatureSpec(("id",), ("x", "z"))
    df = spark.range(99).select("id", F.lit(1.0).alias("x"), F.lit(1.0).alias("z"))
    gaps = split.inject_missing(df, spec)
    assert gaps.where("x is null").count() == 4 and gaps.where("z is null").count() == 0
    assert split.inject_missing(df.limit(5), spec).where("x is null").count() == 0


def test_nan_becomes_null(spark):
    df = nan_to_null(spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "x double"))
    assert [r[0] for r in df.collect()] == [1.0, None, None, 3.0]


def test_histogram_of_constant_and_empty(spark):
    flat = profile.histograms(spark.createDataFrame([(2.0,)] * 3, "x double"), ["x"], 4).collect()
    assert sum(r["count"] for r in flat) == 3 and len(flat) == 4
    assert profile.histograms(spark.createDataFrame([], "x double"), ["x"], 4).count() == 0


def test_probability_plot(spark):
    rng = np.random.default_rng(5)
    residual = rng.normal(size=500)
    df = spark.createDataFrame([("m", "test", i, float(v), 0.0) for i, v in enumerate(residual)],
                               "model string, split string, i int, y double, pred double")
    points = plotdata.qq_points(df, ["i"])
    rows = sorted(points.collect(), key=lambda r: r["rank"])
    n, normal = len(rows), statistics.NormalDist()
    want = [(i - 0.3175) / (n + 0.365) for i in range(1, n + 1)]
    want[0], want[-1] = 1 - 0.5 ** (1 / n), 0.5 ** (1 / n)
    np.testing.assert_allclose([r["theoretical"] for r in rows], [normal.inv_cdf(p) for p in want], rtol=1e-7, atol=1e-8)
    np.testing.assert_allclose([r["ordered"] for r in rows], np.sort(residual))
    line = plotdata.qq_line(points).first()
    assert line["slope"] == pytest.approx(1, abs=0.1) and line["r"] > 0.99


def test_radar_of_one_model_is_null(spark):
    df = spark.createDataFrame([("m", 0.5, 1.0, 1.0)], "model string, test_r2 double, test_rmse double, test_mae double")
    assert plotdata.radar_scores(df).first()["test_rmse"] is None


def test_quantiles_and_selection_of_all_interactions_of_fifty_features(spark):
    rng = np.random.default_rng(7)
    x = np.round(rng.normal(size=(400, 50)) * np.exp(rng.normal(size=50) * 3), 6)
    df = spark.createDataFrame([(i, *map(float, r), float(r[0] + r[1])) for i, r in enumerate(x)],
                               "id int, " + ", ".join(f"x{i} double" for i in range(50)) + ", y double").repartition(3).cache()
    pairs = [(i, j) for i in range(50) for j in range(i, 50)]
    columns = {f"x{i}*x{j}" if i != j else f"x{i}": F.col(f"x{i}") * F.col(f"x{j}") if i != j else F.col(f"x{i}") for i, j in pairs}
    assert len(columns) == 1275
    probs = [i / 16 for i in range(17)]
    got = quantiles.exact_quantiles(df, columns, probs, collect_limit=100_000)
    for (i, j), own in zip(pairs, got.values()):
        np.testing.assert_allclose(own, np.quantile(x[:, i] * x[:, j] if i != j else x[:, i], probs), rtol=1e-12, atol=1e-300)
    spec = FeatureSpec(("id",), tuple(columns), "y")
    wide = df.select("id", "y", *[e.alias(c) for c, e in columns.items()])
    step, scores = selection.fit_select(wide, spec, 20)
    assert len(step.features) == 20 and "x0" in step.features and scores.count() == 1275


def test_a_scan_counts_into_a_fixed_number_of_slots_however_wide(spark):
    for columns in (1, 50, 1275, quantiles.SCAN_COLUMNS):
        own = {c: [quantiles._Bracket(k * 10**12, k * 10**12 + 10**11, 0, 9, [0]) for k in range(34)] for c in range(columns)}
        slots = min(quantiles.COLUMN_SLOTS, quantiles.SLOTS // columns)
        total = sum(len(quantiles._edges(b, slots // 34)) + 1 for b in own[0]) * columns
        assert total <= 2 * quantiles.SLOTS


def test_quantiles_next_to_zero_and_at_the_ends_of_doubles(spark):
    x = [5e-324 * k for k in range(40)] + [-5e-324 * k for k in range(40)] + [1.7e308, -1.7e308, 1e-310, 0.0, -0.0]
    df = spark.createDataFrame([(v,) for v in x], "x double")
    for limit in (300_000, 0):
        assert quantiles.exact_quantiles(df, ["x"], [0.25, 0.5, 0.75], limit)["x"] == np.quantile(x, [0.25, 0.5, 0.75]).tolist()
    odd = spark.createDataFrame([(1.0,), (float("nan"),), (float("inf"),), (None,)], "x double")
    assert quantiles.exact_quantiles(odd, ["x"], [0, 0.5], 0)["x"] == [1.0, math.inf]


@pytest.mark.parametrize("tile", [512, 90])
def test_correlations_of_two_hundred_columns_with_gaps(spark, monkeypatch, tile):
    monkeypatch.setattr(profile, "TILE_COLUMNS", tile)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, 200)) @ rng.normal(size=(200, 200)) + 1e6
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 7], x[:, 8], x[2:, 9], x[:, 10] = 0.1, np.nan, np.nan, np.where(np.arange(300) % 2, np.nan, x[:, 10])
    x[:, 11] = np.where(np.isnan(x[:, 10]), 3.0, np.nan)  # never together with column 10
    names = [f"c.{i}" if i == 3 else f"c{i}" for i in range(200)]
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in x],
                               ", ".join(f"`{c}` double" for c in names)).repartition(5)
    result = profile.corr_matrix(df, names)
    got = {(r["a"], r["b"]): r["r"] for r in result.collect()}
    assert len(got) == 40_000 and got["c10", "c11"] is None and got["c8", "c0"] is None and math.isnan(got["c7", "c0"])
    for i, a in enumerate(names):
        for j in range(i, 200):
            if i in (7, 8, 9, 11) or j in (7, 8, 9, 11):
                continue
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            assert got[a, names[j]] == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-9) == got[names[j], a]
