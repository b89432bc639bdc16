import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabfeat.functions.beta import f_tail
from tabfeat.operators import encoders, power_fit, selection, transformers as tr
from tabfeat.spec import FeatureSpec


def frame(spark, **columns):
    names = list(columns)
    rows = [(i, *[None if v is None else float(v) for v in r]) for i, r in enumerate(zip(*columns.values()))]
    return spark.createDataFrame(rows, "id int, " + ", ".join(f"{c} double" for c in names))


def column(df, c):
    return [r[0] for r in df.orderBy("id").select(c).collect()]


TIES = [1, 2, 2, 3, 4, 7, 9, 10]


def test_bins_are_right_closed(spark):
    df = frame(spark, x=TIES)
    step = tr.fit_equal_frequency(df, ["x"])
    assert column(step.apply(df), "x") == [0, 0, 0, 1, 2, 2, 3, 3]
    far = frame(spark, x=[-1e9, 2.0, 2.0000001, 7.5, 1e9, None])
    assert column(step.apply(far), "x") == [0, 0, 1, 2, 3, None]


def test_equal_edges_merge(spark):
    df = frame(spark, x=[0, 0, 0, 0, 0, 0, 1, 5])
    assert column(tr.fit_equal_frequency(df, ["x"]).apply(df), "x") == [0, 0, 0, 0, 0, 0, 1, 1]
    flat = frame(spark, x=[3, 3, 3])
    assert set(column(tr.fit_equal_frequency(flat, ["x"]).apply(flat), "x")) == {0}


def test_bins_survive_increasing_transform(spark):
    rng = np.random.default_rng(2)
    x = np.exp(rng.normal(size=400))
    df = frame(spark, x=x, lnx=np.log(x))
    out = tr.fit_equal_frequency(df, ["x", "lnx"]).apply(df)
    # Only values between the two order statistics around an edge could differ.
    assert out.where("x <> lnx").count() == 0


def test_equal_width(spark):
    df = frame(spark, x=[0, 1, 2, 3, 4])
    assert column(tr.fit_equal_width(df, ["x"], 4).apply(df), "x") == [0, 0, 1, 2, 3]


def test_imputation_uses_training_values_and_keeps_empty_columns(spark):
    df = frame(spark, x=[1, 2, None, 6], z=[None] * 4)
    assert column(tr.fit_impute_mean(df, ["x", "z"]).apply(df), "x") == [1, 2, 3, 6]
    assert column(tr.fit_impute_median(df, ["x", "z"]).apply(df), "x") == [1, 2, 2, 6]
    assert column(tr.fit_impute_median(df, ["x", "z"]).apply(df), "z") == [None] * 4


def test_log_only_for_skewed_positive_columns(spark):
    rng = np.random.default_rng(3)
    skewed = np.exp(rng.normal(size=300))
    df = frame(spark, skewed=skewed, shifted=skewed - 5, even=np.linspace(1, 2, 300))
    step = tr.fit_log(df, ["skewed", "shifted", "even"])
    assert step.params["columns"] == "skewed"
    assert column(step.apply(df), "skewed")[0] == pytest.approx(math.log(skewed[0]))


def test_joint_impute_and_log_equals_separate(spark):
    rng = np.random.default_rng(4)
    x = [None if i % 3 == 0 else float(v) for i, v in enumerate(np.exp(rng.normal(size=300) * 0.4))]
    df = frame(spark, x=x).cache()
    for threshold in (0.5, 0.8, 1.0, 1.2, 1.4):
        impute, log = tr.fit_mean_impute_and_log(df, ["x"], threshold)
        first = tr.fit_impute_mean(df, ["x"])
        assert log.params["columns"] == tr.fit_log(first.apply(df), ["x"], threshold).params["columns"]
        assert impute.params == first.params


def test_scalers(spark):
    df = frame(spark, x=TIES, flat=[5] * 8)
    z = np.array(column(tr.fit_scale_standard(df, ["x", "flat"]).apply(df), "x"))
    assert z.mean() == pytest.approx(0) and z.std() == pytest.approx(1)
    assert set(column(tr.fit_scale_standard(df, ["x", "flat"]).apply(df), "flat")) == {0.0}
    r = column(tr.fit_scale_robust(df, ["x", "flat"]).apply(df), "x")
    assert r == pytest.approx([(v - 3.5) / 5.5 for v in TIES])
    m = column(tr.fit_scale_minmax(df, ["x", "flat"]).apply(df), "x")
    assert min(m) == 0 and max(m) == 1


def _yj(x, lam):
    out = np.empty_like(x)
    pos = x >= 0
    out[pos] = np.log1p(x[pos]) if lam == 0 else ((1 + x[pos]) ** lam - 1) / lam
    out[~pos] = -np.log1p(-x[~pos]) if lam == 2 else -((1 - x[~pos]) ** (2 - lam) - 1) / (2 - lam)
    return out


def _llf(x, lam):
    return -len(x) / 2 * np.log(_yj(x, lam).var()) + (lam - 1) * (np.sign(x) * np.log1p(np.abs(x))).sum()


@pytest.mark.parametrize("lam", [-1.0, 0.0, 0.5, 1.0, 2.0, 3.0])
def test_yeo_johnson_values(spark, lam):
    x = np.array([-3.0, -0.5, 0.0, 0.5, 3.0])
    df = frame(spark, x=x)
    np.testing.assert_allclose(column(tr.fit_yeo_johnson(df, ["x"], lam).apply(df), "x"), _yj(x, lam), rtol=1e-12, atol=1e-15)


def test_yeo_johnson_fit_is_the_likeliest_power(spark):
    rng = np.random.default_rng(6)
    data = {"gamma": rng.gamma(2, 3, 600), "mirrored": -rng.gamma(2, 3, 600), "normal": rng.normal(size=600),
            "steep": 100 + rng.normal(size=600), "few": rng.integers(0, 4, 600)}
    df = frame(spark, **data, flat=[2.0] * 600).repartition(5)
    got = power_fit.fit_lambdas(df, [*data, "flat"])
    grid_only = power_fit.best_on_grid(df, list(data), power_fit.COARSE)
    assert got["flat"] == 1.0
    for c, x in data.items():
        x = x.astype(float)
        best = max(_llf(x, lam) for lam in np.arange(got[c] - 0.3, got[c] + 0.3, 0.001))
        assert _llf(x, got[c]) >= best - 1e-3, c
        assert _llf(x, got[c]) >= _llf(x, grid_only[c]) - 1e-9, c


def test_pruning(spark):
    n = 100
    base = list(range(n))
    gaps = [None if i % 7 == 0 else i for i in base]
    df = frame(spark, a=base, copy=base, changed=[*base[:-1], -1], gaps=gaps, gaps_copy=gaps,
               constant=[1] * n, nearly=[1] * 96 + [2, 3, 4, 5], empty=[None] * n)
    columns = [c for c in df.columns if c != "id"]
    constant, duplicate = selection.fit_prune(df, ["id"], columns, 0.95)
    assert constant.params["dropped"] == "constant,nearly"
    assert duplicate.params["dropped"] == "copy,gaps_copy"
    kept = selection.fit_prune(df, ["id"], columns, 0.98)[0]
    assert kept.params["dropped"] == "constant"
    low = selection.fit_prune(df, ["id"], ["a", "nearly"], 0.4)[0]
    assert low.params["dropped"] == "nearly"
    with pytest.raises(ValueError):
        selection.fit_prune(df, ["id"], ["constant"], 0.95)


@pytest.mark.parametrize(("raw", "keep"), [(1, 1), (10, 10), (11, 11), (20, 20), (50, 20), (51, 40), (62, 49), (63, 50), (100, 50)])
def test_number_of_kept_features(raw, keep):
    assert selection.features_to_keep(raw) == keep


def test_interactions(spark):
    df = frame(spark, a=[2], b=[3], c=[5])
    step = tr.interaction_step(["a", "b", "c"])
    assert list(step.apply(df).select(*step.features).first()) == [2, 3, 5, 6, 10, 15]
    assert list(step.features) == [f"poly_{i}" for i in range(6)]


def test_mutual_information_finds_the_driver(spark):
    rng = np.random.default_rng(8)
    x, noise = rng.normal(size=2000), rng.normal(size=2000)
    df = frame(spark, noise=noise, x=x, y=np.abs(x)).repartition(3)
    spec = FeatureSpec(("id",), ("noise", "x"), "y")
    step, scores = selection.fit_select(df, spec, 1)
    assert list(step.features) == ["x"] and scores.count() == 2
    step, _ = selection.fit_select(df, spec, 1, selection.f_scores)
    assert len(step.features) == 1


def test_caps(spark):
    df = frame(spark, x=[*range(1, 10), 100], empty=[None] * 10)
    out = column(tr.fit_cap_outliers(df, ["x", "empty"]).apply(df), "x")
    assert out[:-1] == list(range(1, 10)) and out[-1] == pytest.approx(7.75 + 1.5 * 4.5)


def test_encoders(spark):
    df = spark.createDataFrame([(0, "b", 1.0), (1, "a", 5.0), (2, "b", 3.0), (3, None, 0.0)], "id int, c string, y double")
    hot = encoders.encode_onehot(df, "c")
    assert hot.columns == ["id", "y", "c_a", "c_b"]
    assert [tuple(r) for r in hot.orderBy("id").select("c_a", "c_b").collect()] == [(0, 1), (1, 0), (0, 1), (0, 0)]
    codes = encoders.encode_ordinal(df, "c", "y")
    assert [r["c_code"] for r in codes.orderBy("id").collect()] == [0, 1, 0, None]
    assert [r["c_code"] for r in encoders.encode_ordinal(df, "c").orderBy("id").collect()] == [1, 0, 1, None]
    with pytest.raises(ValueError):
        encoders.encode_onehot(df, "c", column_limit=1)
    wide = encoders.encode_onehot(df.dropna(), "c", form="vector")
    assert "c_onehot" in wide.columns
    filled = tr.fit_impute_categorical(df, ["c"], "frequent").apply(df)
    assert filled.where(F.col("c") == "b").count() == 3


def test_p_values_of_f_scores(spark):
    """Closed forms for one and two degrees of freedom, table values beyond, and the normal tail for very many."""
    closed = [(t * t, 1, 1 - 2 / math.pi * math.atan(t)) for t in (1e-6, 0.3, 1.0, 1.7, 5.0, 1e3)]
    closed += [(t * t, 2, 1 - t / math.sqrt(t * t + 2)) for t in (1e-6, 0.3, 1.0, 1.7, 5.0, 1e3)]
    closed += [(2.228138852**2, 10, 0.05), (3.169272667**2, 10, 0.01), (2.042272456**2, 30, 0.05), (2.749995654**2, 30, 0.01), (4.0 * 0, 7, 1.0)]
    closed += [(t * t, 10**10, math.erfc(t / math.sqrt(2))) for t in (0.1, 1.0, 1.7, 1.8, 3.0, 8.0)]
    df = spark.createDataFrame([(float(f), d, p) for f, d, p in closed], "f double, d bigint, p double")
    for r in df.withColumn("got", f_tail(F.col("f"), F.col("d"))).collect():
        assert r["got"] == pytest.approx(r["p"], rel=2e-7), r
    rows = [(1.0, 2.0, 1.0, None, 1.0), (2.0, 4.0, 1.0, None, 5.0), (3.0, 6.1, 1.0, 2.0, 3.0), (4.0, 7.9, 1.0, 1.0, None)]
    table = spark.createDataFrame(rows, "`y` double, `a.b` double, flat double, few double, gap double")
    got = {r["feature"]: r for r in selection.f_scores(table, FeatureSpec((), ("a.b", "flat", "few", "gap", "y"), "y")).collect()}
    r2 = np.corrcoef([1, 2, 3, 4], [2, 4, 6.1, 7.9])[0, 1] ** 2
    t = math.sqrt(r2 * 2 / (1 - r2))
    assert got["a.b"]["score"] == pytest.approx(t * t) and got["a.b"]["p_value"] == pytest.approx(1 - t / math.sqrt(t * t + 2))
    assert got["flat"]["score"] is None and got["flat"]["p_value"] is None and got["few"]["score"] is None
    t = math.sqrt(0.25 / 0.75)
    assert got["gap"]["p_value"] == pytest.approx(1 - 2 / math.pi * math.atan(t))
    assert (got["y"]["score"], got["y"]["p_value"]) == (math.inf, 0.0)


def test_powers_far_out_are_found_and_a_likelihood_without_optimum_is_told(spark, monkeypatch):
    x = [1e-3 * math.log(i / 200 + 1.3) ** -2 for i in range(200)]
    df = frame(spark, small=x, plain=[v * 1e3 for v in x])
    found = power_fit.fit_lambdas(df, ["small", "plain"])
    grid = [found["small"] * (1 + k / 100) for k in (-5, 0, 5)]
    scores = {r["l"]: r["llf"] for r in power_fit.log_likelihoods(df, ["small"], {"small": grid}).collect()}
    assert abs(found["small"]) > 40 and scores[1] > max(scores[0], scores[2])
    monkeypatch.setattr(power_fit, "WIDEST", 2.0)
    with pytest.warns(UserWarning, match="no optimum"):
        assert power_fit.fit_lambdas(df, ["small"]) == {"small": 1.0}
