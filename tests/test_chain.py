import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from tabfeat.operators import split
from tabfeat.plans.chain import ChainEstimator, ChainOptions, FeatureChain
from tabfeat.plans.models import Regressor
from tabfeat.plans.runs import run_grid, save_grid
from tabfeat.sources.io import load_results
from tabfeat.spec import FeatureSpec
from tabfeat.streaming.apply import prepared_stream, read_feature_stream, write_features

QUICK = ChainOptions(lambdas=0.5)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("kind", ["basic", "advanced"])
def test_transform_keeps_rows_and_repeats(sample, sample_spec, kind):
    chain = FeatureChain(kind, ChainOptions(mi_bins=4)).fit(sample, sample_spec)
    assert chain.fitted
    once, twice = chain.transform(sample), chain.transform(sample)
    assert once.count() == 100 and rows(once) == rows(twice)
    assert set(chain.feature_names()) <= set(once.columns)
    assert once.select(*chain.feature_names()).dropna().count() == 100


def test_unfitted_and_targetless_chains_are_refused(sample, sample_spec):
    chain = FeatureChain("basic")
    for call in (lambda: chain.transform(sample), chain.feature_names, lambda: chain.info(sample.sparkSession), chain.importance):
        with pytest.raises(ValueError):
            call()
    with pytest.raises(ValueError, match="target"):
        FeatureChain("advanced").fit(sample, type(sample_spec)(("id",), sample_spec.features))
    with pytest.raises(ValueError):
        FeatureChain("other")


def test_fit_never_sees_other_splits(sample, sample_spec):
    df = split.split_exact(sample, sample_spec).cache()
    changed = df.withColumn("feature_1", F.when(F.col("split") == "train", F.col("feature_1")).otherwise(1e6))
    for kind in ("basic", "advanced"):
        one = FeatureChain(kind, QUICK).fit(df, sample_spec)
        two = FeatureChain(kind, QUICK).fit(changed, sample_spec)
        assert [s.params for s in one.steps] == [s.params for s in two.steps]


def test_switches(sample, sample_spec):
    bare = ChainOptions(transformations=False, discretization=False, scaling=False)
    assert [s.name for s in FeatureChain("basic", bare).fit(sample, sample_spec).steps] == ["impute", "drop_constant", "drop_duplicates"]
    capped = FeatureChain("advanced", ChainOptions(lambdas=1.0, cap_fence=1.5, selection=False)).fit(sample, sample_spec)
    assert [s.name for s in capped.steps] == ["impute", "cap", "drop_constant", "drop_duplicates", "yeo_johnson", "interact", "scale"]
    assert len(capped.feature_names()) == 15
    with pytest.raises(ValueError):
        capped.importance()


def test_chain_is_an_ml_stage(sample, sample_spec):
    model = Pipeline(stages=[ChainEstimator(sample_spec, "basic", QUICK)]).fit(sample)
    assert model.transform(sample).count() == 100


def test_fitted_chain_on_a_stream(spark, sample, sample_spec, tmp_path):
    chain = FeatureChain("basic", QUICK).fit(sample, sample_spec)
    sample.write.parquet(f"{tmp_path}/in")
    stream = read_feature_stream(spark, f"{tmp_path}/in", sample.schema)
    query = write_features(prepared_stream(stream, sample_spec, chain, split.SplitOptions()), f"{tmp_path}/out", f"{tmp_path}/state")
    assert query.awaitTermination(120)
    expected = chain.transform(split.split_hash(sample, sample_spec))
    assert rows(spark.read.parquet(f"{tmp_path}/out").select(*expected.columns)) == rows(expected)


def test_grid_reports_failures_as_rows(sample, sample_spec):
    df = split.split_exact(sample, sample_spec).cache()
    grid = run_grid(df, sample_spec, {"good": Regressor("ridge"), "bad": {"n_trials": 2, "families": ["unheard"]}},
                    chains=("basic",), options=QUICK)
    assert [r["experiment"] for r in grid.failures.collect()] == ["bad_basic"]
    assert {r["model"] for r in grid.metrics.collect()} == {"good_basic"} and grid.metrics.count() == 30
    assert grid.comparison.count() == 1 and grid.best.first()["model"] == "good_basic"
    assert grid.info.first()["n_rows"] == 100 and grid.importance_summary.count() > 0


def test_grid_is_stored_and_read_back(spark, sample, sample_spec, tmp_path):
    df = split.split_exact(sample, sample_spec).cache()
    grid = run_grid(df, sample_spec, {"one": Regressor("ridge"), "two": Regressor("linear_regression")},
                    chains=("basic",), options=QUICK)
    save_grid(grid, f"{tmp_path}/grid")
    one = next(iter(grid.results.values()))
    scores, predictions = load_results(spark, f"{tmp_path}/grid", one.predictions.schema)
    assert rows(scores.select(*grid.metrics.columns)) == rows(grid.metrics) and predictions.count() == 2 * one.predictions.count()
    assert spark.read.option("header", True).csv(f"{tmp_path}/grid/comparison").count() == 2
    assert spark.read.option("header", True).csv(f"{tmp_path}/grid/info").first()["n_rows"] == "100"


def test_grid_without_a_single_success_is_empty(sample, sample_spec, tmp_path):
    df = split.split_exact(sample, sample_spec).cache()
    grid = run_grid(df, sample_spec, {"bad": {"n_trials": 1, "families": ["unheard"]}}, chains=("basic",), options=QUICK)
    save_grid(grid, f"{tmp_path}/grid")
    assert grid.comparison.count() == 0 and grid.best.first()["model"] is None and grid.failures.count() == 1


@pytest.mark.parametrize("kind", ["basic", "advanced"])
def test_a_fit_works_out_its_training_rows_once(spark, kind):
    counted = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def price(i):
        counted.add(1)
        return float(i * 37 % 101)

    rows = spark.range(200).select("id", price("id").alias("a"), (F.col("id") % 13).cast("double").alias("b"),
                                   (F.col("id") * 1.5).alias("y"))
    FeatureChain(kind, ChainOptions(lambdas=0.5)).fit(rows, FeatureSpec(("id",), ("a", "b"), "y"))
    assert counted.value == 200
