"""Every operator as a query over the given tables."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabfeat.fixed_values import METRICS
from tabfeat.operators import encoders, metrics, plotdata, profile, quality, selection, split, transformers
from tabfeat.operators.power_fit import best_on_grid, fit_lambdas, log_likelihoods
from tabfeat.operators.split import SplitOptions
from tabfeat.plans import models, runs, search
from tabfeat.plans.chain import ChainOptions, FeatureChain
from tabfeat.plans.models import Regressor
from tabfeat.session import scratch_path, tiny_table
from tabfeat.sources import frames, io
from tabfeat.sources.frames import (
    ACCOUNTS, EVENTS, LINE, LINE_INTER, LINE_KEY, PARTS,
)
from tabfeat.spec import FeatureSpec, training_rows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
PRICE_ONLY = LINE.with_features(("l_extendedprice",))
GRID = tuple(i / 2 for i in range(-4, 5))
SEARCHED = ["linear_regression", "ridge", "lasso", "elastic_net"]
FIXED = ChainOptions(lambdas=0.5)


def query(function: Query) -> Query:
    """Register a query; whole numbers become bigint and decimals are rounded, as in the SQL."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return tidy(function(spark, folder))

    run.__name__ = function.__name__
    QUERIES[function.__name__] = run
    return run


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c, digits) + F.lit(0.0)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType)):
            c = c.cast("bigint")
        columns.append(c.alias(f.name))
    return df.select(*columns)


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.select(*[F.round(c, digits[c]).alias(c) if c in digits else F.col(c) for c in df.columns])


def _fit_on_train(df: DataFrame, spec: FeatureSpec, fit, *args) -> DataFrame:
    step = fit(training_rows(df, spec), list(spec.features), *args)
    return step.apply(df).select(*spec.key, *step.features)


# --- sources, sinks, previews -------------------------------------------------------------

@query
def load_features(spark, folder):
    spec = FeatureSpec(("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"),
                       ("l_quantity", "l_discount", "l_tax"), "l_extendedprice")
    return io.load_features(spark, f"{folder}/lineitem.parquet", spec)


@query
def inject_missing(spark, folder):
    return frames.line_null(spark, folder).select(*LINE_KEY, "l_quantity")


@query
def save_splits(spark, folder):
    path = scratch_path(spark, "splits")
    df = frames.line_split(spark, folder)
    io.save_splits(df, LINE, path)
    return (io.load_splits(spark, path, df.schema).groupBy("split")
            .agg(F.count("*").alias("n_rows"), F.sum("price_cents").alias("cents"),
                 F.count_if(F.col("l_quantity").isNull()).alias("missing")))


@query
def load_splits(spark, folder):
    path = scratch_path(spark, "splits")
    df = frames.line_split(spark, folder)
    io.save_splits(df, LINE, path, "csv")
    return io.load_splits(spark, path, df.schema, "csv", "val").select(*LINE_KEY, *LINE.features, "charge", "split")


@query
def save_results(spark, folder):
    path = scratch_path(spark, "results")
    rows = _predictions(spark, folder)
    io.save_results(metrics.all_metrics(rows, LINE_KEY), rows, path)
    return io.load_results(spark, path, rows.schema)[0]


@query
def load_results(spark, folder):
    path = scratch_path(spark, "results")
    rows = _predictions(spark, folder)
    io.save_results(metrics.one_metric(rows, "rmse"), rows, path)
    return io.load_results(spark, path, rows.schema)[1].select("model", "split", *LINE_KEY, "y", "pred")


@query
def export_comparison(spark, folder):
    path = scratch_path(spark, "comparison")
    table = metrics.compare_models(_metrics(spark, folder))
    io.export_table(table, path)
    return spark.read.schema(table.schema).option("header", True).csv(path)


@query
def preview_rows(spark, folder):
    return profile.preview_rows(frames.line(spark, folder), LINE)


# --- profiling ----------------------------------------------------------------------------

@query
def data_info(spark, folder):
    return profile.data_info(frames.line_null(spark, folder), LINE)


@query
def missing_by_column(spark, folder):
    return profile.missing_by_column(frames.line_null(spark, folder), [*LINE.features, "charge"])


@query
def missing_total(spark, folder):
    return profile.missing_total(frames.line_null(spark, folder), [*LINE.features, "charge"])


@query
def corr_matrix(spark, folder):
    return profile.corr_matrix(frames.line_null(spark, folder), [*LINE.features, "charge"])


@query
def hist_target(spark, folder):
    return profile.histograms(frames.line(spark, folder), ["charge"], 30)


@query
def hist_features(spark, folder):
    return profile.histograms(frames.line_null(spark, folder), list(LINE.features[:4]), 20)


# --- splitting ----------------------------------------------------------------------------

@query
def split_exact(spark, folder):
    return frames.line_split(spark, folder).select(*LINE_KEY, "split")


@query
def split_hash(spark, folder):
    return split.split_hash(frames.line(spark, folder), LINE).select(*LINE_KEY, "split")


@query
def prepare_data(spark, folder):
    df = runs.prepare_data(frames.line(spark, folder), LINE, scratch_path(spark, "prepared"),
                           SplitOptions(), "l_quantity", 0.05)
    return df.select(*LINE_KEY, "l_quantity", "charge", "split")


@query
def run_single(spark, folder):
    df = frames.line_split(spark, folder)
    result = runs.run_single(df, PRICE_ONLY, "basic", Regressor("linear_regression"), FIXED)
    return rounded(result.metrics, value=4)


@query
def run_grid(spark, folder):
    """Two whole chains by two models: least squares, and a search of a hundred trials over all families, five folds each."""
    df = frames.line_inter_split(spark, folder).persist()
    grid = runs.run_grid(df, LINE_INTER, {"classical": Regressor("linear_regression"),
                                          "automl": {"n_trials": 100, "timeout": math.inf}})
    df.unpersist()
    return grid.metrics


@query
def grid_comparison(spark, folder):
    """Two linear models on one chain, compared: SQL knows their solutions."""
    df = frames.line_split(spark, folder).persist()
    grid = runs.run_grid(df, PRICE_ONLY, {"plain": Regressor("linear_regression"), "shrunk": Regressor("ridge", {"alpha": 2e4})},
                         chains=("basic",), options=FIXED)
    df.unpersist()
    return tidy(grid.comparison, 3)


# --- feature transformers -----------------------------------------------------------------

@query
def impute_mean(spark, folder):
    return _fit_on_train(frames.line_split(spark, folder), LINE, transformers.fit_impute_mean)


@query
def impute_median(spark, folder):
    return _fit_on_train(frames.line_split(spark, folder), LINE, transformers.fit_impute_median)


@query
def log_skewed(spark, folder):
    return _fit_on_train(frames.events(spark, folder), EVENTS, transformers.fit_log)


@query
def power(spark, folder):
    df = frames.events(spark, folder)
    return transformers.power_step(["value", "day"], 0.5).apply(df).select("event_id", "value", "day")


@query
def yeo_johnson_grid(spark, folder):
    """Log-likelihood per row of every power on a fixed grid."""
    columns = list(ACCOUNTS.features)
    table = log_likelihoods(frames.accounts(spark, folder), columns, dict.fromkeys(columns, GRID))
    names = F.array(*[F.lit(c) for c in columns])
    return table.select(F.get(names, F.col("c")).alias("feature"), "lam", (F.col("llf") / F.col("n")).alias("llf"))


@query
def yeo_johnson(spark, folder):
    """The best power of the fixed grid, applied."""
    df = frames.accounts(spark, folder)
    lambdas = best_on_grid(df, list(ACCOUNTS.features), GRID)
    step = transformers.fit_yeo_johnson(df, list(ACCOUNTS.features), lambdas)
    return step.apply(df).select("c_custkey", *ACCOUNTS.features)


@query
def yeo_johnson_fit(spark, folder):
    """Powers refined beyond the grid."""
    found = fit_lambdas(frames.events(spark, folder), list(EVENTS.features))
    return tiny_table(spark, found.items(), "feature string, lam double")


@query
def bin_equal_freq(spark, folder):
    return _fit_on_train(frames.line_split(spark, folder), LINE, transformers.fit_equal_frequency)


@query
def bin_equal_width(spark, folder):
    return _fit_on_train(frames.events(spark, folder), EVENTS, transformers.fit_equal_width, 5)


@query
def scale_standard(spark, folder):
    return _fit_on_train(frames.line_split(spark, folder), LINE, transformers.fit_scale_standard)


@query
def scale_robust(spark, folder):
    return _fit_on_train(frames.line_split(spark, folder), LINE, transformers.fit_scale_robust)


@query
def scale_minmax(spark, folder):
    return _fit_on_train(frames.line_split(spark, folder), LINE, transformers.fit_scale_minmax)


@query
def cap_outliers(spark, folder):
    df = frames.table(spark, folder, "documents").select("doc_id", F.col("n_chars").cast("double").alias("n_chars"))
    return transformers.fit_cap_outliers(df, ["n_chars"]).apply(df)


def _prunable(spark, folder):
    """Lineitem columns with constants, near-constants and copies among them."""
    return frames.line(spark, folder).select(
        *LINE_KEY, "l_quantity", F.col("l_quantity").alias("quantity_again"),
        (F.col("l_quantity") * 0 + 1).alias("always_one"),
        (F.col("l_quantity") == 1).cast("double").alias("single"),
        "l_tax", (F.col("l_tax") * 2).alias("tax_twice"),
        F.when(F.col("l_linenumber") > 1, F.col("l_tax")).alias("tax_gaps"),
        F.when(F.col("l_linenumber") > 1, F.col("l_tax")).alias("tax_gaps_again"))


_PRUNABLE = ("l_quantity", "quantity_again", "always_one", "single", "l_tax", "tax_twice", "tax_gaps", "tax_gaps_again")


def _kept(spark, step, columns):
    return tiny_table(spark, [(c, c in step.outputs) for c in columns], "column string, kept boolean")


@query
def drop_constant(spark, folder):
    df = _prunable(spark, folder)
    (step,) = selection.fit_prune(df, LINE_KEY, _PRUNABLE, 0.95, duplicate=False)
    return _kept(spark, step, _PRUNABLE)


@query
def drop_duplicates_cols(spark, folder):
    df = _prunable(spark, folder)
    (step,) = selection.fit_prune(df, LINE_KEY, _PRUNABLE, 0.95, constant=False)
    return _kept(spark, step, _PRUNABLE)


@query
def majority_shares(spark, folder):
    """The share of the most frequent value, counted, as tolerances up to one half need it."""
    shares = selection.majority_shares(_prunable(spark, folder), list(_PRUNABLE))
    return tiny_table(spark, shares.items(), "column string, share double")


@query
def poly_interactions(spark, folder):
    step = transformers.interaction_step(LINE_INTER.features)
    return step.apply(frames.line_inter(spark, folder)).select(*LINE_KEY, *step.features)


@query
def mi_scores(spark, folder):
    return selection.mi_scores(frames.line_inter(spark, folder), LINE_INTER)


@query
def f_scores(spark, folder):
    return rounded(selection.f_scores(frames.line_inter(spark, folder), LINE_INTER), score=2)


@query
def select_mi(spark, folder):
    df = frames.line_inter(spark, folder)
    step, _ = selection.fit_select(df, LINE_INTER, 2)
    return step.apply(df).select(*LINE_KEY, F.explode(F.create_map(
        *[x for c in step.features for x in (F.lit(c), F.col(c))])).alias("feature", "value"))


@query
def basic_chain(spark, folder):
    df = frames.line_split(spark, folder)
    chain = FeatureChain("basic", FIXED).fit(df, LINE)
    return chain.transform(df).select(*LINE_KEY, "split", *chain.feature_names())


def _advanced(spark, folder):
    df = frames.line_inter_split(spark, folder)
    return df, FeatureChain("advanced", FIXED).fit(df, LINE_INTER)


@query
def advanced_chain(spark, folder):
    """One row per kept feature and input row, so that the SQL can choose the features by score too."""
    df, chain = _advanced(spark, folder)
    cells = F.create_map(*[x for c in chain.feature_names() for x in (F.lit(c), F.col(c))])
    return chain.transform(df).select(*LINE_KEY, F.explode(cells).alias("feature", "value"))


@query
def chain_info(spark, folder):
    _, chain = _advanced(spark, folder)
    return chain.info(spark).select("pos", "step", "type", F.concat_ws(",", "variables").alias("variables"), "n_output")


@query
def feature_names(spark, folder):
    _, chain = _advanced(spark, folder)
    return tiny_table(spark, enumerate(chain.feature_names()), "position int, feature string")


@query
def mi_importance(spark, folder):
    _, chain = _advanced(spark, folder)
    return chain.importance()


@query
def impute_categorical(spark, folder):
    df = frames.accounts(spark, folder).select(
        "c_custkey", F.when(F.col("nation") >= 5, F.col("c_mktsegment")).alias("constant"),
        F.when(F.col("nation") >= 5, F.col("c_mktsegment")).alias("frequent"))
    df = transformers.fit_impute_categorical(df, ["constant"]).apply(df)
    return transformers.fit_impute_categorical(df, ["frequent"], "frequent").apply(df)


@query
def encode_onehot(spark, folder):
    return encoders.encode_onehot(frames.accounts(spark, folder).select("c_custkey", "c_mktsegment"), "c_mktsegment")


@query
def encode_ordinal(spark, folder):
    df = frames.accounts(spark, folder).select("c_custkey", "c_acctbal", "c_mktsegment")
    return encoders.encode_ordinal(df, "c_mktsegment", "c_acctbal", "code").select("c_custkey", "code")


# --- models -------------------------------------------------------------------------------

def _coefficients(spark, folder, kind, **params):
    fitted = Regressor(kind, params).fit(frames.line_split(spark, folder), PRICE_ONLY)
    m = fitted.spark_model
    return tiny_table(spark, [(kind, float(m.coefficients[0]), float(m.intercept))],
                      "model string, slope double, intercept double")


@query
def fit_linear(spark, folder):
    return rounded(_coefficients(spark, folder, "linear_regression"), intercept=4)


@query
def fit_ridge(spark, folder):
    return rounded(_coefficients(spark, folder, "ridge", alpha=1e12), intercept=4)


@query
def fit_lasso(spark, folder):
    return rounded(_coefficients(spark, folder, "lasso", alpha=1e8), slope=5, intercept=1)


@query
def fit_elastic_net(spark, folder):
    return rounded(_coefficients(spark, folder, "elastic_net", alpha=1e8, l1_ratio=0.5), slope=5, intercept=1)


def _fitted(spark, folder, kind, spec=LINE_INTER, **params):
    df = frames.line_inter_split(spark, folder)
    return df, Regressor(kind, params).fit(df, spec)


def _fit_metrics(spark, folder, kind, **params):
    df, model = _fitted(spark, folder, kind, **params)
    return metrics.all_metrics(model.predictions(df), LINE_KEY)


@query
def fit_random_forest(spark, folder):
    return _fit_metrics(spark, folder, "random_forest")


@query
def fit_gbt(spark, folder):
    return _fit_metrics(spark, folder, "gradient_boosting")


@query
def fit_decision_tree(spark, folder):
    return _fit_metrics(spark, folder, "decision_tree")


@query
def fit_kernel_robust(spark, folder):
    return _fit_metrics(spark, folder, "svr")


@query
def kernel_features(spark, folder):
    """Six random cosine features of every row, scaled by the training rows."""
    df = frames.line_inter_split(spark, folder)
    lift = models.CosineFeatures.drawn(training_rows(df, LINE_INTER), LINE_INTER.features, 6, 0.25, 42)
    return (df.select(*LINE_KEY, lift.column().alias("lift"))
            .select(*LINE_KEY, *[F.col("lift")[i].alias(f"cos_{i}") for i in range(6)]))


def _by_discount(spark, folder, kind, **params):
    df, model = _fitted(spark, folder, kind, LINE_INTER.with_features(("l_discount",)), **params)
    return rounded(model.predict(df).groupBy("l_discount").agg(F.max("pred").alias("pred")), pred=4)


@query
def tree_by_discount(spark, folder):
    """What a tree of two levels predicts for every discount."""
    return _by_discount(spark, folder, "decision_tree", max_depth=2)


@query
def forest_by_discount(spark, folder):
    """Trees that draw neither rows nor features agree with the single tree."""
    return _by_discount(spark, folder, "random_forest", max_depth=2, n_estimators=3, bootstrap=False)


@query
def boosting_by_discount(spark, folder):
    """Three rounds of one split each."""
    return _by_discount(spark, folder, "gradient_boosting", max_depth=1, n_estimators=3)


@query
def tree_importance(spark, folder):
    """Shares of the squared error that the splits of a tree of two levels remove, by feature."""
    df = frames.line_split(spark, folder)
    model = Regressor("decision_tree", {"max_depth": 2}).fit(df, LINE.with_features(("l_discount", "l_tax")))
    return model.importance(df)


@query
def fit_knn(spark, folder):
    df = split.split_hash(frames.parts(spark, folder), PARTS)
    model = Regressor("knn", {"k": 5}).fit(df, PARTS)
    return model.predict(df).select("p_partkey", "split", "pred")


@query
def predict(spark, folder):
    df = frames.line_split(spark, folder)
    model = Regressor("linear_regression").fit(df, PRICE_ONLY)
    return rounded(model.predictions(df).select(*LINE_KEY, "split", "y", "pred"), pred=4)


@query
def score(spark, folder):
    df = frames.line_split(spark, folder)
    model = Regressor("linear_regression").fit(df, PRICE_ONLY)
    test = df.where(F.col("split") == "test")
    return tiny_table(spark, [("test", model.score(test))], "split string, r2 double")


@query
def model_importance(spark, folder):
    df, tree = _fitted(spark, folder, "decision_tree")
    linear = Regressor("linear_regression").fit(df, LINE_INTER)
    return tree.importance(df).unionByName(linear.importance(df))


@query
def cross_validate(spark, folder):
    df = frames.line(spark, folder)
    return rounded(search.cross_validate(df, PRICE_ONLY, Regressor("linear_regression"), 5), score=2)


@query
def cv_interval(spark, folder):
    df = frames.line(spark, folder)
    scores = search.cross_validate(df, PRICE_ONLY, Regressor("linear_regression"), 5)
    return rounded(search.confidence(scores), mean=2, std=2, low=2, high=2)


@query
def optimize(spark, folder):
    """A hundred trials of the linear families, five folds each, on one feature: SQL knows their solutions."""
    found = search.optimize(frames.line(spark, folder), PRICE_ONLY, families=SEARCHED, refit=False)
    return rounded(found.trials.select("trial", "family", "fold", "score"), score=1)


@query
def optimize_wide(spark, folder):
    """A hundred trials of all families on four features, five folds each, however long they take."""
    found = search.optimize(frames.line_inter_split(spark, folder), LINE_INTER, timeout=math.inf, refit=False)
    return found.trials.drop("seconds")


@query
def ensemble_mean(spark, folder):
    return models.ensemble_mean(_predictions(spark, folder), LINE_KEY)


@query
def pareto_trials(spark, folder):
    table = metrics.metric_table(_predictions(spark, folder), LINE_KEY, metrics=["rmse", "max_error", "mape"])
    return search.pareto_trials(table.where(F.col("split") == "test"), ["rmse", "max_error", "mape"])


# --- metrics and evaluation ---------------------------------------------------------------

def _predictions(spark, folder):
    return frames.predictions(spark, folder)


def _metrics(spark, folder):
    return metrics.all_metrics(_predictions(spark, folder), LINE_KEY)


def _one(name: str) -> Query:
    def run(spark, folder):
        return rounded(metrics.one_metric(_predictions(spark, folder), name, LINE_KEY), value=4)

    return run


for _key, _metric in (
    ("m_mse", "mse"), ("m_rmse", "rmse"), ("m_mae", "mae"), ("m_r2", "r2"), ("m_mape", "mape"), ("m_smape", "smape"),
    ("m_median_ae", "median_ae"), ("m_max_error", "max_error"), ("m_explained_variance", "explained_variance"),
    ("m_mase", "mean_absolute_scaled_error"),
):
    _run = _one(_metric)
    _run.__name__ = _key
    query(_run)


@query
def all_metrics(spark, folder):
    return rounded(_metrics(spark, folder), value=4)


@query
def metric_counts(spark, folder):
    """Predictions that lack a target where the quantity is missing, and a prediction for large discounts."""
    rows = frames.line_null(spark, folder).select(
        F.lit("net_price").alias("model"), F.when(F.col("line_no") > 3, "test").otherwise("val").alias("split"),
        F.when(F.col("l_quantity").isNotNull(), F.col("charge")).alias("y"),
        F.when(F.col("l_discount") < 0.09, F.col("l_extendedprice")).alias("pred"))
    return metrics.scored_counts(rows)


@query
def evaluate_model(spark, folder):
    df = frames.line_split(spark, folder)
    model = Regressor("linear_regression").fit(df, PRICE_ONLY)
    return rounded(runs.evaluate_model(model, df)[0], value=3)


@query
def mase_by_time(spark, folder):
    """Scaled error of a running forecast, in event order."""
    df = frames.events(spark, folder).select(
        F.lit("half_day").alias("model"), F.lit("all").alias("split"), "ts", "event_id",
        F.col("value").alias("y"), (F.col("hour") / 2).alias("pred"))
    return metrics.one_metric(df, "mean_absolute_scaled_error", EVENTS.order_by)


@query
def compare_models(spark, folder):
    return tidy(metrics.compare_models(_metrics(spark, folder)), 4)


@query
def best_model(spark, folder):
    long = _metrics(spark, folder)
    best = [metrics.best_model(long, m) for m in METRICS]
    return rounded(reduce(DataFrame.unionByName, best), value=4)


@query
def predictions_of(spark, folder):
    return metrics.predictions_of(_predictions(spark, folder), "net_price").drop("line_no")


def _importance(spark, folder):
    """Correlations as importances of two models, one of which does not know every feature."""
    df = frames.line(spark, folder)
    rows = [("pearson", c, F.abs(F.corr(c, "charge"))) for c in LINE.features]
    rows += [("quantity", c, F.abs(F.corr(c, "l_quantity"))) for c in LINE.features if c != "l_quantity"]
    flat = df.agg(*[e.alias(f"v{i}") for i, (_, _, e) in enumerate(rows)])
    return flat.select(F.inline(F.array(*[F.struct(
        F.lit(m).alias("model"), F.lit(f).alias("feature"), F.col(f"v{i}").alias("importance"))
        for i, (m, f, _) in enumerate(rows)])))


@query
def importance_pivot(spark, folder):
    return metrics.importance_pivot(_importance(spark, folder))


@query
def top_features(spark, folder):
    table = metrics.importance_pivot(_importance(spark, folder))
    return metrics.top_features(table, 3, "average").select("feature", "average")


@query
def format_metrics(spark, folder):
    table = metrics.metric_table(_predictions(spark, folder), LINE_KEY, metrics=["rmse", "r2", "mae"])
    return metrics.format_metrics(metrics.to_long(table, metrics=["rmse", "r2", "mae"]), 2).drop("value")


@query
def group_metrics(spark, folder):
    table = metrics.segment_spread(_predictions(spark, folder), LINE_KEY, "line_no")
    return rounded(table, lowest=3, highest=3, spread=3)


# --- quality, privacy, bias ---------------------------------------------------------------

def _messy(spark, folder):
    """Lineitem columns with gaps, a constant, heavy tails and repeated rows."""
    price, number = F.col("l_extendedprice"), F.col("l_linenumber")
    return frames.table(spark, folder, "lineitem").select(
        "l_returnflag", "l_linestatus", "l_linenumber", "l_quantity",
        F.when(number >= 6, F.col("l_tax")).alias("sparse_tax"),
        (F.col("l_quantity") * 0 + 1).alias("always_one"),
        F.when(number == 7, F.floor(price / 1000) * 1000).otherwise(F.lit(50.0)).alias("tail"))


@query
def q_high_missing(spark, folder):
    return quality.high_missing(_messy(spark, folder))


@query
def q_constant(spark, folder):
    return quality.constant_columns(_messy(spark, folder))


@query
def q_duplicate_rows(spark, folder):
    return quality.duplicate_rows(_messy(spark, folder))


@query
def q_duplicate_rows_hashed(spark, folder):
    return quality.duplicate_rows(_messy(spark, folder), method="hash")


@query
def q_outliers(spark, folder):
    return quality.high_outliers(_messy(spark, folder))


@query
def q_outlier_shares(spark, folder):
    return quality.outlier_shares(_messy(spark, folder))


@query
def data_quality(spark, folder):
    return quality.data_quality(_messy(spark, folder))


@query
def pii_columns(spark, folder):
    return quality.pii_columns(frames.table(spark, folder, "documents"))


@query
def pii_email(spark, folder):
    return quality.pii_email(frames.table(spark, folder, "documents"))


@query
def pii_email_strict(spark, folder):
    return quality.pii_email(frames.table(spark, folder, "documents"), mode="strict")


@query
def pii_phone(spark, folder):
    return quality.pii_phone(frames.table(spark, folder, "documents"))


@query
def pii_phone_strict(spark, folder):
    return quality.pii_phone(frames.table(spark, folder, "documents"), mode="strict")


@query
def privacy_check(spark, folder):
    found = quality.privacy_check(frames.table(spark, folder, "documents"))
    return quality.check_status(found, ["privacy"])


@query
def mask_pii(spark, folder):
    df = frames.table(spark, folder, "documents").select("doc_id", F.col("doc_id").alias("person"), "text")
    masked = quality.mask_pii(df, ["text"], ["person"], "pepper")
    return masked.select("doc_id", "person", F.length("text").alias("length"), F.md5("text").alias("digest"))


@query
def bias_importance(spark, folder):
    return quality.bias_importance(_importance(spark, folder))


def _narrow_predictions(spark, folder):
    rows = _predictions(spark, folder)
    flat = rows.where(F.col("model") == "net_price").withColumn("model", F.lit("flat")) \
        .withColumn("pred", 50_000 + F.col("pred") / 100)
    return rows.unionByName(flat)


@query
def bias_pred_range(spark, folder):
    return quality.bias_pred_range(_narrow_predictions(spark, folder))


@query
def bias_check(spark, folder):
    return quality.bias_check(_importance(spark, folder), _narrow_predictions(spark, folder))


def _safety(spark, folder):
    return quality.safety_findings(frames.table(spark, folder, "documents").withColumn("one", F.lit(1.0)),
                                   _narrow_predictions(spark, folder), _importance(spark, folder))


@query
def safety_status(spark, folder):
    return _safety(spark, folder)[1]


@query
def safety_rollup(spark, folder):
    return quality.safety_rollup(_safety(spark, folder)[1])


@query
def recommendations(spark, folder):
    return quality.recommendations(_safety(spark, folder)[1])


@query
def safety_report(spark, folder):
    return quality.safety_report(_safety(spark, folder)[1])


# --- plot data ----------------------------------------------------------------------------

@query
def residuals(spark, folder):
    rows = plotdata.residuals(_predictions(spark, folder))
    return rows.select("model", "split", *LINE_KEY, "y", "pred", "residual")


@query
def hist_residuals(spark, folder):
    return plotdata.residual_histogram(metrics.predictions_of(_predictions(spark, folder), "net_price"))


def _qq(spark, folder):
    return plotdata.qq_points(metrics.predictions_of(_predictions(spark, folder), "net_price"), LINE_KEY)


@query
def qq_points(spark, folder):
    return _qq(spark, folder)


@query
def qq_order(spark, folder):
    """The exact part of the probability plot: rank and ordered residual."""
    return _qq(spark, folder).select("rank", "ordered")


@query
def qq_quantiles(spark, folder):
    return plotdata.qq_quantiles(_predictions(spark, folder).where("model = 'net_price' AND split = 'test'"), 101)


@query
def qq_line(spark, folder):
    return plotdata.qq_line(_qq(spark, folder))


@query
def radar_scores(spark, folder):
    return plotdata.radar_scores(metrics.compare_models(_metrics(spark, folder)))


@query
def metric_bars(spark, folder):
    return rounded(plotdata.metric_bars(_metrics(spark, folder)), value=4)


@query
def summary_counts(spark, folder):
    return rounded(plotdata.summary_counts(_metrics(spark, folder), _importance(spark, folder)), best_rmse=4)


@query
def identity_line(spark, folder):
    return plotdata.identity_line(_predictions(spark, folder))


@query
def shape_change(spark, folder):
    df, chain = _advanced(spark, folder)
    before = df.select(*LINE_INTER.features)
    return plotdata.shape_change(before, chain.transform(df).select(*chain.feature_names()))
