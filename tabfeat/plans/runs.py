"""Experiment runs: prepare a table, run one chain with one model, run the grid."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabfeat.operators.metrics import all_metrics, best_model, compare_models, importance_pivot
from tabfeat.operators.profile import data_info
from tabfeat.operators.split import SplitOptions, split_exact, split_with_missing
from tabfeat.plans.chain import ChainOptions, FeatureChain
from tabfeat.plans.models import FittedModel, Regressor
from tabfeat.plans.search import optimize
from tabfeat.session import tiny_table
from tabfeat.sources.io import export_table, load_splits, save_results, save_splits
from tabfeat.spec import FeatureSpec, nan_to_null

log = logging.getLogger(__name__)
METRIC_ROWS = "model string, split string, metric string, value double"
IMPORTANCE_ROWS = "model string, feature string, importance double"


@dataclass
class RunResult:
    """Everything one experiment leaves: small tables are materialised, predictions stay lazy."""

    name: str
    chain: FeatureChain
    model: FittedModel
    metrics: DataFrame
    predictions: DataFrame
    importance: DataFrame


def prepare_data(df: DataFrame, spec: FeatureSpec, path: str, options: SplitOptions = SplitOptions(),
                 missing_column: str | None = None, missing_share: float = 0.0) -> DataFrame:
    """Clean, optionally null some values, split, store by split, and read the stored rows back.

    Later scans then read plain columns of one split's folder instead of hashing keys again.
    """
    df = nan_to_null(df)
    split = (split_with_missing(df, spec, options, missing_column, missing_share) if missing_share
             else split_exact(df, spec, options))
    save_splits(split, spec, path)
    return load_splits(df.sparkSession, path, split.schema, split_column=spec.split)


def evaluate_model(model: FittedModel, df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Metrics per split, and the predictions behind them."""
    predictions = model.predictions(df)
    return all_metrics(predictions, model.spec.ordering()), predictions


def run_single(df: DataFrame, spec: FeatureSpec, chain: str = "basic", model: Regressor | None = None,
               options: ChainOptions = ChainOptions(), name: str | None = None) -> RunResult:
    """Fit a chain and a model on the training split, evaluate them on all three."""
    model = model or Regressor("linear_regression")
    name = name or f"{model.kind}_{chain}"
    fitted = FeatureChain(chain, options).fit(df, spec)
    # The model's own scans and the evaluation share the features.
    features = _needed(fitted.transform(df), fitted.output_spec()).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _evaluated(name, fitted, model.fit(features, fitted.output_spec()), features)
    finally:
        features.unpersist()


def _needed(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """The columns that a model and its metrics read; what leads to the others is then not worked out."""
    named = dict.fromkeys([*spec.key, *spec.order_by, spec.split, spec.require_target(), *spec.features])
    return df.select(*[F.col(f"`{c}`") for c in named if c in df.columns])


def _evaluated(name: str, chain: FeatureChain, model: FittedModel, features: DataFrame) -> RunResult:
    model.name = name
    metrics, predictions = evaluate_model(model, features)
    spark = features.sparkSession
    rows = tiny_table(spark, [tuple(r) for r in metrics.collect()], METRIC_ROWS)
    return RunResult(name, chain, model, rows, predictions, model.importance(features))


@dataclass
class GridResult:
    """What a grid of experiments leaves; all but the predictions in ``results`` are small tables.

    ``comparison`` has a row per experiment, best test error first; ``best`` the one with the least
    (null if none was evaluated); ``importance_summary`` a column per experiment that has importances;
    ``info`` describes the table they were run on.
    """

    metrics: DataFrame
    importance: DataFrame
    failures: DataFrame
    results: Mapping[str, RunResult]
    comparison: DataFrame
    best: DataFrame
    importance_summary: DataFrame
    info: DataFrame


def save_grid(grid: GridResult, path: str) -> None:
    """Metrics and predictions in the form ``load_results`` reads; comparison, importance, failures and info as CSV."""
    parts = [r.predictions for r in grid.results.values()]
    if parts:
        save_results(grid.metrics, reduce(DataFrame.unionByName, parts), path)
    for name, rows in (("comparison", grid.comparison), ("importance", grid.importance_summary),
                       ("failures", grid.failures), ("info", grid.info)):
        export_table(rows, f"{path}/{name}")


def run_grid(df: DataFrame, spec: FeatureSpec, models: Mapping[str, Regressor | Mapping] | None = None,
             chains: Sequence[str] = ("basic", "advanced"),
             options: Mapping[str, ChainOptions] | ChainOptions = ChainOptions()) -> GridResult:
    """Every model on every chain. A failing experiment becomes a row of ``failures``.

    A chain is fitted once, and its output is kept for the models that share it. A model given
    as a mapping is a search: the mapping holds the arguments of ``optimize``.
    """
    spark = df.sparkSession
    models = models or {"classical": Regressor("linear_regression"), "automl": {"n_trials": 100}}
    results, failures = {}, []
    for chain_kind in chains:
        chosen = options if isinstance(options, ChainOptions) else options[chain_kind]
        try:
            chain = FeatureChain(chain_kind, chosen).fit(df, spec)
            features = chain.transform(df).persist(StorageLevel.MEMORY_AND_DISK)
        except Exception as error:
            failures += [(f"{m}_{chain_kind}", str(error)) for m in models]
            log.exception("chain %s failed", chain_kind)
            continue
        for label, model in models.items():
            name = f"{label}_{chain_kind}"
            try:
                if isinstance(model, Regressor):
                    fitted = model.fit(features, chain.output_spec())
                else:
                    fitted = optimize(features, chain.output_spec(), **model).model
                results[name] = _evaluated(name, chain, fitted, features)
            except Exception as error:
                failures.append((name, str(error)))
                log.exception("experiment %s failed", name)
        features.unpersist()
    scores = _collected(spark, [r.metrics for r in results.values()], METRIC_ROWS)
    importance = _collected(spark, [r.importance for r in results.values()], IMPORTANCE_ROWS)
    return GridResult(scores, importance, tiny_table(spark, failures, "experiment string, error string"), results,
                      compare_models(scores), best_model(scores), importance_pivot(importance), data_info(df, spec))


def _collected(spark: SparkSession, tables: Sequence[DataFrame], schema: str) -> DataFrame:
    """Union of tables that hold a few rows per experiment."""
    return tiny_table(spark, [tuple(r) for t in tables for r in t.collect()], schema)


