"""Regressors behind one interface: fit, predict, score, importance."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml import Model as SparkModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabfeat.operators.metrics import moment_metrics
from tabfeat.operators.transformers import column_stats
from tabfeat.plans import cells, huber
from tabfeat.plans.neighbours import nearest_mean
from tabfeat.session import shared_folder, tiny_table
from tabfeat.spec import FeatureSpec, known_target, training_rows

_VECTOR = cells.VECTOR
ROWS_A_CELL = 4  # with fewer, a forest reads the rows themselves


def assembled(df: DataFrame, features: tuple[str, ...]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=_VECTOR, handleInvalid="error").transform(df)


@dataclass
class FittedModel:
    """Predictions and scores of a trained regressor. Nothing is collected to predict."""

    name: str
    spec: FeatureSpec
    apply: Callable[[DataFrame], DataFrame]
    weights: Callable[[], Mapping[str, float]] | None = None
    spark_model: SparkModel | None = None

    def predict(self, df: DataFrame) -> DataFrame:
        """The frame with a ``pred`` column."""
        return self.apply(df)

    def predictions(self, df: DataFrame) -> DataFrame:
        """Long rows ``(model, split, key..., y, pred)`` of the rows whose target is known."""
        spec = self.spec
        split = F.col(spec.split) if spec.split in df.columns else F.lit("train")
        order = [c for c in spec.order_by if c not in spec.key]
        return self.predict(known_target(df, spec)).select(
            F.lit(self.name).alias("model"), split.alias("split"), *spec.key, *order,
            F.col(spec.target).alias("y"), F.col("pred"))

    def score(self, df: DataFrame) -> float:
        """Coefficient of determination."""
        return self.predictions(df).agg(moment_metrics()["r2"]).first()[0]

    def importance(self, df: DataFrame) -> DataFrame:
        """``(model, feature, importance)``, shares that add up to 1; empty for models without one."""
        rows = self.weights() if self.weights else {}
        total = sum(rows.values()) or 1.0
        return tiny_table(df.sparkSession, [(self.name, f, float(v) / total) for f, v in rows.items()],
                          "model string, feature string, importance double")


def _train_rows(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    return known_target(training_rows(df, spec), spec)


def _target_moments(rows: DataFrame, spec: FeatureSpec):
    return rows.agg(F.count("*").alias("n"), F.stddev_pop(spec.target).alias("pop"),
                    F.stddev_samp(spec.target).alias("samp")).first()


def _linear(estimator_of: Callable[[DataFrame, FeatureSpec, Mapping], LinearRegression]):
    def fit(df: DataFrame, spec: FeatureSpec, params: Mapping, name: str) -> FittedModel:
        rows = _train_rows(df, spec)
        model = estimator_of(rows, spec, params).setFeaturesCol(_VECTOR).setLabelCol(spec.target) \
            .setPredictionCol("pred").fit(assembled(rows, spec.features))
        return _linear_result(name, spec, rows, model)

    return fit


def _linear_result(name: str, spec: FeatureSpec, rows: DataFrame, model) -> FittedModel:
    coefficients = [float(v) for v in model.coefficients.toArray()]

    def apply(df: DataFrame) -> DataFrame:
        value = F.lit(float(model.intercept))
        for c, w in zip(spec.features, coefficients, strict=True):
            value = value + F.col(c) * F.lit(w)
        return df.withColumn("pred", value)

    def weights() -> dict[str, float]:
        stats = column_stats(rows, spec.features, std=F.stddev_pop)
        return {c: abs(w) * (stats[c]["std"] or 0.0) for c, w in zip(spec.features, coefficients, strict=True)}

    return FittedModel(name, spec, apply, weights, model)


def _ordinary(rows: DataFrame, spec: FeatureSpec, params: Mapping) -> LinearRegression:
    return LinearRegression(regParam=0.0, solver="normal")


def _ridge(rows: DataFrame, spec: FeatureSpec, params: Mapping) -> LinearRegression:
    """``alpha`` weighs the plain sum of squares: Spark's penalty is per row and per label deviation."""
    alpha = params.get("alpha", 1.0)
    y = _target_moments(rows, spec)
    return LinearRegression(elasticNetParam=0.0, regParam=alpha / y["n"] * (y["pop"] or 1.0),
                            solver="normal", standardization=False)


def _lasso(rows: DataFrame, spec: FeatureSpec, params: Mapping) -> LinearRegression:
    return LinearRegression(elasticNetParam=1.0, regParam=params.get("alpha", 1.0), standardization=False,
                            solver="l-bfgs", maxIter=params.get("max_iter", 1000), tol=1e-10)


def _elastic_net(rows: DataFrame, spec: FeatureSpec, params: Mapping) -> LinearRegression:
    """``alpha`` split into an absolute and a squared part, the latter in Spark's label-scaled units."""
    alpha, ratio = params.get("alpha", 1.0), params.get("l1_ratio", 0.5)
    absolute = alpha * ratio
    squared = alpha * (1 - ratio) * (_target_moments(rows, spec)["samp"] or 1.0)
    total = absolute + squared
    return LinearRegression(elasticNetParam=absolute / total if total else 0.0, regParam=total, solver="l-bfgs",
                            standardization=False, maxIter=params.get("max_iter", 1000), tol=1e-10)


def _tree(estimator_of: Callable[[Mapping], object]):
    def fit(df: DataFrame, spec: FeatureSpec, params: Mapping, name: str) -> FittedModel:
        shared_folder(df.sparkSession)  # boosting cuts its lineage there
        rows, estimator = _train_rows(df, spec), estimator_of(params).setFeaturesCol(_VECTOR).setPredictionCol("pred")
        # A single tree passes over the rows a few times only: Spark's own, with its thresholds.
        if estimator_of is _decision_tree or len(spec.features) > cells.MOST_FEATURES:
            return _of_rows(rows, spec, estimator, name)
        found, table, _ = _added_up(rows, spec, params)
        model = estimator.setLabelCol("y").setWeightCol("n").fit(found.vectors(table, F.col("cell")))
        return FittedModel(name, spec, lambda d: cells.predicted(d, found, [model]), lambda: _shares(spec, [model]), model)

    return fit


def _of_rows(rows: DataFrame, spec: FeatureSpec, estimator, name: str) -> FittedModel:
    model = estimator.setLabelCol(spec.target).fit(assembled(rows, spec.features))
    return FittedModel(name, spec, lambda d: model.transform(assembled(d, spec.features)).drop(_VECTOR),
                       lambda: _shares(spec, [model]), model)


def _added_up(rows: DataFrame, spec: FeatureSpec, params: Mapping) -> tuple[cells.Cells, DataFrame, float]:
    """Thresholds, cells, and how many rows there are to a cell."""
    found = cells.Cells.of(rows, spec.features, params.get("seed", 42))
    table = found.added_up(rows, spec.target)
    n, most, missing = table.agg(F.sum("n"), F.count("*"), F.count_if(F.col("cell").isNull())).first()
    if missing:
        raise ValueError("a tree model cannot be fitted on rows with missing features")
    return found, table, (n or 0.0) / max(1, most)


def _shares(spec: FeatureSpec, trees: Sequence) -> dict[str, float]:
    total = np.mean([t.featureImportances.toArray() for t in trees], axis=0)
    return dict(zip(spec.features, map(float, total), strict=True))


def _fit_forest(df: DataFrame, spec: FeatureSpec, params: Mapping, name: str) -> FittedModel:
    """A forest. Where rows share cells, every tree draws rows and learns from the sums of its cells."""
    rows, estimator = _train_rows(df, spec), _random_forest(params).setFeaturesCol(_VECTOR).setPredictionCol("pred")
    if len(spec.features) > cells.MOST_FEATURES:
        return _of_rows(rows, spec, estimator, name)
    found, table, share = _added_up(rows, spec, params)
    if not estimator.getBootstrap():
        model = estimator.setLabelCol("y").setWeightCol("n").fit(found.vectors(table, F.col("cell")))
        return FittedModel(name, spec, lambda d: cells.predicted(d, found, [model]), lambda: _shares(spec, [model]), model)
    if share < ROWS_A_CELL:
        return _of_rows(rows, spec, estimator, name)
    trees = cells.fit_forest(rows, found, spec.target, estimator.getNumTrees(), estimator.getMaxDepth(), estimator.getSeed())
    return FittedModel(name, spec, lambda d: cells.predicted(d, found, trees), lambda: _shares(spec, trees))


def _decision_tree(p: Mapping) -> DecisionTreeRegressor:
    return DecisionTreeRegressor(maxDepth=p.get("max_depth", 5), seed=p.get("seed", 42))


def _random_forest(p: Mapping) -> RandomForestRegressor:
    return RandomForestRegressor(numTrees=p.get("n_estimators", 100), maxDepth=p.get("max_depth", 10),
                                 bootstrap=p.get("bootstrap", True), seed=p.get("seed", 42))


def _gradient_boosting(p: Mapping) -> GBTRegressor:
    return GBTRegressor(maxIter=p.get("n_estimators", 200), stepSize=p.get("learning_rate", 0.1),
                        maxDepth=p.get("max_depth", 5), seed=p.get("seed", 42), checkpointInterval=10)


def _fit_neighbours(df: DataFrame, spec: FeatureSpec, params: Mapping, name: str) -> FittedModel:
    rows = _train_rows(df, spec)
    return FittedModel(name, spec, lambda d: nearest_mean(rows, d, spec, params.get("k", 5)))


@dataclass(frozen=True)
class CosineFeatures:
    """Random cosine features of scaled inputs: one matrix product per Arrow batch.

    ``sqrt(2 / components) * cos(phase + direction . (x - mean) / std)`` per component. A missing input
    makes all of a row's features missing. The plan has one node whatever the number of components.
    """

    columns: tuple[str, ...]
    means: np.ndarray
    stds: np.ndarray
    directions: np.ndarray
    phases: np.ndarray

    @classmethod
    def drawn(cls, rows: DataFrame, columns: Sequence[str], components: int, gamma: float, seed: int) -> CosineFeatures:
        stats = column_stats(rows, columns, mean=F.avg, std=F.stddev_pop)
        rng = np.random.default_rng(seed)
        directions = rng.normal(0.0, np.sqrt(2 * gamma), (components, len(columns)))
        return cls(tuple(columns), np.array([stats[c]["mean"] for c in columns], float),
                   np.array([stats[c]["std"] or 1.0 for c in columns], float),
                   directions, rng.uniform(0.0, 2 * np.pi, components))

    def lifted(self) -> Callable[[np.ndarray], np.ndarray]:
        """The features of rows of inputs, as a function of plain arrays."""
        means, weights, phases = self.means, (self.directions / self.stds).T, self.phases
        return lambda x: np.cos((x - means) @ weights + phases) * np.sqrt(2 / len(phases))

    def _inputs(self) -> Column:
        return F.struct(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(self.columns)])

    def column(self) -> Column:
        lifted = self.lifted()

        @F.pandas_udf("array<double>")
        def features(x: pd.DataFrame) -> pd.Series:
            values = lifted(x.to_numpy(float))
            known = ~np.isnan(values).any(axis=1)
            return pd.Series([v if k else None for v, k in zip(values, known, strict=True)], dtype=object)

        return features(self._inputs())

    def weighed(self, weights: np.ndarray, intercept: float) -> Column:
        """The weighted sum of a row's features, without sending them; null where an input is missing."""
        lifted = self.lifted()

        @F.pandas_udf("double")
        def total(x: pd.DataFrame) -> pd.Series:
            values, result = x.to_numpy(float), np.empty(len(x))
            for at in range(0, len(values), huber.CHUNK):
                result[at:at + huber.CHUNK] = lifted(values[at:at + huber.CHUNK]) @ weights + intercept
            return pd.Series(result)

        return total(self._inputs())


def _fit_kernel(df: DataFrame, spec: FeatureSpec, params: Mapping, name: str) -> FittedModel:
    """Random cosine features of the scaled inputs under a Huber loss.

    A linear-time stand-in for a radial kernel with a robust loss; the loss is not the
    epsilon-insensitive one of support-vector regression. The rows' own columns are kept while it is
    fitted, not their features.
    """
    rows = _train_rows(df, spec).select(*spec.features, spec.target).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        lift = CosineFeatures.drawn(rows, spec.features, params.get("components", 100),
                                    params.get("gamma", 1.0 / max(1, len(spec.features))), params.get("seed", 42))
        weights, intercept = huber.fit(rows, lift.lifted(), len(lift.phases), params.get("epsilon", 1.35),
                                       params.get("alpha", 1e-4), params.get("max_iter", 200))
    finally:
        rows.unpersist()
    return FittedModel(name, spec, lambda d: d.withColumn("pred", lift.weighed(weights, intercept)))


_FITTERS = {
    "linear_regression": _linear(_ordinary),
    "ridge": _linear(_ridge),
    "lasso": _linear(_lasso),
    "elastic_net": _linear(_elastic_net),
    "random_forest": _fit_forest,
    "gradient_boosting": _tree(_gradient_boosting),
    "decision_tree": _tree(_decision_tree),
    "knn": _fit_neighbours,
    "svr": _fit_kernel,
}
MODEL_TYPES = tuple(_FITTERS)


@dataclass(frozen=True)
class Regressor:
    """A model type with its parameters, ready to be fitted."""

    kind: str = "linear_regression"
    params: Mapping = field(default_factory=dict)
    name: str | None = None

    def __post_init__(self) -> None:
        if self.kind not in _FITTERS:
            raise ValueError(f"unknown model type: {self.kind}")

    def fit(self, df: DataFrame, spec: FeatureSpec) -> FittedModel:
        spec.require_target()
        return _FITTERS[self.kind](df, spec, dict(self.params), self.name or self.kind)


def ensemble_mean(predictions: DataFrame, key: tuple[str, ...], name: str = "ensemble") -> DataFrame:
    """Average prediction of all models per row."""
    return (predictions.groupBy("split", *key)
            .agg(F.first("y").alias("y"), F.avg("pred").alias("pred"))
            .select(F.lit(name).alias("model"), "split", *key, "y", "pred"))
