"""The two feature chains: fitted step by step on the training rows, applied as projections."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import Estimator, Transformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabfeat.operators import selection, transformers
from tabfeat.operators.fitted import FittedStep
from tabfeat.session import tiny_table
from tabfeat.spec import FeatureSpec, training_rows


@dataclass(frozen=True)
class ChainOptions:
    """Switches and parameters of both chains. ``None`` tolerances take the chain's own default."""

    imputation: bool = True
    transformations: bool = True
    discretization: bool = True
    scaling: bool = True
    interactions: bool = True
    selection: bool = True
    skew_threshold: float = 1.0
    lambdas: Mapping[str, float] | float | None = None
    bins: int = 4
    constant_tol: float | None = None
    cap_fence: float | None = None
    mi_bins: int = 16
    keep: int | None = None
    scorer: Callable[[DataFrame, FeatureSpec], DataFrame] | None = None
    quantile_method: str = "exact"
    drop_constant: bool = True
    drop_duplicates: bool = True


@dataclass
class FeatureChain:
    """``kind`` is ``basic`` or ``advanced``. Fitting reads only rows of the training split,
    kept while it lasts: its scans then neither read other rows nor decide the split again.

    basic:    mean imputation, log, Yeo-Johnson, quartile bins, standard scale, pruning
    advanced: median imputation, pruning, Yeo-Johnson, interactions, selection, robust scale
    """

    kind: str = "basic"
    options: ChainOptions = field(default_factory=ChainOptions)
    steps: list[FittedStep] = field(default_factory=list)
    spec: FeatureSpec | None = None
    scores: DataFrame | None = None

    def __post_init__(self) -> None:
        if self.kind not in ("basic", "advanced"):
            raise ValueError(f"unknown feature chain: {self.kind}")

    @property
    def fitted(self) -> bool:
        return self.spec is not None

    def fit(self, df: DataFrame, spec: FeatureSpec) -> FeatureChain:
        train = training_rows(df, spec)
        self.steps, self.scores = [], None
        if self.kind == "advanced":
            spec.require_target()
            train = train.where(F.col(spec.target).isNotNull()).select(*spec.key, spec.target, *spec.features)
        else:
            train = train.select(*spec.key, *spec.features)
        train = train.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            (self._fit_advanced if self.kind == "advanced" else self._fit_basic)(train, spec)
        finally:
            train.unpersist()
        self.spec = spec
        return self

    def _add(self, frame: DataFrame, *steps: FittedStep) -> DataFrame:
        for step in steps:
            self.steps.append(step)
            frame = step.apply(frame)
        return frame

    def _columns(self, spec: FeatureSpec) -> list[str]:
        return list(self.steps[-1].features) if self.steps else list(spec.features)

    def _fit_basic(self, frame: DataFrame, spec: FeatureSpec) -> None:
        o = self.options
        columns = list(spec.features)
        if o.imputation and o.transformations and o.cap_fence is None:
            frame = self._add(frame, *transformers.fit_mean_impute_and_log(frame, columns, o.skew_threshold))
        else:
            if o.imputation:
                frame = self._add(frame, transformers.fit_impute_mean(frame, columns))
            if o.cap_fence is not None:
                frame = self._add(frame, transformers.fit_cap_outliers(frame, columns, o.cap_fence, o.quantile_method))
            if o.transformations:
                frame = self._add(frame, transformers.fit_log(frame, columns, o.skew_threshold))
        if o.transformations:
            frame = self._add(frame, transformers.fit_yeo_johnson(frame, columns, o.lambdas))
        if o.discretization:
            frame = self._add(frame, transformers.fit_equal_frequency(frame, columns, o.bins, o.quantile_method))
        if o.scaling:
            frame = self._add(frame, transformers.fit_scale_standard(
                frame, columns, self.steps[-1].levels if self.steps else None))
        self._prune(frame, spec, 0.95)

    def _prune(self, frame: DataFrame, spec: FeatureSpec, default_tol: float) -> DataFrame:
        o = self.options
        tol = default_tol if o.constant_tol is None else o.constant_tol
        return self._add(frame, *selection.fit_prune(
            frame, spec.key, self._columns(spec), tol, o.drop_constant, o.drop_duplicates,
            self.steps[-1].levels if self.steps else None))

    def _fit_advanced(self, frame: DataFrame, spec: FeatureSpec) -> None:
        o = self.options
        if o.imputation:
            frame = self._add(frame, transformers.fit_impute_median(frame, list(spec.features), o.quantile_method))
        if o.cap_fence is not None:
            frame = self._add(frame, transformers.fit_cap_outliers(
                frame, self._columns(spec), o.cap_fence, o.quantile_method))
        frame = self._prune(frame, spec, 0.98)
        if o.transformations:
            frame = self._add(frame, transformers.fit_yeo_johnson(frame, self._columns(spec), o.lambdas))
        if o.interactions:
            frame = self._add(frame, transformers.interaction_step(self._columns(spec)))
        points = None
        if o.selection:
            wide = spec.with_features(self._columns(spec))
            keep = o.keep if o.keep is not None else selection.features_to_keep(len(spec.features))
            if o.scorer is None:
                points = selection.score_edges(frame, wide, o.mi_bins, o.quantile_method)

            def score(rows: DataFrame, roles: FeatureSpec) -> DataFrame:
                return o.scorer(rows, roles) if o.scorer else selection.mi_scores(rows, roles, o.mi_bins, points=points)

            step, self.scores = selection.fit_select(frame, wide, keep, score)
            frame = self._add(frame, step)
        if o.scaling:
            columns = self._columns(spec)
            if points is not None and o.mi_bins % 4 == 0:
                # The selector's quantile points already contain the quartiles.
                at = [o.mi_bins // 4 * q for q in (1, 2, 3)]
                self._add(frame, transformers.robust_step(columns, {c: [points[c][i] for i in at] for c in columns}))
            else:
                self._add(frame, transformers.fit_scale_robust(frame, columns, o.quantile_method))

    def _require_fit(self) -> FeatureSpec:
        if self.spec is None:
            raise ValueError("the feature chain must be fitted first")
        return self.spec

    def transform(self, df: DataFrame) -> DataFrame:
        self._require_fit()
        for step in self.steps:
            df = step.apply(df)
        return df

    def fit_transform(self, df: DataFrame, spec: FeatureSpec) -> DataFrame:
        return self.fit(df, spec).transform(df)

    def output_spec(self) -> FeatureSpec:
        return self._require_fit().with_features(self.feature_names())

    def feature_names(self) -> list[str]:
        return self._columns(self._require_fit())

    def info(self, spark: SparkSession) -> DataFrame:
        """One row per fitted step."""
        self._require_fit()
        return tiny_table(spark, [
            (i, s.name, s.kind, dict(s.params), list(s.inputs), len(s.outputs)) for i, s in enumerate(self.steps)],
            "pos int, step string, type string, params map<string,string>, variables array<string>, n_output int")

    def importance(self) -> DataFrame:
        """Score of every candidate the selector saw, kept or not."""
        self._require_fit()
        if self.scores is None:
            raise ValueError("this chain has no selection step")
        return self.scores


class ChainTransformer(Transformer):
    """A fitted chain as a stage of an ML pipeline."""

    def __init__(self, chain: FeatureChain) -> None:
        super().__init__()
        self.chain = chain

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.chain.transform(dataset)


class ChainEstimator(Estimator):
    """Fits a fresh chain on whatever rows it is given, so cross-validation cannot leak."""

    def __init__(self, spec: FeatureSpec, kind: str = "basic", options: ChainOptions = ChainOptions()) -> None:
        super().__init__()
        self.spec, self.kind, self.options = spec, kind, options

    def _fit(self, dataset: DataFrame) -> ChainTransformer:
        return ChainTransformer(FeatureChain(self.kind, self.options).fit(dataset, self.spec))
