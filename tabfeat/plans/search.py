"""Cross-validation, model search and trade-offs between trials."""

from __future__ import annotations

import json
import random
import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from threading import Lock

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabfeat.fixed_values import HIGHER_IS_BETTER, T_95
from tabfeat.operators.metrics import moment_metrics
from tabfeat.operators.split import fold_number
from tabfeat.plans import fold_models, gram
from tabfeat.plans.chain import ChainOptions, FeatureChain
from tabfeat.plans.models import FittedModel, Regressor
from tabfeat.session import small_side, tiny_table
from tabfeat.spec import FeatureSpec, known_target, training_rows


def _score_column(scoring: str) -> Column:
    """Scores grow with quality: errors carry the ``neg_`` prefix."""
    names = {"neg_mean_squared_error": ("mse", -1), "neg_root_mean_squared_error": ("rmse", -1),
             "neg_mean_absolute_error": ("mae", -1), "r2": ("r2", 1)}
    if scoring not in names:
        raise ValueError(f"unknown scoring: {scoring}")
    metric, sign = names[scoring]
    return moment_metrics()[metric] * sign


def _folded(df: DataFrame, spec: FeatureSpec, folds: int, seed: int) -> DataFrame:
    return known_target(training_rows(df, spec), spec).withColumn("_fold", fold_number(spec, folds, seed))


def fold_scores(df: DataFrame, spec: FeatureSpec, model: Regressor, folds: int = 5,
                scoring: str = "neg_mean_squared_error", seed: int = 42, chain: str | None = None,
                options: ChainOptions = ChainOptions()) -> list[tuple[int, float]]:
    """Score of every held-out fold; chain and model are fitted on the other folds only.

    Linear families without a chain are solved from the folds' moments, which one scan adds up.
    """
    return _scores(_folded(df, spec, folds, seed), spec, model, folds, scoring, chain, options)


def _scores(rows: DataFrame, spec: FeatureSpec, model: Regressor, folds: int, scoring: str, chain: str | None = None,
            options: ChainOptions = ChainOptions()) -> list[tuple[int, float]]:
    score = _score_column(scoring)
    if chain is None and gram.fits(model.kind, scoring, spec):
        return gram.moment_scores(gram.fold_moments(rows, spec), model.kind, model.params, scoring)
    result = []
    for fold in range(folds):
        train, held = rows.where(F.col("_fold") != fold), rows.where(F.col("_fold") == fold)
        roles = spec
        if chain is not None:
            fitted = FeatureChain(chain, options).fit(train, spec)
            train, held, roles = fitted.transform(train), fitted.transform(held), fitted.output_spec()
        value = model.fit(train, roles).predictions(held).agg(score).first()[0]
        if value is not None:
            result.append((fold, float(value)))
    return result


def cross_validate(df: DataFrame, spec: FeatureSpec, model: Regressor, folds: int = 5,
                   scoring: str = "neg_mean_squared_error", seed: int = 42, chain: str | None = None,
                   options: ChainOptions = ChainOptions()) -> DataFrame:
    """``(fold, score)`` per held-out fold."""
    return tiny_table(df.sparkSession, fold_scores(df, spec, model, folds, scoring, seed, chain, options),
                      "fold int, score double")


def confidence(scores: DataFrame) -> DataFrame:
    """Mean score with its two-sided 95 % interval from Student's t."""
    points = F.array(*[F.lit(t) for t in T_95])
    t = F.coalesce(F.get(points, (F.col("n") - 2).cast("int")), F.lit(1.96))
    half = t * F.col("std") / F.sqrt("n")
    return (scores.agg(F.count("score").alias("n"), F.avg("score").alias("mean"), F.stddev_samp("score").alias("std"))
            .select("n", "mean", "std", (F.col("mean") - half).alias("low"), (F.col("mean") + half).alias("high")))


# Parameter ranges the search draws from, per model type.
SPACE: Mapping[str, Callable[[random.Random], dict]] = {
    "linear_regression": lambda r: {},
    "ridge": lambda r: {"alpha": 10 ** r.uniform(-1, 2)},
    "lasso": lambda r: {"alpha": 10 ** r.uniform(-1, 2)},
    "elastic_net": lambda r: {"alpha": 10 ** r.uniform(-1, 2), "l1_ratio": r.uniform(0.1, 0.9)},
    "decision_tree": lambda r: {"max_depth": r.randint(3, 10)},
    "random_forest": lambda r: {"n_estimators": r.choice([20, 50, 100]), "max_depth": r.randint(4, 10)},
    "knn": lambda r: {"k": r.randint(2, 20)},
    "svr": lambda r: {"epsilon": r.uniform(1.1, 2.0), "alpha": 10 ** r.uniform(-5, -2)},
    "gradient_boosting": lambda r: {"n_estimators": r.choice([20, 50, 100]), "max_depth": r.randint(3, 6),
                                    "learning_rate": 10 ** r.uniform(-2, -0.5)},
}


@dataclass
class SearchResult:
    best_score: float
    best_kind: str
    best_params: dict
    trials: DataFrame
    model: FittedModel | None = None
    unscored: int = 0

    def as_dict(self) -> dict:
        return {"best_score": self.best_score, "best_params": {"model_type": self.best_kind, **self.best_params}}


def drawn_trials(n_trials: int, families: Sequence[str], seed: int = 42) -> list[tuple[int, str, dict]]:
    """Number, family and parameters of every trial; the families take turns."""
    rng = random.Random(seed)
    return [(i, families[i % len(families)], SPACE[families[i % len(families)]](rng)) for i in range(n_trials)]


def optimize(df: DataFrame, spec: FeatureSpec, n_trials: int = 100, timeout: float = 3600, folds: int = 5,
             scoring: str = "neg_mean_squared_error", seed: int = 42, families: Sequence[str] | None = None,
             refit: bool = True, parallel: int = 4) -> SearchResult:
    """Seeded random search: every trial is scored on every row, by cross-validation.

    All trials of linear families are solved from one scan, those of tree families and of neighbours share
    their work by fold (``fold_models``); of the others ``parallel`` run at a time. The time limit is checked
    before each trial but the first. A trial that it cut off, or that no fold could score, stands in
    ``trials`` with a null fold and score, and is counted in ``unscored``.
    """
    families = list(families or SPACE)
    if unknown := [f for f in families if f not in SPACE]:
        raise ValueError(f"no search space for: {unknown}")
    drawn = drawn_trials(n_trials, families, seed)
    # The fold is a digest of the key: worked out once, the trials read it.
    rows = _folded(df, spec, folds, seed).persist(StorageLevel.MEMORY_AND_DISK)
    deadline = time.monotonic() + timeout
    moments: dict = {}
    if any(gram.fits(family, scoring, spec) for _, family, _ in drawn):
        moments = gram.fold_moments(rows, spec)

    own_folds = fold_models.Folds(rows, spec)
    common, locks = {}, {family: Lock() for family in families}

    def together(family: str) -> dict[int, list[tuple[int, float]]] | None:
        """The scores of all trials of the family, worked out for the first of them."""
        with locks[family]:
            if family not in common:
                own = {i: params for i, kind, params in drawn if kind == family}
                common[family] = own_folds.scores(family, own, scoring)
            return common[family]

    def scored(trial: tuple[int, str, dict]) -> tuple[list[tuple[int, float]], float]:
        i, family, params = trial
        begun = time.monotonic()
        if i and begun > deadline:
            return [], 0.0
        if gram.fits(family, scoring, spec):
            results = gram.moment_scores(moments, family, params, scoring)
        elif fold_models.fits(family, scoring, spec) and (shared := together(family)) is not None:
            results = shared[i]
        else:
            results = _scores(rows, spec, Regressor(family, params), folds, scoring)
        return results, time.monotonic() - begun

    try:
        with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
            outcomes = list(pool.map(scored, drawn))
    finally:
        rows.unpersist()
    log, unscored = [], 0
    best: tuple[float, str, dict] | None = None
    for (i, family, params), (results, seconds) in zip(drawn, outcomes, strict=True):
        text = json.dumps(params, sort_keys=True)
        if not results:
            unscored += 1
            log.append((i, family, text, None, None, None))
            continue
        log += [(i, family, text, fold, score, seconds) for fold, score in results]
        mean = sum(s for _, s in results) / len(results)
        if best is None or mean > best[0]:
            best = (mean, family, params)
    if best is None:
        raise ValueError("no trial could be scored")
    trials = tiny_table(df.sparkSession, log, "trial int, family string, params string, fold int, score double, seconds double")
    model = Regressor(best[1], best[2], "automl").fit(df, spec) if refit else None
    return SearchResult(best[0], best[1], best[2], trials, model, unscored)


def pareto_trials(trials: DataFrame, objectives: Sequence[str], ident: str = "model") -> DataFrame:
    """Trials that no other trial beats in one objective without losing in another.

    Trials are few (one row per fitted model). Objectives are minimised, except those in
    which larger is better.
    """
    def no_worse(o: str) -> Column:
        a, b = F.col(f"b.{o}"), F.col(f"a.{o}")
        return a >= b if o in HIGHER_IS_BETTER else a <= b

    dominated = (reduce(lambda x, y: x & y, [no_worse(o) for o in objectives])
                 & reduce(lambda x, y: x | y, [F.col(f"a.{o}") != F.col(f"b.{o}") for o in objectives]))
    return trials.alias("a").join(small_side(trials).alias("b"), dominated, "left_anti").select(ident, *objectives)
