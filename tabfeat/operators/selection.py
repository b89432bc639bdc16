"""Dropping uninformative columns and scoring features against the target."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabfeat.functions.beta import f_tail
from tabfeat.operators.fitted import FittedStep
from tabfeat.operators.quantiles import quantiles
from tabfeat.operators.transformers import column_stats, inner_edges
from tabfeat.session import tiny_table
from tabfeat.spec import FeatureSpec, text_columns


def _keep(name: str, kind: str, columns: Sequence[str], dropped: Sequence[str], **params: str) -> FittedStep:
    return FittedStep(name, kind, tuple(columns), {c: F.col(c) for c in columns if c not in dropped},
                      {"dropped": ",".join(dropped), **params})


def majority_shares(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Share of each column's most frequent value, by counting every value."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]))
    rows = (df.select(cells.alias("s")).select("s.*").groupBy("column", "value").count()
            .groupBy("column").agg((F.max_by("count", F.when(F.col("value").isNotNull(), F.col("count")))
                                    / F.sum("count")).alias("share")).collect())
    return {r["column"]: r["share"] or 0.0 for r in rows}


def fit_prune(df: DataFrame, key: Sequence[str], columns: Sequence[str], tol: float,
              constant: bool = True, duplicate: bool = True,
              levels: Mapping[str, Sequence[float]] | None = None) -> list[FittedStep]:
    """Drop near-constant columns, then columns equal to an earlier one: two scans for both.

    A value with more than half of the rows reaches from the median well to one side, so for
    ``tol`` above 0.5 two candidates beside the median come from a sketch and their exact shares
    from the second scan; columns with few known ``levels`` need no sketch, and text is counted. Columns with equal order-free fingerprints are compared
    cell by cell in the second scan.
    """
    columns = list(columns)
    text = [c for c in columns if c in text_columns(df)]
    by_count = constant and levels is None and (tol <= 0.5 or bool(text))
    measures = {"mark": lambda c: F.bit_xor(F.xxhash64(*key, F.col(c))), "filled": F.count}
    if levels is None and not by_count:
        measures["middle"] = lambda c: F.percentile_approx(c, [0.499, 0.501], 10_000)
    stats = column_stats(df, columns, **measures)
    prints = {c: (s["mark"], s["filled"]) for c, s in stats.items()}
    candidates = levels or {c: [] for c in columns} if by_count or levels else {c: list(dict.fromkeys(s["middle"] or [])) for c, s in stats.items()}
    groups: dict[tuple, list[str]] = {}
    for c in columns:
        groups.setdefault(prints[c], []).append(c)
    # Equality carries over, so the first of a group stands for the others.
    pairs = [(g[0], b) for g in groups.values() for b in g[1:]] if duplicate else []
    checks = [F.greatest(F.lit(0), F.lit(0), *[F.count_if(F.col(c) == F.lit(v)) for v in candidates[c]]).alias(f"m{i}")
              for i, c in enumerate(columns)]
    checks += [F.count_if(~F.col(a).eqNullSafe(F.col(b))).alias(f"d{i}") for i, (a, b) in enumerate(pairs)]
    row = df.agg(F.count("*").alias("rows"), *checks).first()
    shares = majority_shares(df, columns) if by_count else {
        c: row[f"m{i}"] / row["rows"] if row["rows"] else 0.0 for i, c in enumerate(columns)}
    steps = []
    flat = [c for c in columns if constant and shares[c] >= tol]
    if constant:
        if columns and len(flat) == len(columns):
            raise ValueError("dropping constant columns would leave no feature")
        steps.append(_keep("drop_constant", "drop_constant", columns, flat, tol=str(tol)))
    if duplicate:
        kept = [c for c in columns if c not in flat]
        equal = {p for i, p in enumerate(pairs) if row[f"d{i}"] == 0}
        repeated = [b for b in kept if any((a, b) in equal for a in kept)]
        steps.append(_keep("drop_duplicates", "drop_duplicates_cols", kept, repeated))
    return steps


def select_step(columns: Sequence[str], winners: Sequence[str], **params: str) -> FittedStep:
    return FittedStep("select", "select_mi", tuple(columns), {c: F.col(c) for c in columns if c in winners}, params)


def features_to_keep(raw_features: int) -> int:
    """How many features selection keeps, from the number of features before expansion."""
    if raw_features <= 10:
        return raw_features
    if raw_features <= 50:
        return min(20, raw_features)
    return min(50, raw_features * 8 // 10)


def score_edges(df: DataFrame, spec: FeatureSpec, bins: int = 16, method: str = "exact") -> dict[str, list[float | None]]:
    """All ``bins + 1`` quantile points of every feature and the target."""
    columns = [*spec.features, spec.require_target()]
    return quantiles(df, columns, [i / bins for i in range(bins + 1)], method)


def _pair_counts(edges: Sequence[Sequence[float]]):
    """Per partition: how often each feature's bin meets each bin of the last column."""
    cuts = [np.asarray(e) for e in edges]
    height = len(cuts[-1]) + 1

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [np.zeros((len(c) + 1) * height, "int64") for c in cuts[:-1]]
        for batch in batches:
            y = batch.column(len(tables)).to_numpy(zero_copy_only=False)
            down = np.searchsorted(cuts[-1], y, side="left")
            for i, table in enumerate(tables):
                x = batch.column(i).to_numpy(zero_copy_only=False)
                known = ~(np.isnan(x) | np.isnan(y))
                across = np.searchsorted(cuts[i], x[known], side="left")
                table += np.bincount(across * height + down[known], minlength=len(table))
        rows = [(i, int(k) // height, int(k) % height, int(t[k])) for i, t in enumerate(tables) for k in np.flatnonzero(t)]
        if rows:
            types = (pa.int32(), pa.int32(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows, strict=True), types, strict=True)],
                                             ("position", "bx", "by", "n"))

    return count


def mi_scores(df: DataFrame, spec: FeatureSpec, bins: int = 16, method: str = "exact",
              points: dict[str, list[float | None]] | None = None) -> DataFrame:
    """Mutual information ``(feature, position, score)`` of quantile-binned features with the target.

    The shuffle carries at most ``bins * bins`` counts per feature and task. Values depend on
    ``bins`` and differ from nearest-neighbour estimates; compare them within one run only.
    """
    points = points or score_edges(df, spec, bins, method)
    target = spec.require_target()

    edges = [inner_edges(points[c]) for c in (*spec.features, target)]
    columns = [F.col(c).cast("double").alias(c) for c in (*spec.features, target)]
    counts = (df.select(*columns).mapInArrow(_pair_counts(edges), "position int, bx int, by int, n bigint")
              .groupBy("position", "bx", "by").agg(F.sum("n").alias("n")))
    total, across, down = (Window.partitionBy(*k) for k in (("position",), ("position", "bx"), ("position", "by")))
    n = F.col("n")
    share = n / F.sum(n).over(total)
    ratio = n * F.sum(n).over(total) / (F.sum(n).over(across) * F.sum(n).over(down))
    names = F.array(*[F.lit(c) for c in spec.features])
    return (counts.select("position", (share * F.ln(ratio)).alias("part"))
            .groupBy("position").agg(F.greatest(F.sum("part"), F.lit(0.0)).alias("score"))
            .select(F.get(names, F.col("position")).alias("feature"), "position", "score"))


def f_scores(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Univariate regression F statistic of every feature and its p-value, one scan.

    Over the rows that have both feature and target; null for a constant or with fewer than three rows. A
    perfect line scores infinity with p-value 0.
    """
    target = F.col(f"`{spec.require_target()}`")
    pairs = [(F.col(f"`{c}`"), i) for i, c in enumerate(spec.features)]
    flat = df.agg(*[a for x, i in pairs for a in (
        F.covar_pop(x, target).alias(f"xy{i}"), F.var_pop(F.when(target.isNotNull(), x)).alias(f"xx{i}"),
        F.var_pop(F.when(x.isNotNull(), target)).alias(f"yy{i}"), F.count_if(x.isNotNull() & target.isNotNull()).alias(f"n{i}"))])
    rows = [F.struct(F.lit(c).alias("feature"), F.lit(i).alias("position"), F.pow(f"xy{i}", 2).alias("shared"),
                     (F.col(f"xx{i}") * F.col(f"yy{i}")).alias("whole"), (F.col(f"n{i}") - 2).alias("degrees")) for i, c in enumerate(spec.features)]
    left = F.col("whole") - F.col("shared")
    score = F.when((F.col("degrees") > 0) & (F.col("whole") > 0), F.when(left <= 0, F.lit(float("inf"))).otherwise(
        F.try_divide(F.col("shared") * F.col("degrees"), left)))
    return (flat.select(F.inline(F.array(*rows))).withColumn("score", score)
            .select("feature", "position", "score", f_tail(F.col("score"), F.col("degrees")).alias("p_value")))


def top_scores(scores: DataFrame, k: int) -> DataFrame:
    return scores.orderBy(F.desc_nulls_last("score"), "position").limit(k)


def fit_select(df: DataFrame, spec: FeatureSpec, k: int,
               scorer: Callable[[DataFrame, FeatureSpec], DataFrame] = mi_scores) -> tuple[FittedStep, DataFrame]:
    """Keep the ``k`` best features in their original order; any scorer with ``(feature, position, score)`` will do."""
    rows = scorer(df, spec).collect()
    rows.sort(key=lambda r: (-(r["score"] if r["score"] is not None else float("-inf")), r["position"]))
    winners = [r["feature"] for r in rows[:k]]
    table = tiny_table(df.sparkSession, [(r["feature"], r["position"], r["score"]) for r in rows],
                       "feature string, position int, score double")
    return select_step(spec.features, winners, k=str(k)), table
