"""Column transformers. Each fit is a constant number of aggregates over all columns at once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabfeat.functions.shape import bin_code, yeo_johnson
from tabfeat.operators.fitted import FittedStep, as_params
from tabfeat.operators.power_fit import fit_lambdas
from tabfeat.operators.quantiles import quantiles

QUARTILES = (0.25, 0.5, 0.75)


def column_stats(df: DataFrame, columns: Sequence[str], **measures) -> dict[str, dict[str, float | None]]:
    """``{column: {measure: value}}`` from one scan."""
    if not columns:
        return {}
    row = df.agg(*[m(c).alias(f"{name}_{i}") for i, c in enumerate(columns) for name, m in measures.items()]).first()
    return {c: {name: row[f"{name}_{i}"] for name in measures} for i, c in enumerate(columns)}


def _filled(columns: Sequence[str], values: Mapping[str, float | None]):
    return {c: F.coalesce(F.col(c), F.lit(values[c])) if values[c] is not None else F.col(c) for c in columns}


def fit_impute_mean(df: DataFrame, columns: Sequence[str]) -> FittedStep:
    means = {c: s["mean"] for c, s in column_stats(df, columns, mean=F.avg).items()}
    return impute_with(columns, means, "mean")


def fit_impute_median(df: DataFrame, columns: Sequence[str], method: str = "exact") -> FittedStep:
    medians = {c: q[0] for c, q in quantiles(df, columns, (0.5,), method).items()}
    return impute_with(columns, medians, "median")


def impute_with(columns: Sequence[str], values: Mapping[str, float | None], how: str) -> FittedStep:
    return FittedStep("impute", f"impute_{how}", tuple(columns), _filled(columns, values), as_params(values))


def fit_impute_categorical(df: DataFrame, columns: Sequence[str], how: str = "missing",
                           fill: str = "Missing") -> FittedStep:
    """Constant text, or each column's most frequent value (the smallest one among equals)."""
    if how == "missing":
        values = dict.fromkeys(columns, fill)
    elif how == "frequent":
        values = most_frequent(df, columns)
    else:
        raise ValueError(f"unknown categorical imputation: {how}")
    return FittedStep("impute_categorical", f"impute_{how}", tuple(columns), _filled(columns, values), as_params(values))


def most_frequent(df: DataFrame, columns: Sequence[str]) -> dict[str, str | None]:
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns]))
    best = (df.select(cells.alias("s")).select("s.*").where("value is not null")
            .groupBy("column", "value").count()
            .groupBy("column").agg(F.min_by("value", F.struct(-F.col("count"), F.col("value"))).alias("value")))
    return {**dict.fromkeys(columns), **{r["column"]: r["value"] for r in best.collect()}}


def log_step(columns: Sequence[str], stats: Mapping[str, Mapping[str, float | None]], threshold: float) -> FittedStep:
    """``ln`` of the right-skewed, strictly positive columns; the others pass unchanged."""
    chosen = [c for c in columns
              if (stats[c]["low"] or 0) > 0 and (stats[c]["skew"] or 0) > threshold]
    return FittedStep("log", "log_skewed", tuple(columns),
                      {c: F.ln(F.col(c)) if c in chosen else F.col(c) for c in columns},
                      {"columns": ",".join(chosen), "threshold": str(threshold)})


def skew_stats(df: DataFrame, columns: Sequence[str]) -> dict[str, dict[str, float | None]]:
    return column_stats(df, columns, low=F.min, skew=F.skewness)


def fit_log(df: DataFrame, columns: Sequence[str], threshold: float = 1.0) -> FittedStep:
    return log_step(columns, skew_stats(df, columns), threshold)


def fit_mean_impute_and_log(df: DataFrame, columns: Sequence[str], threshold: float = 1.0):
    """Both steps from one scan.

    Filling gaps with the mean leaves the sums of squared and cubed deviations as they were and
    only raises the count, so the skewness after imputation follows from the one before it.
    """
    stats = column_stats(df, columns, mean=F.avg, low=F.min, skew=F.skewness, n=F.count, rows=lambda c: F.count("*"))
    after = {c: {"low": s["low"], "skew": None if s["skew"] is None else s["skew"] * (s["rows"] / s["n"]) ** 0.5}
             for c, s in stats.items()}
    return impute_with(columns, {c: s["mean"] for c, s in stats.items()}, "mean"), log_step(columns, after, threshold)


def power_step(columns: Sequence[str], exponent: float = 0.5) -> FittedStep:
    return FittedStep("power", "power", tuple(columns),
                      {c: F.pow(F.col(c), F.lit(exponent)) for c in columns}, {"exponent": str(exponent)})


def yeo_johnson_step(columns: Sequence[str], lambdas: Mapping[str, float]) -> FittedStep:
    return FittedStep("yeo_johnson", "yeo_johnson", tuple(columns),
                      {c: yeo_johnson(F.col(c), lambdas[c]) for c in columns}, as_params(lambdas))


def fit_yeo_johnson(df: DataFrame, columns: Sequence[str], lambdas: Mapping[str, float] | float | None = None) -> FittedStep:
    """Powers by maximum likelihood, unless they are given."""
    if isinstance(lambdas, (int, float)):
        lambdas = dict.fromkeys(columns, float(lambdas))
    return yeo_johnson_step(columns, lambdas or fit_lambdas(df, columns))


def bin_step(columns: Sequence[str], edges: Mapping[str, Sequence[float]], kind: str) -> FittedStep:
    return FittedStep("bin", kind, tuple(columns),
                      {c: bin_code(F.col(c), edges[c]) for c in columns},
                      {c: ",".join(map(str, edges[c])) for c in columns},
                      {c: list(range(len(set(edges[c])) + 1)) for c in columns})


def fit_equal_frequency(df: DataFrame, columns: Sequence[str], bins: int = 4, method: str = "exact") -> FittedStep:
    """Quantile bins, right-closed, open at both ends; equal edges merge."""
    probs = [i / bins for i in range(1, bins)]
    inner = quantiles(df, columns, [0.0, *probs, 1.0], method)
    return bin_step(columns, {c: inner_edges(q) for c, q in inner.items()}, "bin_equal_freq")


def inner_edges(points: Sequence[float | None]) -> list[float]:
    """Distinct cut points without the two outermost ones, which become infinite."""
    distinct = sorted({p for p in points if p is not None})
    return distinct[1:-1]


def fit_equal_width(df: DataFrame, columns: Sequence[str], bins: int = 4) -> FittedStep:
    ranges = column_stats(df, columns, lo=F.min, hi=F.max)
    edges = {c: [] if r["lo"] is None or r["lo"] == r["hi"] else
             [r["lo"] + (r["hi"] - r["lo"]) * i / bins for i in range(1, bins)] for c, r in ranges.items()}
    return bin_step(columns, edges, "bin_equal_width")


def _scaled(name: str, columns: Sequence[str], centre: Mapping[str, float | None],
            width: Mapping[str, float | None], levels: Mapping[str, Sequence[float]] | None = None) -> FittedStep:
    return FittedStep("scale", name, tuple(columns),
                      {c: (F.col(c) - F.lit(centre[c])) / F.lit(width[c] or 1.0) for c in columns},
                      {c: f"{centre[c]},{width[c]}" for c in columns},
                      levels and {c: [(v - centre[c]) / (width[c] or 1.0) for v in levels[c] if centre[c] is not None]
                                  for c in columns})


def fit_scale_standard(df: DataFrame, columns: Sequence[str],
                       levels: Mapping[str, Sequence[float]] | None = None) -> FittedStep:
    """Population standard deviation; a constant column is only centred."""
    stats = column_stats(df, columns, mean=F.avg, std=F.stddev_pop)
    return _scaled("scale_standard", columns, {c: s["mean"] for c, s in stats.items()},
                   {c: s["std"] for c, s in stats.items()}, levels)


def robust_step(columns: Sequence[str], quartiles: Mapping[str, Sequence[float | None]]) -> FittedStep:
    spread = {c: None if q[0] is None else q[2] - q[0] for c, q in quartiles.items()}
    return _scaled("scale_robust", columns, {c: quartiles[c][1] for c in columns}, spread)


def fit_scale_robust(df: DataFrame, columns: Sequence[str], method: str = "exact") -> FittedStep:
    return robust_step(columns, quantiles(df, columns, QUARTILES, method))


def fit_scale_minmax(df: DataFrame, columns: Sequence[str]) -> FittedStep:
    ranges = column_stats(df, columns, lo=F.min, hi=F.max)
    return _scaled("scale_minmax", columns, {c: r["lo"] for c, r in ranges.items()},
                   {c: None if r["lo"] is None else r["hi"] - r["lo"] for c, r in ranges.items()})


def fit_cap_outliers(df: DataFrame, columns: Sequence[str], fence: float = 1.5, method: str = "exact") -> FittedStep:
    """Pull values beyond the Tukey fences onto them."""
    outputs, params = {}, {}
    for c, (q1, _, q3) in quantiles(df, columns, QUARTILES, method).items():
        if q1 is None:
            outputs[c] = F.col(c)
            continue
        lo, hi = q1 - fence * (q3 - q1), q3 + fence * (q3 - q1)
        outputs[c] = F.when(F.col(c) < lo, F.lit(lo)).when(F.col(c) > hi, F.lit(hi)).otherwise(F.col(c))
        params[c] = f"{lo},{hi}"
    return FittedStep("cap", "cap_outliers", tuple(columns), outputs, params)


def interaction_terms(columns: Sequence[str]) -> list[tuple[str, ...]]:
    """Every column, then every product of two, in the order of the ``poly_{i}`` names."""
    return [(c,) for c in columns] + list(combinations(columns, 2))


def interaction_step(columns: Sequence[str]) -> FittedStep:
    terms = interaction_terms(columns)
    outputs = {}
    for i, term in enumerate(terms):
        product = F.col(term[0])
        for other in term[1:]:
            product = product * F.col(other)
        outputs[f"poly_{i}"] = product
    return FittedStep("interact", "poly_interactions", tuple(columns), outputs,
                      {f"poly_{i}": " * ".join(t) for i, t in enumerate(terms)})
