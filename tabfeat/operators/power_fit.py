"""Maximum-likelihood power of the Yeo-Johnson transform for many columns at once."""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabfeat.functions.literals import doubles

_SCHEMA = "c int, l int, n double, mean double, m2 double, jac double, lo double, hi double"
COARSE = tuple(np.arange(-5.0, 5.01, 0.5).tolist())
WIDEST = 2.0**40  # steps of a grid whose likelihood still rises at its end: there is no optimum
NARROWEST = 1e-6  # steps beside which the likelihood still can't be computed
RELATIVE = 1e-3  # steps need not be finer than this share of the power


def _powered(base: np.ndarray, exponent: float) -> np.ndarray:
    return base if exponent == 0 else np.expm1(exponent * base) / exponent


def _block_moments(x: np.ndarray, lambdas: np.ndarray):
    """Count, means and squared deviations per power, and the sum of signed logs.

    Equal values are transformed once and weighted by their count.
    """
    values, counts = np.unique(x, return_counts=True)
    negative = values < 0
    base = np.log1p(np.abs(values))
    below, above = base[negative], base[~negative]
    means, squares = np.empty(len(lambdas)), np.empty(len(lambdas))
    with np.errstate(all="ignore"):
        for j, lam in enumerate(lambdas):
            y = np.concatenate([-_powered(below, 2 - lam), _powered(above, lam)])
            means[j] = mean = counts @ y / len(x)
            squares[j] = counts @ np.square(y - mean)
    return len(x), means, squares, float(counts @ np.where(negative, -base, base))


def _partition_moments(grids: Sequence[Sequence[float]]):
    """Per partition: count, mean and squared deviations of every column under every power."""
    powers = [np.asarray(g) for g in grids]

    def moments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = [(0, np.zeros(len(g)), np.zeros(len(g)), 0.0) for g in powers]
        ranges = [(np.inf, -np.inf)] * len(powers)
        for batch in batches:
            for i, grid in enumerate(powers):
                x = batch.column(i).to_numpy(zero_copy_only=False)
                x = x[~np.isnan(x)]
                if not len(x):
                    continue
                ranges[i] = (min(ranges[i][0], float(x.min())), max(ranges[i][1], float(x.max())))
                n, mean, m2, jac = state[i]
                m, block_mean, block_m2, block_jac = _block_moments(x, grid)
                with np.errstate(all="ignore"):
                    step = block_mean - mean
                    state[i] = (n + m, mean + step * m / (n + m),
                                m2 + block_m2 + step * step * n * m / (n + m), jac + block_jac)
        rows = [(i, j, float(n), float(mean[j]), float(m2[j]), jac, *ranges[i])
                for i, (n, mean, m2, jac) in enumerate(state) if n for j in range(len(powers[i]))]
        if rows:
            types = (pa.int32(), pa.int32(), *(pa.float64(),) * 6)
            names = ("c", "l", "n", "mean", "m2", "jac", "lo", "hi")
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    return moments


def log_likelihoods(df: DataFrame, columns: Sequence[str], grids: Mapping[str, Sequence[float]]) -> DataFrame:
    """``(c, l, n, llf)``: the likelihood per column index and power index, from one scan.

    Partition moments are merged around the grand mean, so nothing cancels.
    """
    parts = (df.select(*[F.col(c).cast("double").alias(c) for c in columns])
             .mapInArrow(_partition_moments([grids[c] for c in columns]), _SCHEMA))
    cell = Window.partitionBy("c", "l")
    merged = (parts
              .withColumn("grand", F.sum(F.col("n") * F.col("mean")).over(cell) / F.sum("n").over(cell))
              .groupBy("c", "l")
              .agg(F.sum("n").alias("n"), F.sum("jac").alias("jac"), F.first("grand").alias("grand"),
                   (F.min("lo") < F.max("hi")).alias("varies"),
                   F.sum(F.col("m2") + F.col("n") * F.pow(F.col("mean") - F.col("grand"), 2)).alias("m2")))
    power = F.get(F.get(F.array(*[doubles(grids[c]) for c in columns]), F.col("c")), F.col("l"))
    variance = F.col("m2") / F.col("n")
    return merged.select(
        "c", "l", power.alias("lam"), "n",
        F.when(F.col("varies") & (variance > 0), -F.col("n") / 2 * F.ln(variance) + (power - 1) * F.col("jac")).alias("llf"))


def _best(df: DataFrame, columns: Sequence[str], grids: Mapping[str, Sequence[float]]) -> dict[str, list[tuple[float, float]]]:
    table: dict[str, list[tuple[float, float]]] = {c: [] for c in columns}
    for r in log_likelihoods(df, columns, grids).collect():
        if r["llf"] is not None and np.isfinite(r["llf"]):
            table[columns[r["c"]]].append((r["lam"], r["llf"]))
    return {c: sorted(rows) for c, rows in table.items()}


def _top(scored: Sequence[tuple[float, float]]) -> int:
    return max(range(len(scored)), key=lambda i: scored[i][1])


def best_on_grid(df: DataFrame, columns: Sequence[str], grid: Sequence[float]) -> dict[str, float]:
    """The likeliest power of a fixed grid per column; 1 for a constant or empty column."""
    scored = _best(df, columns, dict.fromkeys(columns, grid))
    return {c: rows[_top(rows)][0] if rows else 1.0 for c, rows in scored.items()}


def fit_lambdas(df: DataFrame, columns: Sequence[str], coarse: Sequence[float] = COARSE,
                refinements: int = 1) -> dict[str, float]:
    """Coarse grid, finer grids around the best power, then a parabola through the best three.

    Every scan serves all columns still open, each on its own grid. While the best power is at an end of
    its grid, the grid moves there with steps twice as wide; it gets finer only when the likelihood is
    seen to fall on both sides. A column for which it never falls has no optimum: that is warned of, and it
    keeps power 1, like a constant or empty column.
    """
    chosen = dict.fromkeys(columns, 1.0)
    grids = {c: list(coarse) for c in columns}
    steps = dict.fromkeys(columns, coarse[1] - coarse[0])
    finest = (coarse[1] - coarse[0]) / 10 ** refinements
    while grids:
        for c, rows in _best(df, list(grids), grids).items():
            if not rows:
                if steps[c] > coarse[1] - coarse[0]:
                    _without_optimum(c, chosen)
                del grids[c]
                continue
            chosen[c] = rows[_top(rows)][0]
            at = grids[c].index(chosen[c])
            at_end = at in (0, len(grids[c]) - 1)
            # Beside the best power the likelihood may be beyond doubles: nearer to it, it is not.
            falls = not at_end and {grids[c][at - 1], grids[c][at + 1]} <= {lam for lam, _ in rows}
            if falls and steps[c] <= max(finest, abs(chosen[c]) * RELATIVE):
                chosen[c] = _parabola_top(rows)
                del grids[c]
                continue
            steps[c] = steps[c] * 2 if at_end else steps[c] / 10
            if not NARROWEST <= steps[c] <= WIDEST:
                _without_optimum(c, chosen)
                del grids[c]
                continue
            grids[c] = [chosen[c] + k * steps[c] for k in range(-10, 11)]
    return chosen


def _without_optimum(column: str, chosen: dict[str, float]) -> None:
    warnings.warn(f"the power of {column} has no optimum: its likelihood is not seen to fall on both sides of {chosen[column]:g}", stacklevel=3)
    chosen[column] = 1.0


def _parabola_top(scored: Sequence[tuple[float, float]]) -> float:
    i = _top(scored)
    if i in (0, len(scored) - 1):
        return scored[i][0]
    (x0, y0), (x1, y1), (x2, y2) = scored[i - 1:i + 2]
    bend = y0 - 2 * y1 + y2
    return x1 if bend >= 0 else x1 + (x2 - x1) * 0.5 * (y0 - y2) / bend
