"""A linear model of features worked out on the fly, under a Huber loss with a free scale.

The loss of a row with residual r is that of Spark's robust linear regression: with the scale s, half of
s + r^2 / s, or, where |r| is beyond epsilon * s, of s + 2 * epsilon * |r| - s * epsilon^2. It is convex in
weights, intercept and scale together, so Newton's steps find its minimum in a few scans. A scan works the
features out again from the columns behind them and adds up a gradient and a matrix of fixed size per task:
features are neither stored nor sent, however many rows there are.
"""

from __future__ import annotations

from collections.abc import Callable, Generator, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 2_048  # rows whose features a task holds at once
SENT = 65_536  # sums to a row of the shuffle
_SUMS = "at int, part int, sums binary"


def _added_up(rows: DataFrame, sums_of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of ``sums_of`` over chunks of all rows; a task sends its sums once, in pieces that are merged one by one."""
    def parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            cells = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])
            for at in range(0, len(cells), CHUNK):
                own = sums_of(cells[at:at + CHUNK])
                total = own if total is None else total + own
        for at in range(0, 0 if total is None else len(total), SENT):
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([TaskContext.get().partitionId()], pa.int32()),
                                              pa.array([total[at:at + SENT].tobytes()], pa.binary())], ["at", "part", "sums"])

    def merged(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        total = np.sum([np.frombuffer(s) for s in table["sums"].to_pylist()], axis=0)
        return pa.table({"at": table["at"][:1], "part": table["part"][:1], "sums": pa.array([total.tobytes()], pa.binary())})

    found = rows.mapInArrow(parts, _SUMS).groupBy("at").applyInArrow(merged, _SUMS).select("at", "sums").collect()
    return np.concatenate([np.frombuffer(s) for _, s in sorted(found)]) if found else np.zeros(0)


def _features(lifted: Callable[[np.ndarray], np.ndarray], cells: np.ndarray) -> np.ndarray:
    x = lifted(cells[:, :-1])
    if np.isnan(x).any():
        raise ValueError("features must not be missing: impute them before a kernel model")
    return x


def _products(rows: DataFrame, lifted: Callable, width: int) -> np.ndarray:
    """Sums of products of the features, one, and the target."""
    def sums(cells: np.ndarray) -> np.ndarray:
        z = np.column_stack([_features(lifted, cells), np.ones(len(cells)), cells[:, -1]])
        return (z.T @ z).ravel()

    found = _added_up(rows, sums)
    if not len(found):
        raise ValueError("a kernel model cannot be fitted without rows")
    return found.reshape(width + 2, width + 2)


def _at(rows: DataFrame, lifted: Callable, inverse: np.ndarray, point: np.ndarray, epsilon: float, penalty: float):
    """Mean loss, its gradient and its second derivatives at (weights of scaled features, intercept, scale)."""
    weights, intercept, scale = point[:-2], point[-2], point[-1]
    size = len(point)

    def sums(cells: np.ndarray) -> np.ndarray:
        x = _features(lifted, cells) * inverse
        r = (cells[:, -1] - x @ weights - intercept) / scale
        u, inside = np.clip(r, -epsilon, epsilon), np.abs(r) <= epsilon
        loss = scale / 2 * np.where(inside, 1 + r * r, 1 + 2 * epsilon * np.abs(r) - epsilon * epsilon).sum()
        q = np.column_stack([x, np.ones(len(x)), r])[inside]
        return np.concatenate([[len(x), loss], -(u @ x), [-u.sum(), (1 - u * u).sum() / 2], (q.T @ q).ravel() / scale])

    found = _added_up(rows, sums)
    n, loss, slope, bend = found[0], found[1], found[2:2 + size], found[2 + size:].reshape(size, size)
    held = penalty * np.append(np.ones(size - 2), [0.0, 0.0])
    return loss / n + held @ point**2 / 2, slope / n + held * point, bend / n + np.diag(held)


def fit(rows: DataFrame, lifted: Callable[[np.ndarray], np.ndarray], width: int, epsilon: float = 1.35,
        penalty: float = 1e-4, max_iter: int = 200, tol: float = 1e-10) -> tuple[np.ndarray, float]:
    """Weights and intercept on ``width`` features that ``lifted`` makes of all columns but the last, the target.

    The penalty is on features scaled by their deviation; a constant feature gets no weight. Starts from
    least squares. Steps end when one more could lower the loss by ``tol`` of it at most.
    """
    rows = rows.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(rows.columns)])
    products = _products(rows, lifted, width)
    inverse, point, descends = _start(products, penalty)
    if descends:
        steps = _descent(point, max_iter, tol)
        point = next(steps)
        try:
            while True:
                point = steps.send(_at(rows, lifted, inverse, point, epsilon, penalty))
        except StopIteration as end:
            point = end.value
    return point[:-2] * inverse, float(point[-2])


def _start(products: np.ndarray, penalty: float) -> tuple[np.ndarray, np.ndarray, bool]:
    """Inverse deviations, the point of least squares, and whether anything is left to explain there."""
    width = len(products) - 2
    n, mean = products[-2, -2], products[-2] / products[-2, -2]
    spread = products - n * np.outer(mean, mean)
    variance = np.diag(spread)[:width] / max(1.0, n - 1)
    constant = variance <= 1e-12 * np.diag(products)[:width] / n
    inverse = np.where(constant, 0.0, 1 / np.sqrt(np.where(constant, 1.0, variance)))
    xx, xy = spread[:width, :width] * np.outer(inverse, inverse), spread[:width, -1] * inverse
    weights = np.linalg.lstsq(xx / n + penalty * np.eye(width), xy / n, rcond=None)[0]
    rest = spread[-1, -1] - 2 * weights @ xy + weights @ xx @ weights
    point = np.concatenate([weights, [mean[-1] - mean[:width] @ (weights * inverse), np.sqrt(max(0.0, rest) / n)]])
    return inverse, point, bool(point[-1] > 1e-7 * np.sqrt(products[-1, -1] / n))


def _descent(point: np.ndarray, max_iter: int, tol: float) -> Generator[np.ndarray, tuple, np.ndarray]:
    """Newton's steps, shortened until they lower the loss; the last of the point stays above zero.

    Gives the points at which it needs loss, gradient and second derivatives, and returns the last.
    """
    loss, slope, bend = yield point
    for _ in range(max_iter):
        step = -np.linalg.lstsq(bend, slope, rcond=1e-13)[0]
        gain = -slope @ step
        if not gain > tol * loss:
            break
        share = min(1.0, 0.9 * point[-1] / -step[-1]) if step[-1] < 0 else 1.0
        while share > 1e-6:
            trial = point + share * step
            now = yield trial
            if now[0] <= loss - 1e-4 * share * gain:
                break
            share /= 4
        else:
            break
        point, (loss, slope, bend) = trial, now
    return point


# --- many fits at once --------------------------------------------------------------------

@dataclass(frozen=True)
class Fit:
    """A fit on the rows outside of one fold."""

    fold: int
    lifted: Callable[[np.ndarray], np.ndarray]
    width: int
    epsilon: float = 1.35
    penalty: float = 1e-4
    max_iter: int = 200


def fit_folds(rows: DataFrame, fits: Mapping[int, Fit], tol: float = 1e-10) -> dict[int, tuple[np.ndarray, float]]:
    """Weights and intercept of every fit, as ``fit`` finds them, by scans that all fits share.

    The first column of ``rows`` is the fold, the last the target. Fits with the same ``lifted`` share their
    features. Sums of products over all rows of a fold never change: a scan adds up those of the few
    rows beyond ``epsilon`` only, which are taken off.
    """
    rows = rows.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(rows.columns)])
    lifts = {id(f.lifted): f for f in fits.values()}

    def products(cells: np.ndarray) -> np.ndarray:
        found = []
        for f in lifts.values():
            own = cells[cells[:, 0] != f.fold, 1:]
            z = np.column_stack([_features(f.lifted, own), np.ones(len(own)), own[:, -1]])
            found.append((z.T @ z).ravel())
        return np.concatenate(found)

    found = _added_up(rows, products)
    if not len(found):
        raise ValueError("a kernel model cannot be fitted without rows")
    whole = dict(zip(lifts, _pieces(found, [(f.width + 2)**2 for f in lifts.values()]), strict=True))
    started = {i: _start(whole[id(f.lifted)].reshape(f.width + 2, f.width + 2), f.penalty) for i, f in fits.items()}
    points = {i: point for i, (_, point, _) in started.items()}
    steps = {i: _descent(points[i], fits[i].max_iter, tol) for i, (_, _, descends) in started.items() if descends}
    asked = {i: next(s) for i, s in steps.items()}
    while asked:
        ways = {k: (f.fold, f.lifted, [(asked[i], fits[i].epsilon) for i in asked if id(fits[i].lifted) == k],
                    next(started[i][0] for i in fits if id(fits[i].lifted) == k)) for k, f in lifts.items()}

        def sums(cells: np.ndarray, ways: tuple = tuple(w for w in ways.values() if w[2])) -> np.ndarray:
            found = []
            for fold, lifted, own, inverse in ways:
                rest = cells[cells[:, 0] != fold, 1:]
                x = np.column_stack([_features(lifted, rest) * inverse, np.ones(len(rest))])
                found += [_terms(x, rest[:, -1], point, epsilon) for point, epsilon in own]
            return np.concatenate(found)

        order = [i for k in ways for i in asked if id(fits[i].lifted) == k]
        added = _pieces(_added_up(rows, sums), [3 + 2 * (fits[i].width + 1) + (fits[i].width + 1)**2 for i in order])
        for i, terms in zip(order, added, strict=True):
            f, inverse = fits[i], started[i][0]
            scaled = np.append(inverse, 1.0)
            gram = whole[id(f.lifted)].reshape(f.width + 2, f.width + 2)[:-1, :-1] * np.outer(scaled, scaled)
            try:
                asked[i] = steps[i].send(_from_terms(terms, gram, asked[i], f.epsilon, f.penalty))
            except StopIteration as end:
                points[i] = end.value
                del asked[i]
    return {i: (points[i][:-2] * started[i][0], float(points[i][-2])) for i in fits}


def _pieces(found: np.ndarray, sizes: Sequence[int]) -> list[np.ndarray]:
    return np.split(found, np.cumsum(sizes)[:-1])


def _terms(x: np.ndarray, y: np.ndarray, point: np.ndarray, epsilon: float) -> np.ndarray:
    """What a chunk adds to loss and derivatives; products of the features only of rows beyond ``epsilon``."""
    r = (y - x @ point[:-1]) / point[-1]
    u, inside = np.clip(r, -epsilon, epsilon), np.abs(r) <= epsilon
    lost, held = np.where(inside, 1 + r * r, 1 + 2 * epsilon * np.abs(r) - epsilon * epsilon).sum(), np.where(inside, r, 0.0)
    beyond = x[~inside]
    return np.concatenate([[lost, (1 - u * u).sum(), held @ held], u @ x, held @ x, (beyond.T @ beyond).ravel()])


def _from_terms(terms: np.ndarray, gram: np.ndarray, point: np.ndarray, epsilon: float, penalty: float) -> tuple:
    """Mean loss, its gradient and its second derivatives, as ``_at`` gives them."""
    size, n, scale = len(point), gram[-1, -1], point[-1]
    (lost, flat, square), rest = terms[:3], terms[3:]
    slope = np.append(-rest[:size - 1], flat / 2)
    across, beyond = rest[size - 1:2 * size - 2], rest[2 * size - 2:].reshape(size - 1, size - 1)
    bend = np.block([[gram - beyond, across[:, None]], [across[None, :], np.array([[square]])]]) / scale
    held = penalty * np.append(np.ones(size - 2), [0.0, 0.0])
    return scale / 2 * lost / n + held @ point**2 / 2, slope / n + held * point, bend / n + np.diag(held)
