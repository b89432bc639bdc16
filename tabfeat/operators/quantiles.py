"""Exact quantiles of any number of columns in a few scans, without sorting, exploding or collecting the data.

Doubles are seen as whole numbers of the same order, so a range of values is a range of numbers that can
always be halved. Every scan counts the values of all columns into slots: each task adds up one array of
counts over its Arrow batches, and the arrays are added up by slot. Only the slots that hold a wanted
order statistic are looked at again, until few values are left, which are counted one by one. All columns
share a fixed number of slots, so neither a task nor the driver holds more however wide the table is.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabfeat.functions.literals import doubles
from tabfeat.session import checkpointed, small_side

ACCURACY = 10_000
COLLECT_LIMIT = 300_000
SLOTS = 1 << 19  # of all columns of a scan together
COLUMN_SLOTS = 16_384  # of one column
SCAN_COLUMNS = 2_048  # more columns take turns
GROUP_SLOTS = 1_024  # of a bracket of a group
FEW = 100_000  # values of a bracket that are ordered in one task
_SIGN = np.int64(0x7FFFFFFFFFFFFFFF)


@dataclass
class _Bracket:
    """The numbers ``lo`` … ``hi`` of a column, known to hold its order statistics ``ranks`` (0-based)."""

    lo: int
    hi: int
    below: int
    size: int
    ranks: list[int]


def _as_columns(columns: Mapping[str, Column] | Sequence[str]) -> dict[str, Column]:
    if not isinstance(columns, Mapping):
        columns = {c: F.col(c) for c in columns}
    return {c: e.cast("double") for c, e in columns.items()}


def approximate_quantiles(df: DataFrame, columns: Mapping[str, Column] | Sequence[str],
                          probs: Sequence[float], accuracy: int = ACCURACY) -> dict[str, list[float | None]]:
    """One scan; each answer is an actual element with rank error below ``n / accuracy``."""
    columns = _as_columns(columns)
    if not columns:
        return {}
    wanted = doubles(probs)
    row = df.agg(*[F.percentile_approx(e, wanted, accuracy).alias(f"q{i}")
                   for i, e in enumerate(columns.values())]).first()
    return {c: list(row[i]) if row[i] is not None else [None] * len(probs) for i, c in enumerate(columns)}


def _numbers(x: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the doubles; both zeros are one, NaN comes last."""
    bits = np.where(np.isnan(x), np.nan, x + 0.0).view(np.int64)
    return bits ^ ((bits >> 63) & _SIGN)


def _double(number: int) -> float:
    bits = np.int64(number)
    return float((bits ^ ((bits >> np.int64(63)) & _SIGN)).view(np.float64))


def _present(column) -> np.ndarray:
    return _numbers(column.drop_null().to_numpy(zero_copy_only=False).astype(np.float64))


def _spans(columns: int):
    """Per task: count, smallest and largest number of each column."""
    def spans(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, lo, hi = np.zeros(columns, np.int64), np.full(columns, _SIGN), np.full(columns, -_SIGN)
        for batch in batches:
            for i in range(columns):
                x = _present(batch.column(i))
                if len(x):
                    n[i], lo[i], hi[i] = n[i] + len(x), min(lo[i], x.min()), max(hi[i], x.max())
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in (at, n[at], lo[at], hi[at])], ["c", "n", "lo", "hi"])
    return spans


def _counts(cuts: Mapping[int, np.ndarray], starts: Mapping[int, int], size: int):
    """Per task: how many values of each column lie between two neighbouring cuts."""
    def counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for i, (c, edges) in enumerate(cuts.items()):
                slot = np.searchsorted(edges, _present(batch.column(i)), side="right")
                total[starts[c]:starts[c] + len(edges) + 1] += np.bincount(slot, minlength=len(edges) + 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["slot", "n"])
    return counts


def _values(cuts: Mapping[int, np.ndarray]):
    """Per task: the distinct numbers within a column's brackets, whose ends the cuts are, and their counts."""
    def values(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {c: [] for c in cuts}
        for batch in batches:
            for i, (c, edges) in enumerate(cuts.items()):
                x = _present(batch.column(i))
                held[c].append(x[np.searchsorted(edges, x, side="right") % 2 == 1])
        for c, parts in held.items():
            x, n = np.unique(np.concatenate(parts), return_counts=True) if parts else (np.zeros(0, np.int64),) * 2
            if len(x):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), c)), pa.array(x), pa.array(n)], ["c", "x", "n"])
    return values


def exact_quantiles(df: DataFrame, columns: Mapping[str, Column] | Sequence[str],
                    probs: Sequence[float], collect_limit: int = COLLECT_LIMIT) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of every column; nulls are ignored, all-null gives None."""
    columns = _as_columns(columns)
    names, found = list(columns), {}
    for at in range(0, len(names), SCAN_COLUMNS):
        found.update(_exact(df, {c: columns[c] for c in names[at:at + SCAN_COLUMNS]}, probs, collect_limit))
    return found


def exact_ranks(df: DataFrame, column: Column, ranks_of: Callable[[int], Iterable[int]], collect_limit: int = COLLECT_LIMIT) -> tuple[int, dict[int, float]]:
    """The number of values, and those at the ranks (from 0) that ``ranks_of`` wants of so many."""
    spans, found = _order_statistics(df, {"x": column.cast("double")}, ranks_of, collect_limit)
    return (spans[0]["n"], {r: _double(v) for r, v in found[0].items()}) if spans else (0, {})


def _exact(df: DataFrame, columns: Mapping[str, Column], probs: Sequence[float], collect_limit: int) -> dict[str, list[float | None]]:
    spans, found = _order_statistics(df, columns, lambda n: {r for p in probs for r in _around(n, p)}, collect_limit)

    def answer(c: int, p: float) -> float | None:
        if c not in spans:
            return None
        left, right = (_double(found[c][r]) for r in _around(spans[c]["n"], p))
        position = (spans[c]["n"] - 1) * p
        return left if left == right else left + (right - left) * (position - math.floor(position))

    return {name: [answer(c, p) for p in probs] for c, name in enumerate(columns)}


def _order_statistics(df: DataFrame, columns: Mapping[str, Column], ranks_of: Callable[[int], Iterable[int]],
                      collect_limit: int) -> tuple[dict, dict[int, dict[int, int]]]:
    """Per column number its count and ends, and the numbers at the wanted ranks."""
    cells = df.select(*[e.alias(f"c{i}") for i, e in enumerate(columns.values())])
    spans = {r["c"]: r for r in cells.mapInArrow(_spans(len(columns)), "c bigint, n bigint, lo bigint, hi bigint")
             .groupBy("c").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect()}
    found: dict[int, dict[int, int]] = {c: {} for c in spans}
    brackets = {c: [_Bracket(s["lo"], s["hi"], 0, s["n"], sorted(ranks_of(s["n"])))]
                for c, s in spans.items()}
    while True:
        for c, own in brackets.items():
            for b in own:
                if b.lo == b.hi:
                    found[c].update(dict.fromkeys(b.ranks, b.lo))
        brackets = {c: left for c, own in brackets.items() if (left := [b for b in own if b.lo < b.hi])}
        if not brackets:
            break
        part = cells.select(*[f"c{c}" for c in brackets])
        if sum(b.size for own in brackets.values() for b in own) <= collect_limit:
            _read(part, brackets, found)
            break
        brackets = _narrowed(part, brackets)
    return spans, found


def _around(n: int, p: float) -> tuple[int, int]:
    return math.floor((n - 1) * p), math.ceil((n - 1) * p)


def _edges(b: _Bracket, slots: int) -> list[int]:
    """Starts of the slots of a bracket: evenly in the order of doubles, which follows the magnitude, and evenly in value."""
    half = max(2, slots // 2)
    width = b.hi - b.lo + 1
    edges = {b.lo + width * k // half for k in range(half)}
    lo, hi = _double(b.lo), _double(b.hi)
    if math.isfinite(lo) and math.isfinite(hi):
        share = np.arange(1, half) / half
        edges.update(_numbers(lo * (1 - share) + hi * share).tolist())
    return sorted(e for e in edges if b.lo <= e <= b.hi)


def _narrowed(cells: DataFrame, brackets: Mapping[int, list[_Bracket]]) -> dict[int, list[_Bracket]]:
    """One scan: every bracket's values are counted into slots, and the slots around the wanted ranks are the next brackets."""
    slots = min(COLUMN_SLOTS, SLOTS // len(brackets))
    cuts = {c: np.array(sorted({e for b in own for e in (*_edges(b, slots // len(own)), b.hi + 1)}), np.int64) for c, own in brackets.items()}
    sizes = [len(e) + 1 for e in cuts.values()]
    starts = dict(zip(cuts, np.cumsum([0, *sizes]).tolist()))
    total = np.zeros(sum(sizes), np.int64)
    counted = cells.mapInArrow(_counts(cuts, starts, len(total)), "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    total[counted["slot"].to_numpy()] = counted["n"].to_numpy()
    found = {}
    for c, own in brackets.items():
        edges, counts = cuts[c], total[starts[c]:starts[c] + len(cuts[c]) + 1]
        found[c] = []
        for b in own:
            first, last = np.searchsorted(edges, [b.lo, b.hi + 1])
            below = b.below + np.concatenate([[0], np.cumsum(counts[first + 1:last + 1])])
            for i in np.unique(np.searchsorted(below, b.ranks, side="right") - 1).tolist():
                found[c].append(_Bracket(int(edges[first + i]), int(edges[first + i + 1]) - 1, int(below[i]), int(below[i + 1] - below[i]),
                                         [r for r in b.ranks if below[i] <= r < below[i + 1]]))
    return found


def _read(cells: DataFrame, brackets: Mapping[int, list[_Bracket]], found: dict[int, dict[int, int]]) -> None:
    cuts = {c: np.array([e for b in own for e in (b.lo, b.hi + 1)], np.int64) for c, own in brackets.items()}
    counted = (cells.mapInArrow(_values(cuts), "c bigint, x bigint, n bigint")
               .groupBy("c", "x").agg(F.sum("n").alias("n")).toPandas().sort_values(["c", "x"]))
    for c, rows in counted.groupby("c"):
        x, n = rows["x"].to_numpy(), rows["n"].to_numpy()
        for b in brackets[c]:
            inside = (x >= b.lo) & (x <= b.hi)
            last = b.below + np.cumsum(n[inside])
            found[c].update({r: int(x[inside][np.searchsorted(last, r, side="right")]) for r in b.ranks})


def quantiles(df: DataFrame, columns: Mapping[str, Column] | Sequence[str],
              probs: Sequence[float], method: str = "exact") -> dict[str, list[float | None]]:
    """``method`` is ``exact`` (interpolated) or ``approx`` (one scan, an actual element)."""
    if method not in ("exact", "approx"):
        raise ValueError(f"unknown quantile method: {method}")
    return (exact_quantiles if method == "exact" else approximate_quantiles)(df, columns, probs)


def grouped_medians(df: DataFrame, by: Sequence[str], value: Column, name: str, few: int = FEW) -> DataFrame:
    """(by…, name): the exact median of every group, whatever their number and sizes.

    The range known to hold each middle value of a group is a row of a table. A pass joins the values with
    their group's ranges, counts them into slots (combined before the shuffle), and keeps the slot that
    holds the middle. Slots alternate between even steps of magnitude and of value. When no range holds
    more than ``few`` values, or none gets smaller, the distinct values left are counted. Nulls are ignored.
    """
    group = F.struct(*[F.col(c).alias(f"g{i}") for i, c in enumerate(by)])
    values = df.select(group.alias("g"), value.cast("double").alias("x")).where("x is not null")
    sizes = values.groupBy("g").agg(F.count("*").alias("size"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    last = F.col("size") - 1
    middle = F.array_distinct(F.array(F.floor(last / 2), F.ceil(last / 2)))
    ranges = checkpointed(sizes.select("g", F.explode(middle).alias("rank"), "lo", "hi", F.lit(0).cast("bigint").alias("below"), "size"))
    most, turn = None, 0
    while True:
        now = ranges.where("lo < hi").agg(F.max("size"), F.sum("size"), F.sum(F.col("hi") / 4 - F.col("lo") / 4)).first()
        # Two turns without progress: what is left are values that no slots can tell apart.
        if now[0] is None or now[0] <= few or now == most and turn % 2 == 0:
            break
        most = now if turn % 2 == 0 else most
        ranges, turn = checkpointed(_next_ranges(values, ranges, by_value=turn % 2 == 1)), turn + 1
    known = ranges.where("NOT lo < hi").select("g", "rank", F.col("lo").alias("x"))
    counted = _in_ranges(values, ranges).groupBy("g", "rank", "below", "x").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("g", "rank").orderBy("x"))
    read = (counted.withColumn("upto", F.col("below") + upto)
            .where((F.col("upto") > F.col("rank")) & (F.col("upto") - F.col("n") <= F.col("rank"))).select("g", "rank", "x"))
    return known.union(read).groupBy("g").agg(F.avg("x").alias(name)).select(*[F.col(f"g.g{i}").alias(c) for i, c in enumerate(by)], name)


def _in_ranges(values: DataFrame, ranges: DataFrame) -> DataFrame:
    """The values that lie in an open range of their group; ranges go along only if they are counted to be few."""
    open_ = ranges.where("lo < hi").withColumnRenamed("g", "h")
    joined = values.join(small_side(open_), F.col("g").eqNullSafe(F.col("h")))
    return joined.where("x >= lo AND x <= hi").drop("h")


def _next_ranges(values: DataFrame, ranges: DataFrame, by_value: bool) -> DataFrame:
    largest = F.lit(np.finfo(float).max)

    def scaled(c: str) -> Column:
        x = F.greatest(-largest, F.least(largest, F.col(c)))
        if by_value:
            return x / 4
        # Sixty powers of two below the largest magnitude of the range are told apart.
        unit = F.greatest(F.abs(F.greatest(-largest, F.col("lo"))), F.abs(F.least(largest, F.col("hi")))) * 2.0**-60
        return F.when(unit > 0, F.signum(x) * F.log1p(F.abs(x) / unit)).otherwise(F.lit(0.0))

    width = scaled("hi") - scaled("lo")
    place = F.when(width > 0, (scaled("x") - scaled("lo")) / width * GROUP_SLOTS).otherwise(F.lit(0.0))
    slot = F.floor(F.greatest(F.lit(0.0), F.least(F.lit(GROUP_SLOTS - 1.0), place)))
    counted = (_in_ranges(values, ranges).groupBy("g", "rank", "below", slot.alias("slot"))
               .agg(F.count("*").alias("size"), F.min("x").alias("lo"), F.max("x").alias("hi")))
    before = F.sum("size").over(Window.partitionBy("g", "rank").orderBy("slot")) - F.col("size")
    kept = (counted.withColumn("below", F.col("below") + before)
            .where((F.col("below") <= F.col("rank")) & (F.col("rank") < F.col("below") + F.col("size"))))
    return kept.select("g", "rank", "lo", "hi", "below", "size").union(ranges.where("NOT lo < hi"))
