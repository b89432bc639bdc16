"""Global order without a single-partition window."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabfeat.session import checkpointed, tiny_table

_ROW_BITS = 33  # monotonically_increasing_id keeps the partition above this many row bits
_FIRST_DIGITS = 3
# (which digest, prefix) -> rows before the prefix, wanted ranks inside it
Prefixes = dict[tuple[int, str], tuple[int, list[int]]]


def global_rank(df: DataFrame, order: Sequence[str | Column], name: str = "rank") -> DataFrame:
    """Add the 1-based position of every row in the total order ``order``.

    One range shuffle sorts the rows; the sorted frame is checkpointed so that the partition
    offsets, counted afterwards, belong to exactly these partitions. Put a unique column last
    in ``order``: ties then spread over partitions and the result is deterministic.
    """
    tagged = checkpointed(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    part = F.shiftright("_id", _ROW_BITS).alias("_part")
    counts = sorted(tagged.groupBy(part).count().collect())
    offsets, running = [], 0
    for number, count in counts:
        offsets.append((number, running))
        running += count
    table = tiny_table(df.sparkSession, offsets, "_part bigint, _offset bigint")
    row = F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (tagged.withColumn("_part", part)
            .join(F.broadcast(table), "_part")
            .withColumn(name, F.col("_offset") + row + 1)
            .drop("_part", "_offset", "_id"))


def joint_cutoffs(df: DataFrame, digests: Sequence[Column], ranks: Callable[[int], Sequence[Sequence[int]]],
                  collect_limit: int = 20_000) -> list[list[str | None]]:
    """For each digest, the values at the 1-based ranks that ``ranks`` wants of so many rows.

    Comparing a row's digest with such a cutoff splits a frame at an exact row count without
    ranking, sorting or shuffling its rows. Rank 0 gives None. One scan counts the rows by prefixes
    of all digests at once, which also tells how many rows there are; the next one reads the few
    digests that share a prefix with a cutoff. Only if these are more than ``collect_limit`` are
    prefixes of up to four more digits counted first. A shuffle holds at most 4,096 counts a digest
    and task in the first scan and 65,536 a prefix and task later on.
    """
    spread = df.select(F.posexplode(F.array(*digests)).alias("which", "h"))
    known, length = 0, _FIRST_DIGITS
    counts = _prefix_counts(spread, length)
    total = sum(n for which, _, n in counts if which == 0)
    wanted = ranks(total)
    found: dict[tuple[int, int], str | None] = {(which, 0): None for which in range(len(digests))}
    prefixes = {(which, ""): (0, sorted({r for r in asked if r > 0})) for which, asked in enumerate(wanted)}
    while True:
        prefixes, rows = _narrowed(prefixes, counts, known)
        if not prefixes:
            break
        near = spread.where(_starts_with(prefixes, length))
        if rows <= collect_limit:
            _read_cutoffs(near, prefixes, length, found)
            break
        if length >= 32:
            raise ValueError("the key does not identify rows: one digest repeats too often")
        known, length = length, min(32, length + max(1, min(4, math.ceil(math.log(rows / 1_000, 16)))))
        counts = _prefix_counts(near, length)
    return [[found[which, r] for r in asked] for which, asked in enumerate(wanted)]


def _prefix_counts(spread: DataFrame, length: int) -> list[tuple[int, str, int]]:
    counts = spread.groupBy("which", F.substring("h", 1, length).alias("p")).count().toPandas()
    return sorted(zip(counts["which"].tolist(), counts["p"].tolist(), counts["count"].tolist(), strict=True))


def _starts_with(prefixes: Prefixes, length: int) -> Column:
    groups: dict[int, list[str]] = {}
    for which, p in prefixes:
        groups.setdefault(which, []).append(p)
    return reduce(Column.__or__, [(F.col("which") == which) & F.substring("h", 1, length).isin(members)
                                  for which, members in groups.items()])


def _narrowed(prefixes: Prefixes, counts: Sequence[tuple[int, str, int]], known: int) -> tuple[Prefixes, int]:
    """The longer prefixes that hold a wanted rank, each with the rows below it, and all their rows."""
    narrowed, rows, running = {}, 0, {}
    for which, prefix, count in counts:
        parent = (which, prefix[:known])
        start, wanted = prefixes[parent]
        below = running.get(parent, start)
        inside = [r for r in wanted if below < r <= below + count]
        if inside:
            narrowed[which, prefix] = (below, inside)
            rows += count
        running[parent] = below + count
    return narrowed, rows


def _read_cutoffs(near: DataFrame, prefixes: Prefixes, length: int, found: dict[tuple[int, int], str | None]) -> None:
    members: dict[tuple[int, str], list[str]] = {}
    for which, h in near.collect():
        members.setdefault((which, h[:length]), []).append(h)
    for (which, p), (below, ranks) in prefixes.items():
        ordered = sorted(members[which, p])
        for r in ranks:
            at = r - below - 1
            if at + 1 < len(ordered) and ordered[at] == ordered[at + 1]:
                raise ValueError("the key does not identify rows: equal keys at the cut")
            found[which, r] = ordered[at]
