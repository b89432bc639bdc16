"""Exact k-nearest-neighbour regression as a partitioned join.

Training rows lie in a tree of cells: a cell of more than one block of rows is split by pivots
taken from its own rows, level by level, until it fits a block or holds a single point. The
tree is a table of children per level and is never held by the driver. A query walks down the
same levels: distances to a cell's pivots and the children's radii bound the k-th neighbour's
distance, and only children that can reach within the bound are visited. Cells that cannot be
split, and the queries of a cell, are cut into blocks of bounded size; each block pair returns
its own best k, and the best k over all of a query's blocks are averaged. The answer is that of
comparing every pair; no pair outside a block pair's best k leaves a task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabfeat.session import checkpointed, small_side
from tabfeat.spec import FeatureSpec

BLOCK_ROWS = 4_096
FANOUT = 256
# Ids of cells are numbers with digits 1 to FANOUT, one a level, so that seven fit a bigint.
LEVELS = 7
_TASK_ROWS = 65_536
_SLICE = 512


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances, added up feature by feature so that equal inputs give equal sums."""
    total = np.zeros((len(x), len(y)))
    for j in range(x.shape[1]):
        total += np.square(x[:, j, None] - y[None, :, j])
    return total


def _points(pivots: pd.DataFrame) -> np.ndarray:
    return np.array([list(p) for p in pivots["point"]], float)


def _to_nearest_pivot(columns: Sequence[str], features: Sequence[str]):
    def assign(rows: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or pivots.empty:
            return pd.DataFrame({c: [] for c in columns})
        pivots = pivots.sort_values("child")
        points, children = _points(pivots), pivots["child"].to_numpy()
        x = rows[list(features)].to_numpy(float)
        nearest, reach = np.zeros(len(x), int), np.zeros(len(x))
        for at in range(0, len(x), _SLICE):
            d = _distances(x[at:at + _SLICE], points)
            nearest[at:at + _SLICE] = d.argmin(axis=1)
            reach[at:at + _SLICE] = np.sqrt(d.min(axis=1))
        return rows.assign(cell=children[nearest], reach=reach)[list(columns)]

    return assign


def _to_reachable_children(columns: Sequence[str], features: Sequence[str], k: int):
    def visit(queries: pd.DataFrame, nodes: pd.DataFrame) -> pd.DataFrame:
        if queries.empty or nodes.empty:
            return pd.DataFrame({c: [] for c in columns})
        points, children = _points(nodes), nodes["child"].to_numpy()
        counts, radii = nodes["n"].to_numpy("int64"), nodes["radius"].to_numpy(float)
        x = queries[[f"q_{c}" for c in features]].to_numpy(float)
        known = queries["bound"].to_numpy(float)
        parts = []
        for at in range(0, len(x), _SLICE):
            d = np.sqrt(_distances(x[at:at + _SLICE], points))
            farthest = d + radii
            order = np.argsort(farthest, axis=1)
            enough = np.cumsum(counts[order], axis=1) >= k
            stop = np.take_along_axis(order, enough.argmax(axis=1)[:, None], 1)
            own = np.where(enough.any(axis=1), np.take_along_axis(farthest, stop, 1)[:, 0], np.inf)
            bound = np.minimum(known[at:at + _SLICE], own)
            # Rounding errors grow with the distances, not with their difference.
            lower = d - radii - 1e-12 * farthest
            q, c = np.nonzero(lower <= (bound * (1 + 1e-9))[:, None])
            parts.append(queries.iloc[q + at].assign(cell=children[c], bound=bound[q], lower=lower[q, c]))
        return pd.concat(parts)[list(columns)]

    return visit


def _block_best(query_key: Sequence[str], row_key: Sequence[str], features: Sequence[str], k: int):
    def best(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        columns = [*query_key, *row_key, "d", "v"]
        if rows.empty or queries.empty:
            return pd.DataFrame({c: [] for c in columns})
        rows = rows.sort_values(list(row_key), kind="stable").reset_index(drop=True)
        y = rows[list(features)].to_numpy(float)
        x = queries[[f"q_{c}" for c in features]].to_numpy(float)
        found_q, found_r, found_d = [], [], []
        for at in range(0, len(x), _SLICE):
            d = _distances(x[at:at + _SLICE], y)
            limit = np.partition(d, min(k, len(y)) - 1, axis=1)[:, min(k, len(y)) - 1]
            q, r = np.nonzero(d <= limit[:, None])
            dist = d[q, r]
            order = np.lexsort((r, dist, q))
            q, r, dist = q[order], r[order], dist[order]
            place = np.arange(len(q)) - np.searchsorted(q, q)
            keep = place < k
            found_q.append(q[keep] + at)
            found_r.append(r[keep])
            found_d.append(dist[keep])
        q, r = np.concatenate(found_q), np.concatenate(found_r)
        out = pd.concat([queries[list(query_key)].iloc[q].reset_index(drop=True),
                         rows[[*row_key, "v"]].iloc[r].reset_index(drop=True)], axis=1)
        out["d"] = np.concatenate(found_d)
        return out[columns]

    return best


def _schema(df: DataFrame) -> str:
    return ", ".join(f"`{c}` {t}" for c, t in df.dtypes)


def _renewed(df: DataFrame) -> DataFrame:
    """The same rows as columns of their own, for a cogroup with a frame they were made from."""
    return df.toDF(*df.columns)


def _pieces(count: Column, size: int) -> Column:
    return F.greatest(F.ceil(count / size), F.lit(1)).cast("int")


@dataclass(frozen=True)
class CellTree:
    """``rows`` with their leaf ``cell``; per level the children ``(cell, child, point, n, radius)`` of
    its split cells; ``leaves`` ``(cell, n)``."""

    rows: DataFrame
    levels: tuple[DataFrame, ...]
    leaves: DataFrame


def cell_tree(rows: DataFrame, features: Sequence[str], row_key: Sequence[str], seed: int = 42) -> CellTree:
    """Split ``rows`` into cells of at most ``BLOCK_ROWS`` rows.

    A larger cell is left only where all its rows are one point (or after ``LEVELS`` levels). The
    pivots of a cell are a sample of its distinct points, about four a block of rows and at most
    ``FANOUT``, with its nearest and its farthest row: a cell of more than one point always falls
    apart, and copies of one point, however many, are no more likely to be drawn than another.
    """
    features, row_key = list(features), list(row_key)
    point, mark = F.array(*features), F.xxhash64(F.lit(seed), *features)
    norm = F.sqrt(reduce(Column.__add__, [F.col(c) * F.col(c) for c in features]))
    open_rows = checkpointed(rows.withColumn("cell", F.lit(0).cast("bigint")).withColumn("reach", norm))
    finished, leaves, levels, pivots = [], [], [], None
    for level in range(LEVELS + 1):
        cells = checkpointed(open_rows.groupBy("cell").agg(
            F.count("*").alias("n"), F.max("reach").alias("radius"), F.approx_count_distinct(mark).alias("points"),
            F.min_by(point, "reach").alias("near"), F.max_by(point, "reach").alias("far")))
        if pivots is not None:
            levels.append(checkpointed(pivots.join(cells.select(F.col("cell").alias("child"), "n", "radius"), "child")))
        too_large = (F.col("n") > BLOCK_ROWS) & (F.col("radius") > 0) & F.lit(level < LEVELS)
        large = cells.where(too_large)
        leaves.append(cells.where(~too_large).select("cell", "n"))
        if large.isEmpty():
            finished.append(open_rows.drop("reach"))
            break
        wanted = F.least(F.ceil(4 * F.col("n") / BLOCK_ROWS), F.lit(FANOUT - 2))
        sizes = small_side(large.select("cell", "points", wanted.alias("wanted"), _pieces(F.col("n"), _TASK_ROWS).alias("pieces")))
        finished.append(open_rows.join(sizes, "cell", "left_anti").drop("reach"))
        # Twice the wanted points are drawn, so the window ranks no more than some hundred a cell.
        drawn = (open_rows.join(sizes, "cell").withColumn("mark", mark)
                 .where(F.pmod("mark", F.lit(1 << 30)) / (1 << 30) * F.col("points") < 2 * F.col("wanted"))
                 .select("cell", "wanted", "mark", point.alias("point")).distinct()
                 .withColumn("place", F.row_number().over(Window.partitionBy("cell").orderBy("mark", "point")))
                 .where("place <= wanted").select("cell", "point"))
        ends = large.select("cell", F.explode(F.array("near", "far")).alias("point"))
        order = Window.partitionBy("cell").orderBy("point")
        pivots = checkpointed(drawn.unionByName(ends).distinct().withColumn(
            "child", F.col("cell") * (FANOUT + 1) + F.row_number().over(order)))
        dealt = open_rows.join(sizes.select("cell", "pieces"), "cell").withColumn(
            "piece", F.pmod(F.xxhash64(*row_key), F.col("pieces")).cast("int")).drop("pieces")
        asked = pivots.join(sizes.select("cell", "pieces"), "cell").withColumn(
            "piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).drop("pieces")
        open_rows = checkpointed(
            dealt.groupBy("cell", "piece").cogroup(_renewed(asked).groupBy("cell", "piece")).applyInPandas(
                _to_nearest_pivot(open_rows.columns, features), _schema(open_rows)))
    return CellTree(reduce(DataFrame.unionByName, finished), tuple(levels), reduce(DataFrame.unionByName, leaves))


def visited_cells(queries: DataFrame, tree: CellTree, features: Sequence[str], query_key: Sequence[str], k: int) -> DataFrame:
    """``queries`` (features named ``q_``) once for every leaf that may hold one of the k nearest rows."""
    visits = (queries.withColumn("cell", F.lit(0).cast("bigint")).withColumn("bound", F.lit(float("inf")))
              .withColumn("lower", F.lit(0.0)))
    least = F.min("bound").over(Window.partitionBy(*query_key))
    for nodes in tree.levels:
        pieces = small_side(visits.join(nodes.select("cell").distinct(), "cell", "left_semi").groupBy("cell").count()
                            .select("cell", _pieces(F.col("count"), _TASK_ROWS).alias("pieces")))
        dealt = visits.join(pieces, "cell").withColumn(
            "piece", F.pmod(F.xxhash64(*query_key), F.col("pieces")).cast("int")).drop("pieces")
        asked = nodes.join(pieces, "cell").withColumn(
            "piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).drop("pieces")
        down = dealt.groupBy("cell", "piece").cogroup(_renewed(asked).groupBy("cell", "piece")).applyInPandas(
            _to_reachable_children(visits.columns, features, k), _schema(visits))
        stay = visits.join(pieces, "cell", "left_anti")
        visits = checkpointed(stay.unionByName(down).withColumn("bound", least)
                              .where(F.col("lower") <= F.col("bound") * (1 + 1e-9)))
    return visits.drop("bound", "lower")


def nearest_mean(train: DataFrame, queries: DataFrame, spec: FeatureSpec, k: int = 5, seed: int = 42) -> DataFrame:
    """``queries`` with ``pred``: the mean target of the k nearest training rows, ties by key."""
    features, key = list(spec.features), list(spec.key)
    row_key, query_key = [f"r_{c}" for c in key], [f"q_{c}" for c in key]
    rows = train.dropna(subset=features).select(
        *[F.col(c).alias(r) for c, r in zip(key, row_key, strict=True)],
        *[F.col(c).cast("double").alias(c) for c in features], F.col(spec.target).cast("double").alias("v"))
    if rows.isEmpty():
        raise ValueError("nearest neighbours need at least one training row")
    asked = (queries.select(*[F.col(c).alias(q) for c, q in zip(key, query_key, strict=True)],
                            *[F.col(c).cast("double").alias(f"q_{c}") for c in features if c not in key]).dropna())
    means = (nearest_rows(rows, row_key, asked, query_key, features, k, seed)
             .groupBy(*[F.col(q).alias(c) for c, q in zip(key, query_key, strict=True)])
             .agg(F.avg("v").alias("pred")))
    return queries.join(means, key, "left")


def nearest_rows(rows: DataFrame, row_key: Sequence[str], asked: DataFrame, query_key: Sequence[str], features: Sequence[str],
                 k: int, seed: int = 42, distinct: bool = False) -> DataFrame:
    """``(query_key, row_key, d, v, _rn)``: the k nearest rows of every query, ties by key, ``_rn`` from 1.

    ``rows`` have features and ``v``, the queries their features as ``q_<feature>``, which may be their key.
    ``distinct`` says that many rows may share a point: only the first k of a point can be among the nearest.
    """
    if distinct:
        first = F.row_number().over(Window.partitionBy(*features).orderBy(*row_key))
        rows = rows.withColumn("_place", first).where(F.col("_place") <= k).drop("_place")
    types = {**dict(asked.dtypes), **dict(rows.dtypes)}
    tree = cell_tree(rows, features, row_key, seed)
    visits = visited_cells(asked, tree, features, query_key, k)
    demand = visits.groupBy("cell").agg(F.count("*").alias("asked"))
    cuts = small_side(tree.leaves.join(demand, "cell").select(
        "cell", _pieces(F.col("n"), BLOCK_ROWS).alias("blocks"), _pieces(F.col("asked"), BLOCK_ROWS).alias("chunks")))
    left = (tree.rows.join(cuts, "cell")
            .withColumn("block", F.pmod(F.xxhash64(*row_key), F.col("blocks")).cast("int"))
            .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
            .drop("blocks", "chunks"))
    right = (visits.join(cuts, "cell")
             .withColumn("chunk", F.pmod(F.xxhash64(*query_key), F.col("chunks")).cast("int"))
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .drop("blocks", "chunks"))
    group = ["cell", "block", "chunk"]
    pairs_schema = ", ".join([*(f"`{c}` {types[c]}" for c in (*query_key, *row_key)), "d double", "v double"])
    pairs = left.groupBy(*group).cogroup(right.groupBy(*group)).applyInPandas(
        _block_best(query_key, row_key, features, k), pairs_schema)
    nearest = Window.partitionBy(*query_key).orderBy("d", *row_key)
    return pairs.withColumn("_rn", F.row_number().over(nearest)).where(F.col("_rn") <= k)
