"""Training rows of tree models, added up by cell.

A tree sees of a row only the bin of every feature. Rows with equal bins form a cell; their number and
mean target are all that the squared error of a split depends on, so a tree of weighted cells is the
tree of the rows. There are at most ``bins ** features`` cells, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabfeat.functions.shape import bin_code
from tabfeat.session import checkpointed, scratch_path, small_side

BINS, BIN_BITS = 32, 5
MOST_FEATURES = 12  # their bins fit a bigint
SPLIT_ROWS = 10_000  # Spark's trees, too, place their thresholds by so many rows
DRAWN_ROWS = 1 << 18  # rows drawn at a time
DRAWN_BYTES = 256 << 20  # of sums held by a task
BUCKETS = 128
AT_ONCE = 8
VECTOR = "_x"
_DRAWN = "bucket int, cell bigint, n binary, total binary"
_TREE_CELLS = "tree int, cell bigint, n double, y double"


def thresholds(values: np.ndarray, bins: int = BINS) -> list[float]:
    """Middles between neighbouring values, where few; else at about equal shares, as Spark's trees place them."""
    x, counts = np.unique(values[~np.isnan(values)], return_counts=True)
    splits = min(bins, len(values)) - 1
    middles = (x[:-1] + x[1:]) / 2
    if len(middles) <= splits:
        return middles.tolist()
    stride = len(values) / (splits + 1)
    upto, found, target = np.cumsum(counts).tolist(), [], stride
    for i in range(1, len(x)):
        if abs(upto[i - 1] - target) < abs(upto[i] - target):
            found.append(float(middles[i - 1]))
            target += stride
    return found


@dataclass(frozen=True)
class Cells:
    """The thresholds of every feature, and the cell they put a row in."""

    features: tuple[str, ...]
    edges: tuple[tuple[float, ...], ...]

    @classmethod
    def of(cls, rows: DataFrame, features: Sequence[str], seed: int) -> Cells:
        """Thresholds from rows drawn in one scan; from all rows when there are no more."""
        drawn = (rows.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(features)])
                 .orderBy(F.rand(seed)).limit(SPLIT_ROWS).toPandas())
        return cls(tuple(features), tuple(tuple(thresholds(drawn[c].to_numpy(float))) for c in drawn))

    def code(self) -> Column:
        """The bins of a row as one number; null if a feature is missing."""
        number, known = F.lit(0).cast("bigint"), F.lit(True)
        for i, (c, own) in enumerate(zip(self.features, self.edges, strict=True)):
            x = F.col(c).cast("double")
            known = known & ~F.isnan(x)
            number = number.bitwiseOR(F.shiftleft(bin_code(x, own).cast("bigint"), i * BIN_BITS))
        return F.when(known, number)

    def vectors(self, df: DataFrame, code: Column) -> DataFrame:
        """The bins of a cell as the vector a tree reads; a missing feature is an error."""
        names = [f"_b{i}" for i in range(len(self.features))]
        bins = {n: F.shiftright(code, i * BIN_BITS).bitwiseAND(F.lit(BINS - 1)).cast("double") for i, n in enumerate(names)}
        return VectorAssembler(inputCols=names, outputCol=VECTOR, handleInvalid="error").transform(df.withColumns(bins)).drop(*names)

    def added_up(self, rows: DataFrame, target: str) -> DataFrame:
        """(cell, n, y): rows and mean target of every cell."""
        return checkpointed(rows.select(self.code().alias("cell"), F.col(target).cast("double").alias("y"))
                            .groupBy("cell").agg(F.count("*").cast("double").alias("n"), F.avg("y").alias("y")))


# --- forests ------------------------------------------------------------------------------

def _drawn(trees: int, seed: int):
    """Per task: every tree draws each row a Poisson number of times; the draws are added up by cell."""
    limit = max(1, DRAWN_BYTES // (trees * 12))

    def rows_of(cells: np.ndarray, n: np.ndarray, total: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(cells), 4096):
            own = slice(at, at + 4096)
            yield pa.RecordBatch.from_arrays(
                [pa.array((cells[own] % 1_000_003 % BUCKETS).astype(np.int32)), pa.array(cells[own]),
                 pa.array([r.tobytes() for r in n[:, own].T], pa.binary()), pa.array([r.tobytes() for r in total[:, own].T], pa.binary())],
                ["bucket", "cell", "n", "total"])

    def draw(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng([seed, TaskContext.get().partitionId()])
        cells, n, total = np.zeros(0, np.int64), np.zeros((trees, 0), np.int32), np.zeros((trees, 0))
        for code, y in _chunks(batches):
            own, place = np.unique(code, return_inverse=True)
            merged = np.union1d(cells, own)
            if len(merged) > limit and len(cells):
                yield from rows_of(cells, n, total)
                cells, n, total, merged = own, np.zeros((trees, len(own)), np.int32), np.zeros((trees, len(own))), own
            elif len(merged) > len(cells):
                wide_n, wide_total = np.zeros((trees, len(merged)), np.int32), np.zeros((trees, len(merged)))
                at = np.searchsorted(merged, cells)
                wide_n[:, at], wide_total[:, at] = n, total
                cells, n, total = merged, wide_n, wide_total
            place = np.searchsorted(cells, own)[place]
            for t in range(trees):
                times = rng.poisson(1.0, len(y))
                n[t] += np.bincount(place, weights=times, minlength=len(cells)).astype(np.int32)
                total[t] += np.bincount(place, weights=times * y, minlength=len(cells))
        yield from rows_of(cells, n, total)

    return draw


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= DRAWN_ROWS:
            yield _columns(held)
            held, size = [], 0
    if size:
        yield _columns(held)


def _columns(batches: Sequence[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
    table = pa.Table.from_batches(batches)
    return table["cell"].to_numpy(), table["y"].to_numpy()


def _by_tree(trees: int):
    """The sums of a bucket's cells, one row per tree and cell that it drew."""
    def merge(table: pa.Table) -> pa.Table:
        cells, place = np.unique(table["cell"].to_numpy(), return_inverse=True)
        n, total = np.zeros((len(cells), trees)), np.zeros((len(cells), trees))
        for at in range(0, len(place), 4096):
            own = slice(at, at + 4096)
            part = table.slice(at, 4096)
            np.add.at(n, place[own], np.frombuffer(b"".join(part["n"].to_pylist()), np.int32).reshape(-1, trees))
            np.add.at(total, place[own], np.frombuffer(b"".join(part["total"].to_pylist()), np.float64).reshape(-1, trees))
        c, t = np.nonzero(n)
        return pa.table({"tree": pa.array(t.astype(np.int32)), "cell": pa.array(cells[c]), "n": pa.array(n[c, t]),
                         "y": pa.array(total[c, t] / n[c, t])})
    return merge


def drawn_cells(rows: DataFrame, cells: Cells, target: str, trees: int, seed: int) -> str:
    """A folder per tree with the cells of its bootstrap draw: (cell, n, y)."""
    path = scratch_path(rows.sparkSession, "trees")
    coded = rows.select(cells.code().alias("cell"), F.col(target).cast("double").alias("y"))
    (coded.mapInArrow(_drawn(trees, seed), _DRAWN).groupBy("bucket").applyInArrow(_by_tree(trees), _TREE_CELLS)
     .repartition(trees, "tree").write.partitionBy("tree").parquet(path))
    return path


def fit_forest(rows: DataFrame, cells: Cells, target: str, trees: int, depth: int, seed: int) -> list:
    """Trees of bootstrap draws, each splitting by a third of the features at a node: fitted a few at a time."""
    path = drawn_cells(rows, cells, target, trees, seed)

    def fit(tree: int):
        own = rows.sparkSession.read.schema("cell bigint, n double, y double").parquet(f"{path}/tree={tree}")
        return RandomForestRegressor(
            numTrees=1, maxDepth=depth, bootstrap=False, featureSubsetStrategy="onethird", seed=seed + tree, maxBins=BINS,
            featuresCol=VECTOR, labelCol="y", weightCol="n", predictionCol="pred").fit(cells.vectors(own, F.col("cell")))

    with ThreadPoolExecutor(max_workers=min(AT_ONCE, trees)) as pool:
        return list(pool.map(fit, range(trees)))


def predicted(df: DataFrame, cells: Cells, models: Sequence) -> DataFrame:
    """The mean of the trees' predictions, worked out once for every cell that occurs."""
    coded = df.withColumn("_cell", cells.code())
    found = cells.vectors(coded.select("_cell").distinct(), F.col("_cell"))
    names = []
    for i, model in enumerate(models):
        names.append(f"_p{i}")
        found = model.setPredictionCol(names[-1]).transform(found)
    mean = sum((F.col(n) for n in names[1:]), F.col(names[0])) / len(names)
    known = checkpointed(found.select(F.col("_cell").alias("_known"), mean.alias("pred")))
    # An inner join would work out the cell once more, to leave nulls out.
    return coded.join(small_side(known), F.col("_cell") == F.col("_known"), "left").drop("_cell", "_known")
