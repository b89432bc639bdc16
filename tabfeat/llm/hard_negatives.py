"""Hard negatives by exact search over Hilbert-ordered Parquet blocks with zone maps.

Rows are written in the order of a Hilbert curve through their vectors, in blocks of bounded size; a block's
zone map holds the least and the greatest value of every dimension. An anchor is first compared with the
blocks around its own, which gives a threshold. Interval arithmetic on the zone maps then bounds every
score in a block from both sides, and only blocks that can hold a result inside a window are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabfeat.llm.blocks import NO_ID, bounded_batches
from tabfeat.session import checkpointed, scratch_path

ROWS = 1_024  # rows of a block
RUN = 16  # neighbouring blocks that an anchor is compared with first
ANCHORS = 512  # anchors of a tile
PAGE = 1_024  # zone maps that are looked at together
TASK_ROWS = 64 * 1_024  # rows that a task writes
BITS = 2  # bits of every dimension in the Hilbert key
HELD = 64  # tiles whose best results a task holds at once
EXACT = 2**53  # whole numbers up to here are exact in doubles
LOWEST = -(2**62)


# --- the curve ----------------------------------------------------------------------------

def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place of each row of ``cells`` (whole numbers below 2^bits) on the Hilbert curve, as bytes that sort like it.

    The axes are transformed in place of a table: from the highest bit down, low bits are swapped or
    inverted as the curve turns, then a Gray code gives the bits of the key, the first axis first.
    """
    x = cells.astype(np.int64).T.copy()
    if not len(x):
        return np.zeros((cells.shape[0], 0), np.uint8)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for axis in x:
            inverted = (axis >> level & 1).astype(bool)
            swapped = np.where(inverted, 0, (x[0] ^ axis) & low)
            x[0] ^= np.where(inverted, low, swapped)
            axis ^= swapped if axis is not x[0] else 0
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] >> level & 1, (1 << level) - 1, 0)
    x ^= turn
    planes = [(axis >> level & 1).astype(np.uint8) for level in range(bits - 1, -1, -1) for axis in x]
    return np.packbits(np.stack(planes, axis=1), axis=1)


# --- vectors ------------------------------------------------------------------------------

def _whole(column) -> list[np.ndarray | None]:
    """floor(256 x) of each vector; None where the vector, or a component, is null or not finite."""
    out = []
    for v in column:
        x = None if not v.is_valid else np.array([np.nan if e is None else e for e in v.as_py()], np.float64)
        out.append(None if x is None or not np.isfinite(x).all() else np.floor(256 * x))
    return out


def _quantised(batches):
    """(id, label, v) of the rows that take part; a component beyond 32 bits is an error."""
    for batch in batches:
        column = batch.column("v")
        flat = column.flatten()
        sizes = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0)
        if len(column) and not column.null_count and not flat.null_count and len(set(sizes.tolist())) == 1:
            x = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)  # the usual case
            good = np.isfinite(x).all(axis=1)
            packed = np.floor(256 * x[good])
        else:
            rows = _whole(column)
            good = np.array([r is not None for r in rows], bool)
            packed = [r for r in rows if r is not None]
        if any(len(r) and np.abs(r).max() >= 2**31 for r in packed):
            raise ValueError("a vector has a component beyond 2^23")
        data = [r.astype(np.int32).tobytes() for r in packed]
        yield pa.RecordBatch.from_arrays([*[batch.column(c).filter(pa.array(good)) for c in ("id", "label")], pa.array(data, pa.binary())], ["id", "label", "v"])


def _matrix(column: list[bytes], width: int) -> np.ndarray:
    if all(len(v) == 4 * width for v in column):
        return np.frombuffer(b"".join(column), np.int32).reshape(len(column), width)
    return np.stack([np.pad(r, (0, width - len(r))) for r in (np.frombuffer(v, np.int32) for v in column)])


class _Moments:
    """Size, dimensions and, per dimension, mean and deviation of all vectors; the largest component."""

    def __init__(self, known: DataFrame):
        def sums(batches):
            width, n, parts, most = 0, 0, np.zeros((2, 0)), 0
            for batch in batches:
                column = batch.column("v").to_pylist()
                wider = max(map(len, column), default=0) // 4
                if wider > width:
                    width, parts = wider, np.pad(parts, ((0, 0), (0, wider - width)))
                x = _matrix(column, width).astype(np.float64)
                parts += x.sum(axis=0), np.square(x).sum(axis=0)
                most, n = max(most, int(np.abs(x).max(initial=0))), n + len(x)
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([most]), pa.array([parts.tobytes()], pa.binary())], ["n", "most", "parts"])

        # A row per task, of the size of two vectors.
        rows = known.select("v").mapInArrow(sums, "n bigint, most bigint, parts binary").collect()
        tables = [np.frombuffer(r["parts"]).reshape(2, -1) for r in rows]
        self.width = max((t.shape[1] for t in tables), default=0)
        self.rows, self.most = sum(r["n"] for r in rows), max((r["most"] for r in rows), default=0)
        total = sum((np.pad(t, ((0, 0), (0, self.width - t.shape[1]))) for t in tables), np.zeros((2, self.width)))
        mean, square = total / max(1, self.rows)
        self.mean, self.spread = mean, np.sqrt(np.maximum(square - mean * mean, 1e-9))
        if self.width * self.most**2 >= 2**62:
            raise ValueError("scores of these vectors do not fit 64 bits")
        #: Doubles add up such products exactly.
        self.kind = np.float64 if self.width * self.most**2 < EXACT else np.int64

    def vectors(self, column) -> np.ndarray:
        """Rows of equal length; missing components count as zero."""
        return _matrix(column, self.width)

    def keys(self, x: np.ndarray) -> np.ndarray:
        """Cells of half a deviation around the mean; the axes that spread most turn the curve first."""
        cells = np.clip(np.floor((x - self.mean) / self.spread * 2 ** (BITS - 2)) + 2 ** (BITS - 1), 0, 2**BITS - 1)
        return hilbert_keys(cells[:, np.argsort(-self.spread, kind="stable")], BITS)


# --- blocks -------------------------------------------------------------------------------

BLOCK = "block bigint, ids binary, labels binary, rows binary, v binary, least bigint, low binary, high binary"


def _written(known: DataFrame, moments: _Moments) -> DataFrame:
    """The rows in the order of the curve, as a Parquet table of blocks with their zone maps."""
    def keyed(batches):
        for batch in batches:
            if batch.num_rows:
                keys = moments.keys(moments.vectors(batch.column("v").to_pylist()))
                yield batch.append_column("key", pa.array([k.tobytes() for k in keys], pa.binary()))

    def cut(batches):
        held, number = [], TaskContext.get().partitionId() << 32
        for batch in chain(batches, [None]):
            if batch is not None:
                held.append(batch)
            while held and (sum(b.num_rows for b in held) >= ROWS or batch is None):
                table = pa.Table.from_batches(held)
                block, rest = table.slice(0, ROWS).sort_by([("id", "ascending"), ("row", "ascending")]), table.slice(ROWS)
                held = rest.to_batches() if rest.num_rows else []
                x = moments.vectors(block["v"].to_pylist())
                binary = [block[c].to_numpy().tobytes() for c in ("id", "label", "row")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number]), *[pa.array([b], pa.binary()) for b in (*binary, x.tobytes())], pa.array([block["id"][0].as_py()], pa.int64()),
                     *[pa.array([b.tobytes()], pa.binary()) for b in (x.min(axis=0), x.max(axis=0))]], [c.split()[0] for c in BLOCK.split(", ")])
                number += 1

    spark = known.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-moments.rows // TASK_ROWS))
    ordered = (known.mapInArrow(keyed, "id bigint, label bigint, v binary, row bigint, key binary")
               .repartitionByRange(parts, "key", "id", "row").sortWithinPartitions("key", "id", "row").drop("key"))
    path = scratch_path(spark, "vector_blocks")
    ordered.mapInArrow(cut, BLOCK).write.parquet(path)
    return spark.read.parquet(path)


class _Rows:
    """Rows of a block, or the anchors of a tile."""

    def __init__(self, record: dict, moments: _Moments):
        self.ids, self.labels, self.rows = (np.frombuffer(record[c], np.int64) for c in ("ids", "labels", "rows"))
        self.x = np.frombuffer(record["v"], np.int32).reshape(len(self.ids), moments.width).astype(moments.kind)


TILE = "tile bigint, ids binary, labels binary, rows binary, v binary, first bigint, last bigint"
#: A tile's windows: the lowest and highest score of each anchor and window, and the threshold, a score and an id.
WINDOWS = "floor binary, ceiling binary, score binary, beyond binary"


def _tiles(blocks: DataFrame, moments: _Moments, step: int) -> DataFrame:
    """The anchors of runs of neighbouring blocks, and the numbers of the first and the last block of the run."""
    def rows(batches):
        held, number = [], TaskContext.get().partitionId() << 32
        for batch in chain(batches, [None]):
            for record in batch.to_pylist() if batch is not None else [None]:
                # A run ends with the blocks that one task wrote.
                if held and (record is None or len(held) == RUN or record["block"] != held[-1]["block"] + 1):
                    run = [_Rows(r, moments) for r in held]
                    picked = [np.flatnonzero((r.ids % step == 0) & (r.ids != NO_ID)) for r in run]
                    columns = [np.concatenate([getattr(r, c)[p] for r, p in zip(run, picked)]) for c in ("ids", "labels", "rows", "x")]
                    for a in range(0, len(columns[0]), ANCHORS):
                        part = [c[a:a + ANCHORS] for c in columns]
                        part[3] = part[3].astype(np.int32)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([number]), *[pa.array([c.tobytes()], pa.binary()) for c in part], pa.array([held[0]["block"]]), pa.array([held[-1]["block"]])],
                            [c.split()[0] for c in TILE.split(", ")])
                        number += 1
                    held = []
                if record is not None:
                    held.append(record)
    return blocks.select("block", "ids", "labels", "rows", "v").mapInArrow(rows, TILE)


# --- search -------------------------------------------------------------------------------

def _limits(record: dict, n: int) -> tuple[np.ndarray, ...]:
    return tuple(np.frombuffer(record[c], np.int64).reshape(n, -1) for c in ("floor", "ceiling", "score", "beyond"))


def bounds(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of ``x`` and each zone map a lower and an upper bound of all inner products in the block."""
    up, down = np.maximum(x, 0), np.minimum(x, 0)
    return up @ low.T + down @ high.T, up @ high.T + down @ low.T


def _chosen(tiles: DataFrame, blocks: DataFrame, moments: _Moments) -> DataFrame:
    """(tile, block) wherever a block beyond the tile's run can hold a result of one of its anchors."""
    def paged(table: pa.Table) -> pa.Table:
        return pa.table({"page": table["page"][:1], "block": pa.array([table["block"].to_numpy().tobytes()], pa.binary()),
                         "least": pa.array([table["least"].to_numpy().tobytes()], pa.binary()),
                         **{c: pa.array([b"".join(table[c].to_pylist())], pa.binary()) for c in ("low", "high")}})

    def choose(batches):
        for batch in batches:
            for record in batch.to_pylist():
                tile = _Rows(record, moments)
                floor, ceiling, score, beyond = _limits(record, len(tile.ids))
                block, least = (np.frombuffer(record[c], np.int64) for c in ("block", "least"))
                low, high = (np.frombuffer(record[c], np.int32).reshape(len(block), moments.width).astype(moments.kind) for c in ("low", "high"))
                below, above = bounds(tile.x, low, high)
                wanted = np.zeros(len(block), bool)
                for w in range(floor.shape[1]):
                    f, c, s, i = (z[:, w, None] for z in (floor, ceiling, score, beyond))
                    wanted |= ((above >= f) & (below <= c) & ((above > s) | (above == s) & (least <= i))).any(axis=0)
                wanted &= (block < record["first"]) | (block > record["last"])
                found = block[wanted]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), record["tile"])), pa.array(found)], ["tile", "block"])

    maps = blocks.select("block", "least", "low", "high")
    pages = 1 + maps.count() // PAGE
    paging = maps.withColumn("page", F.pmod(F.xxhash64("block"), F.lit(pages)).cast("int")).groupBy("page").applyInArrow(
        paged, "page int, block binary, least binary, low binary, high binary")
    every = tiles.withColumn("page", F.explode(F.sequence(F.lit(0), F.lit(pages - 1))))
    return every.join(paging, "page").mapInArrow(choose, "tile bigint, block bigint")


class _Best:
    """The best ids and scores of every anchor and window of a tile."""

    def __init__(self, anchors: int, windows: int, k: int):
        self.k = k
        self.score, self.id = np.full((anchors, windows, k), LOWEST), np.full((anchors, windows, k), NO_ID)

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        score, ids = np.concatenate([self.score, score], axis=2), np.concatenate([self.id, ids], axis=2)
        order = np.lexsort((ids, -score), axis=2)[:, :, :self.k]
        self.score, self.id = np.take_along_axis(score, order, 2), np.take_along_axis(ids, order, 2)


RESULT = "tile bigint, anchor int, part int, score bigint, id bigint"


def _in_windows(tile: _Rows, block: _Rows, floor: np.ndarray, ceiling: np.ndarray, k: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """The first k scores and ids of a block in every window of every anchor; what there is not has the lowest score."""
    score = (tile.x @ block.x.T).astype(np.int64)
    fits = (tile.labels[:, None] == block.labels[None, :]) == same
    if same:
        fits &= tile.rows[:, None] != block.rows[None, :]
    score = np.where(fits, score, LOWEST)
    order = np.argsort(-score, axis=1, kind="stable")  # rows of a block ascend by id
    score = np.take_along_axis(score, order, 1)
    n, windows = floor.shape
    out, ids = np.full((n, windows, k), LOWEST), np.full((n, windows, k), NO_ID)
    for w in range(windows):
        place = (score > ceiling[:, w, None]).sum(axis=1)[:, None] + np.arange(k)
        inside = place < score.shape[1]
        place = np.minimum(place, score.shape[1] - 1)
        found = np.take_along_axis(score, place, 1)
        inside &= (found >= floor[:, w, None]) & (found > LOWEST)
        out[:, w] = np.where(inside, found, LOWEST)
        ids[:, w] = np.where(inside, block.ids[np.take_along_axis(order, place, 1)], NO_ID)
    return out, ids


def _read(pairs: DataFrame, tiles: DataFrame, blocks: DataFrame, moments: _Moments, k: int, same: bool) -> DataFrame:
    """The best of each tile's chosen blocks; the blocks that no tile chose are not read."""
    def rows(batches):
        held: dict[int, _Best] = {}
        for batch in batches:
            for record in batch.to_pylist():
                tile = _Rows(record, moments)
                floor, ceiling, score, _ = _limits(record, len(tile.ids))
                floor = np.maximum(floor, score)  # as many as are wanted were found up to there
                block = _Rows({c: record[f"block_{c}"] for c in ("ids", "labels", "rows", "v")}, moments)
                best = held.setdefault(record["tile"], _Best(*floor.shape, k))
                best.add(*_in_windows(tile, block, floor, ceiling, k, same))
                if len(held) > HELD:
                    yield from _out(held)
        yield from _out(held)

    def _out(held: dict[int, _Best]) -> Iterator[pa.RecordBatch]:
        for tile in list(held):
            best = held.pop(tile)
            at = np.nonzero(best.score > LOWEST)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at[0]), tile)), pa.array(at[0].astype(np.int32)), pa.array(at[1].astype(np.int32)), pa.array(best.score[at]), pa.array(best.id[at])],
                [c.split()[0] for c in RESULT.split(", ")])

    data = blocks.select("block", *[F.col(c).alias(f"block_{c}") for c in ("ids", "labels", "rows", "v")])
    return pairs.join(tiles, "tile").join(data, "block").drop("block").mapInArrow(rows, RESULT)


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("tile", "anchor", "part").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _with_thresholds(tiles: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """The tiles, their thresholds set to the k-th of the results found so far."""
    def put(key, table: pa.Table, results: pa.Table) -> pa.Table:
        if not table.num_rows:
            return table
        record = table.to_pylist()[0]
        floor = np.frombuffer(record["floor"], np.int64).reshape(len(record["ids"]) // 8, -1)
        score, beyond = np.full(floor.shape, LOWEST), np.full(floor.shape, NO_ID)
        at = results["anchor"].to_numpy(), results["part"].to_numpy()
        score[at], beyond[at] = results["score"].to_numpy(), results["id"].to_numpy()
        for name, values in (("score", score), ("beyond", beyond)):
            table = table.set_column(table.schema.get_field_index(name), name, pa.array([values.tobytes()], pa.binary()))
        return table

    last = _first(found, k).where(F.col("rank") == k).drop("rank")
    return tiles.groupBy("tile").cogroup(last.groupBy("tile")).applyInArrow(put, f"{TILE}, {WINDOWS}")


def _search(tiles: DataFrame, blocks: DataFrame, moments: _Moments, k: int, same: bool) -> DataFrame:
    """(tile, anchor, part, score, id, rank): the first k rows in every window of every anchor."""
    near = tiles.select("tile", F.explode(F.sequence("first", "last")).alias("block"))
    begun = checkpointed(_read(near, tiles, blocks, moments, k, same))
    judged = checkpointed(_with_thresholds(tiles, begun, k))
    pairs = checkpointed(_chosen(judged, blocks, moments))
    return checkpointed(_first(begun.union(_read(pairs, judged, blocks, moments, k, same)), k))


def _positive_windows(batches):
    """One window without limits for each anchor."""
    for batch in batches:
        for record in batch.to_pylist():
            n = len(record["ids"]) // 8
            limits = [np.full((n, 1), x) for x in (LOWEST, -LOWEST, LOWEST, NO_ID)]
            row = pa.RecordBatch.from_pylist([record], schema=batch.schema)
            for name, values in zip(("floor", "ceiling", "score", "beyond"), limits):
                row = row.append_column(name, pa.array([values.tobytes()], pa.binary()))
            yield row


def _negative_windows(positives: int, percent: tuple[int, int]):
    """A window for each positive of an anchor; none is open where there is no positive."""
    def put(key, table: pa.Table, results: pa.Table) -> pa.Table:
        if not table.num_rows:
            return table
        n = len(table["ids"][0].as_py()) // 8
        floor, ceiling = np.full((n, positives), -LOWEST), np.full((n, positives), LOWEST)
        at, score = (results["anchor"].to_numpy(), results["rank"].to_numpy() - 1), results["score"].to_numpy()
        floor[at] = -((-percent[0] * score) // 100)
        ceiling[at] = percent[1] * score // 100
        made = {"floor": floor, "ceiling": ceiling, "score": np.full((n, positives), LOWEST), "beyond": np.full((n, positives), NO_ID)}
        for name, values in made.items():
            table = table.set_column(table.schema.get_field_index(name), name, pa.array([values.tobytes()], pa.binary()))
        return table
    return put


def mine_hard_negatives(vectors: DataFrame, positives: int = 5, negatives: int = 10, percent: tuple[int, int] = (30, 90),
                        anchor_step: int = 100, shift_step: int = 7) -> DataFrame:
    """For each anchor and each of its positives the first rows of other labels whose scores lie in the positive's window.

    Input columns: vec_id, embedding, label. A component x becomes floor(256 x); a score is the inner
    product with the anchor. Anchors are rows whose vec_id is divisible by ``anchor_step``; positives the
    first rows of the anchor's label, negatives the first rows of another label with percent[0] *
    positive_score <= 100 * negative_score <= percent[1] * positive_score. Higher scores come first, ties by
    smaller vec_id. Where vec_id is divisible by ``shift_step``, label first becomes (label + 1) % 10.

    Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score. Rows with a null
    label, a null vector, or a null or non-finite component take no part. Every other row stands for
    itself: repeated rows are positives and negatives of their own, and an anchor's copy is another row. A
    null vec_id comes last and is no anchor. Shorter vectors count as filled up with zeros. Components
    beyond 2^23, and vectors whose scores may not fit 64 bits, are an error. Other columns are ignored.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    label = F.col("label").cast("bigint")
    known = checkpointed(
        vectors.where("label IS NOT NULL AND embedding IS NOT NULL")
        .select(F.coalesce(F.col("vec_id").cast("bigint"), F.lit(NO_ID)).alias("id"),
                F.when(F.col("vec_id").cast("bigint") % shift_step == 0, (label + 1) % 10).otherwise(label).alias("label"),
                F.col("embedding").cast("array<double>").alias("v"))
        .mapInArrow(_quantised, "id bigint, label bigint, v binary")).withColumn("row", F.monotonically_increasing_id())
    moments = _Moments(known)
    blocks = _written(known, moments)
    tiles = checkpointed(_tiles(blocks, moments, anchor_step))
    first = checkpointed(tiles.mapInArrow(_positive_windows, f"{TILE}, {WINDOWS}"))
    liked = _search(first, blocks, moments, positives, True)
    second = checkpointed(first.groupBy("tile").cogroup(liked.groupBy("tile"))
                          .applyInArrow(_negative_windows(positives, percent), f"{TILE}, {WINDOWS}"))
    hard = _search(second, blocks, moments, negatives, False)

    def named(batches):
        for batch in batches:
            for record in batch.to_pylist():
                ids = np.frombuffer(record["ids"], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), record["tile"])), pa.array(np.arange(len(ids), dtype=np.int32)), pa.array(ids)],
                                                 ["tile", "anchor", "anchor_id"])

    def shown(column: str):
        return F.when(F.col(column) != NO_ID, F.col(column))

    anchors = tiles.select("tile", "ids").mapInArrow(named, "tile bigint, anchor int, anchor_id bigint")
    own = liked.select("tile", "anchor", (F.col("rank") - 1).alias("part"), F.col("id").alias("positive"), F.col("score").alias("positive_score"))
    return (hard.withColumnsRenamed({"id": "negative", "score": "negative_score"}).join(own, ["tile", "anchor", "part"]).join(anchors, ["tile", "anchor"])
            .select("anchor_id", shown("positive").alias("positive_id"), F.col("rank").cast("int").alias("rank"), shown("negative").alias("negative_id"),
                    "positive_score", "negative_score"))


#: The same by SQL, over all pairs of an anchor and a row.
ORACLE = """
WITH good AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM good a JOIN good b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
liked AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) AS place FROM pairs WHERE same) WHERE place <= 5),
hard AS (
  SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)::INTEGER AS rank,
         other AS negative_id, positive_score, score AS negative_score
  FROM liked JOIN pairs USING (anchor_id)
  WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT * FROM hard WHERE rank <= 10
"""
