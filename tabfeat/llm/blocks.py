"""Shared pieces of the text operators: batches of documents, vectorised words and hashes, key exchange.

Several operators ask one question of every position of every text: who else has this key?
``deal`` puts documents into batches of bounded size, in order of doc_id; an id with very many rows has
several. A batch sends its distinct
64-bit keys as packed blocks, one per bucket of the key space; each bucket compares the blocks of all
batches and answers each of them. A key held by a third of all documents is one entry per batch.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NO_ID = 2**63 - 1  # stands for a null doc_id, which counts as larger than any other
BATCH_BYTES = 8 << 20
SLICE_BYTES = 1 << 20
MIN_BATCHES = 64
_R = np.uint64(0x9E3779B97F4A7C55)
_R_INVERSE = np.uint64(pow(0x9E3779B97F4A7C55, -1, 1 << 64))

SPACES = bytes([0x20, *range(0x09, 0x0E)])
SPACED = np.arange(256, dtype=np.uint8)
SPACED[list(SPACES)] = 0x20
LOWER_SPACED = SPACED.copy()
LOWER_SPACED[0x41:0x5B] += 0x20


# --- batches ------------------------------------------------------------------------------

_ARROW = "spark.sql.execution.arrow."


def bounded_batches(spark: SparkSession) -> None:
    """Let tasks get texts in Arrow batches of bounded size; a smaller setting of the session stays."""
    for name, most in (("maxRecordsPerBatch", 1_000), ("maxBytesPerBatch", 8 << 20)):
        now = spark.conf.get(_ARROW + name, None)
        if now is None or not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(_ARROW + name, str(most))


class Dealing:
    """Borders of the batches: an upper edge for each cell of ids, and the batches of each cell.

    ``borders`` holds ids in ascending order that cut the rows into parts of equal weight. An id that
    stands there more than once holds whole parts; it gets a cell of its own with as many batches.
    """

    def __init__(self, borders: np.ndarray):
        ids, times = np.unique(np.asarray(borders, np.int64), return_counts=True)
        hot = ids[times > 1]
        before = hot[hot > np.iinfo(np.int64).min] - 1
        self.edges = np.union1d(ids, before)
        parts = np.ones(len(self.edges) + 1, np.int64)
        parts[np.searchsorted(self.edges, ids)] = times
        self.first = np.concatenate([[0], np.cumsum(parts)])

    def batches(self, ids: np.ndarray, salts: np.ndarray) -> np.ndarray:
        cell = np.searchsorted(self.edges, ids)
        return (self.first[cell] + salts % np.diff(self.first)[cell]).astype(np.int32)

    def cells(self, batches: np.ndarray) -> np.ndarray:
        """Batches of one cell hold one id only, or are one batch."""
        return np.searchsorted(self.first, batches, side="right") - 1

    def __len__(self) -> int:
        return int(self.first[-1])


def _borders(weighed: DataFrame, wanted: int) -> np.ndarray:
    """Ids that cut rows of (id, weight) into ``wanted`` parts or more of about equal weight, found in two levels of its root."""
    parts = math.isqrt(max(1, wanted - 1)) + 1

    def cuts():
        return F.percentile_approx("id", [i / parts for i in range(1, parts)] or [0.5], max(2_000, 20 * parts))

    copies = F.explode(F.sequence(F.lit(1), "weight"))
    coarse = Dealing(np.array(weighed.select("id", copies).agg(cuts()).first()[0] or [], np.int64))

    @F.pandas_udf("int")
    def cell_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(coarse.edges, ids.to_numpy()).astype(np.int32))

    fine = (weighed.select(cell_of("id").alias("cell"), "id", "weight").select("cell", "id", copies)
            .groupBy("cell").agg(cuts().alias("cuts")).collect())
    times = np.diff(coarse.first)
    borders = [np.repeat(np.array(r["cuts"], np.int64), times[r["cell"]]) for r in fine]
    # A cell of one id is cut by hash alone, and its upper edge is one of its cuts.
    return np.sort(np.concatenate([coarse.edges, *borders]))


def deal(docs: DataFrame, batch_bytes: int = BATCH_BYTES, carry: tuple[str, ...] = ()) -> tuple[DataFrame, Dealing]:
    """(batch, id, text) dealt by batch, and the borders; batches ascend with doc_id.

    A row weighs 1, and 4 more for every mean size of a text, so batches are of about equal bytes. The
    rows of an id that holds many (or of none: a null) are dealt to several batches by a hash of the
    text. Columns in ``carry`` travel along as one struct. Three narrow passes find the size of the
    texts and the borders: one long a batch, from sketches of the root of their number. A null text is empty.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    more = [F.struct(*[F.col(quoted(c)) for c in carry]).alias("carry")] if carry else []
    known = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("id"), "text", *more)
    rows, total = known.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    wanted = max(MIN_BATCHES, total // batch_bytes)
    weight = 1 + F.coalesce(4 * rows * F.octet_length("text").cast("double") / max(1, total), F.lit(0.0)).cast("int")
    dealing = Dealing(_borders(known.select("id", weight.alias("weight")), wanted))

    @F.pandas_udf("int")
    def batch_of(ids: pd.Series, salts: pd.Series) -> pd.Series:
        return pd.Series(dealing.batches(ids.to_numpy(), salts.to_numpy()))

    partitions = max(len(dealing), int(spark.conf.get("spark.sql.shuffle.partitions")))
    text = F.coalesce("text", F.lit(""))
    dealt = known.select(batch_of("id", F.pmod(F.xxhash64(text), F.lit(1 << 62))).alias("batch"), "id", text.alias("text"),
                         *(["carry"] if carry else []))
    return dealt.repartition(partitions, "batch"), dealing


def quoted(name: str) -> str:
    """A column name that may hold dots or back-quotes, for ``F.col``."""
    return "`" + name.replace("`", "``") + "`"


PACKED = "bucket int, batch int, keys binary"
ANSWER = "batch int, bucket int, answer binary"


def ask(dealt: DataFrame, keys_of: Callable, dealing: Dealing, merge: Callable, width: int = 1,
        told: DataFrame | None = None) -> DataFrame:
    """Send each batch's sorted keys to their buckets; (batch, bucket, answer) come back.

    ``keys_of(table)``, or ``keys_of(table, answers)`` with the answers ``told`` before, returns the
    batch's keys as one uint64 array of ``width`` numbers each, sorted by the first, which deals them
    out. ``merge(keys, counts, cells)`` gets the blocks of a bucket in order of batch, with their numbers of
    keys and their cells (a larger one has larger ids only), and returns one array per block.
    """
    buckets = len(dealing)

    def packed(table: pa.Table, keys: np.ndarray) -> pa.Table:
        cuts = np.searchsorted(bucket_of(keys[::width], buckets), np.arange(buckets + 1))
        there = np.flatnonzero(np.diff(cuts)).tolist()
        batch = table["batch"][0].as_py() if there else 0
        return pa.table({"bucket": pa.array(there, pa.int32()), "batch": pa.array([batch] * len(there), pa.int32()),
                         "keys": pa.array([keys[cuts[b] * width:cuts[b + 1] * width].tobytes() for b in there], pa.binary())})

    def send(table: pa.Table) -> pa.Table:
        return packed(table, keys_of(table))

    def send_told(table: pa.Table, before: pa.Table) -> pa.Table:
        return packed(table, keys_of(table, before))

    def answer(table: pa.Table) -> pa.Table:
        table = table.sort_by("batch")
        sent = [np.frombuffer(k, np.uint64) for k in table["keys"].to_pylist()]
        found = merge(np.concatenate(sent), np.array([len(k) // width for k in sent]), dealing.cells(table["batch"].to_numpy()))
        return pa.table({"batch": table["batch"], "bucket": table["bucket"],
                         "answer": pa.array([x.tobytes() for x in found], pa.binary())})

    groups = dealt.groupBy("batch")
    requests = (groups.applyInArrow(send, PACKED) if told is None
                else groups.cogroup(told.groupBy("batch")).applyInArrow(send_told, PACKED))
    return requests.groupBy("bucket").applyInArrow(answer, ANSWER)


def answers(table: pa.Table, kind=np.uint64) -> np.ndarray:
    """All answers to a batch, in the order of its keys."""
    return np.frombuffer(b"".join(table.sort_by("bucket")["answer"].to_pylist()), kind)


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def split_like(values: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    return np.split(values, np.cumsum(counts)[:-1])


def picked(keys: np.ndarray, flags: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    return [k[f] for k, f in zip(split_like(keys, counts), split_like(flags, counts), strict=True)]


def shared_keys(keys: np.ndarray, counts: np.ndarray, cells: np.ndarray) -> list[np.ndarray]:
    """Of each block the keys that another batch has too."""
    _, inverse, sizes = np.unique(keys, return_inverse=True, return_counts=True)
    return picked(keys, sizes[inverse] > 1, counts)


def new_pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places of the distinct pairs, in ascending order of the pairs; of equal ones the first."""
    order = np.lexsort((b, a))
    new = np.ones(len(order), bool)
    new[1:] = (a[order[1:]] != a[order[:-1]]) | (b[order[1:]] != b[order[:-1]])
    return order[new]


def later_pairs(keys: np.ndarray, counts: np.ndarray, cells: np.ndarray) -> list[np.ndarray]:
    """Of each block the pairs of numbers that a batch of an earlier cell has too."""
    a, b = keys[::2], keys[1::2]
    order = np.lexsort((b, a))  # equal pairs stay in order of batch
    new = np.ones(len(order), bool)
    new[1:] = (a[order[1:]] != a[order[:-1]]) | (b[order[1:]] != b[order[:-1]])
    cell = np.repeat(cells, counts)[order]
    flags = np.empty(len(order), bool)
    flags[order] = cell[new][np.cumsum(new) - 1] < cell
    return [k[f].ravel() for k, f in zip(split_like(keys.reshape(-1, 2), counts), split_like(flags, counts), strict=True)]


def among(keys: np.ndarray, pool: np.ndarray) -> np.ndarray:
    """Whether each key is in the sorted pool."""
    if not len(pool):
        return np.zeros(len(keys), bool)
    return pool[np.minimum(np.searchsorted(pool, keys), len(pool) - 1)] == keys


def least_and_most(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sorted distinct keys, and the smallest and the largest value of each."""
    order = np.lexsort((values, keys))
    keys, values = keys[order], values[order]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    ends = np.append(at[1:], len(keys))[:len(at)] - 1
    return keys[at], values[at], values[ends]


# --- texts as arrays ----------------------------------------------------------------------

def flatten(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its rows; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(data: np.ndarray, offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole documents of about ``limit`` bytes: first and last row, their bytes and offsets."""
    start, rows = 0, len(offsets) - 1
    while start < rows:
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1)
        yield start, stop, data[offsets[start]:offsets[stop]], offsets[start:stop + 1] - offsets[start]
        start = stop


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words are runs of bytes that ``table`` does not turn into 0x20.

    Returns the mapped bytes with a space behind each document, the words' starts and ends in them,
    and the number of the first word of each document (one more entry than documents).
    """
    rows = len(offsets) - 1
    padded = np.full(len(data) + rows, 0x20, np.uint8)
    ends = offsets[1:] + np.arange(1, rows + 1)  # behind each document's space
    inside = np.ones(len(padded), bool)
    inside[ends - 1] = False
    padded[inside] = table[data]
    step = np.diff((padded != 0x20).view(np.int8), prepend=0)
    starts, stops = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    return padded, starts, stops, np.searchsorted(starts, np.concatenate([[0], ends]))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """r^0 … r^(n-1) and their inverses, modulo 2^64."""
    up, down = np.full(n, _R), np.full(n, _R_INVERSE)
    up[:1] = down[:1] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit number over all bits."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def prefix_sums(values: np.ndarray, up: np.ndarray, seed: int = 0) -> np.ndarray:
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1 + seed)) * up[:len(values)], out=sums[1:])
    return sums


def between(sums: np.ndarray, down: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Hashes of ranges of the values behind ``sums``; equal content gives equal hashes wherever it stands."""
    lengths = (stops - starts).astype(np.uint64)
    return mixed((sums[stops] - sums[starts]) * down[starts] + lengths * np.uint64(0xD6E8FEB86659FD93))


def range_hashes(values: np.ndarray, starts: np.ndarray, stops: np.ndarray, power=None, seed: int = 0) -> np.ndarray:
    up, down = power if power is not None else powers(len(values) + 1)
    return between(prefix_sums(values, up, seed), down, starts, stops)


def window_rows(first: np.ndarray, k: int) -> np.ndarray:
    """Whether k items from here on lie in one document, for items numbered by ``first``."""
    counts = np.diff(first)
    last = np.repeat(first[1:], counts)
    return np.arange(len(last)) + k <= last


def covered(marks: np.ndarray, length: int) -> np.ndarray:
    """Positions covered by a run of ``length`` from a marked start; runs stay inside the array."""
    change = np.zeros(len(marks) + 1, np.int32)
    at = np.flatnonzero(marks)
    np.add.at(change, at, 1)
    np.add.at(change, np.minimum(at + length, len(marks)), -1)
    return np.cumsum(change[:-1]) > 0


def ids_of(id_column: np.ndarray) -> pa.Array:
    """The bigint column of results; NO_ID is null again."""
    return pa.array(id_column, pa.int64(), mask=id_column == NO_ID)
