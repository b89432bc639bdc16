"""Benchmark passages in documents, found by winnowed fingerprints."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabfeat.llm import blocks as B
from tabfeat.session import checkpointed

WINDOW = 10
GRAM = 5
FILTER_BITS = 25  # the filter of benchmark fingerprints has 2^25 bits, whatever the benchmark's size
_CHUNKS = 64
_SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]
_TABLE = B.LOWER_SPACED.copy()
_TABLE[[c for c in _SEPARATORS if not 0x41 <= c <= 0x5A]] = 0x20
_TOP = np.uint64(0xFFFFFFFF << 32)


def _winnowed(word: np.ndarray, first: np.ndarray, power) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the grams that are the least, the leftmost of equal ones, in some window."""
    windows = np.flatnonzero(B.window_rows(first, WINDOW))
    if not len(windows):
        return windows, windows.astype(np.uint64)
    places = np.arange(len(word) - GRAM + 1)
    grams = B.range_hashes(word, places, places + GRAM, power, 1)
    least = (grams & _TOP) | places.astype(np.uint64)
    span = WINDOW - GRAM + 1
    least = np.lib.stride_tricks.sliding_window_view(least, span).min(axis=1)
    chosen = np.unique((least[windows] & ~_TOP).astype(np.int64))
    return chosen, grams[chosen]


def _short_windows(word: np.ndarray, first: np.ndarray, power, length: int) -> tuple[np.ndarray, np.ndarray]:
    places = np.flatnonzero(B.window_rows(first, length))
    return places, B.range_hashes(word, places, places + length, power, 2)


def _bits(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _word_hashes(part: np.ndarray, at: np.ndarray):
    padded, starts, stops, first = B.words(part, at, _TABLE)
    word = B.range_hashes(padded, starts, stops)
    return word, first, B.powers(len(word) + 1)


def _item_windows(batches):
    """(item_id, n, key) of each window of each item; an item with fewer words is one window."""
    for batch in batches:
        items = batch.column("item_id")
        for start, stop, part, at in B.slices(*B.flatten(batch.column("text"))):
            word, first, power = _word_hashes(part, at)
            counts = np.diff(first)
            short = np.flatnonzero((counts > 0) & (counts < WINDOW))
            long = np.flatnonzero(B.window_rows(first, WINDOW))
            places = np.concatenate([first[short], long])
            sizes = np.concatenate([counts[short], np.full(len(long), WINDOW)])
            row = np.searchsorted(first, places, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [items.take(pa.array(start + row)), pa.array(sizes.astype(np.int32)),
                 pa.array(B.range_hashes(word, places, places + sizes, power, 2).view(np.int64))],
                ["item_id", "n", "key"])


def _filter_chunks(batches):
    """The bits that this task's items set, in pieces."""
    bits = np.zeros(1 << FILTER_BITS, bool)
    for batch in batches:
        for _, _, part, at in B.slices(*B.flatten(batch.column("text"))):
            word, first, power = _word_hashes(part, at)
            bits[_bits(_winnowed(word, first, power)[1])] = True
            counts = np.diff(first)
            short = np.flatnonzero((counts > 0) & (counts < WINDOW))
            bits[_bits(B.range_hashes(word, first[short], first[short] + counts[short], power, 2))] = True
    pieces = np.packbits(bits).reshape(_CHUNKS, -1)
    there = np.flatnonzero(pieces.any(axis=1))
    yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array([pieces[c].tobytes() for c in there], pa.binary())],
                                     ["chunk", "bits"])


def _joined(table: pa.Table) -> pa.Table:
    joined = np.bitwise_or.reduce([np.frombuffer(b, np.uint8) for b in table["bits"].to_pylist()])
    return pa.table({"chunk": table["chunk"][:1], "bits": pa.array([joined.tobytes()], pa.binary())})


def find_benchmark_windows(docs: DataFrame, benchmark: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Which words of a document lie in a window of a benchmark item, and which items occur.

    Words are runs of letters, digits and all non-ASCII characters, A-Z lower-cased. A window is 10
    consecutive words of an item; an item of fewer, but not none, is one window. Both sides keep the
    least 5-gram hash of every 10 words, so any shared window shares a fingerprint; a filter of fixed
    size tells which fingerprints of a document can be an item's, and the windows around those are
    joined with the items' windows whole.

    One row per input row: doc_id, n_words, n_hit, n_items (distinct item_ids with an occurring
    window; a null item_id is not counted), items_sha256, contaminated. Null and empty texts have no
    words; an empty benchmark hits nothing. Columns in ``keep`` stay, others are ignored.
    """
    B.bounded_batches(docs.sparkSession)
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    windows = checkpointed(items.mapInArrow(_item_windows, "item_id string, n int, key bigint").distinct())
    chunks = (items.select("text").mapInArrow(_filter_chunks, "chunk int, bits binary")
              .groupBy("chunk").applyInArrow(_joined, "chunk int, bits binary").collect())
    packed = np.zeros((_CHUNKS, (1 << FILTER_BITS) // 8 // _CHUNKS), np.uint8)
    for chunk, bits in chunks:
        packed[chunk] = np.frombuffer(bits, np.uint8)
    known = spark.sparkContext.broadcast(packed.ravel())
    short = sorted(r[0] for r in windows.where(F.col("n") < WINDOW).select("n").distinct().collect())

    def scan(batches):
        bits = known.value

        def maybe(keys):
            at = _bits(keys)
            return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)

        for batch in batches:
            ids = batch.column("doc_id")
            for start, stop, part, at in B.slices(*B.flatten(batch.column("text"))):
                word, first, power = _word_hashes(part, at)
                places, keys = _winnowed(word, first, power)
                marks = np.zeros(len(word), bool)
                marks[places[maybe(keys)]] = True
                # A gram at word a lies in the windows that start at a - 5 … a.
                near = B.covered(marks[::-1], WINDOW - GRAM + 1)[::-1]
                long = np.flatnonzero(near & B.window_rows(first, WINDOW)) if len(word) else places
                found = [(long, np.full(len(long), WINDOW), B.range_hashes(word, long, long + WINDOW, power, 2))]
                for n in short:
                    places, keys = _short_windows(word, first, power, n)
                    hit = maybe(keys)
                    found.append((places[hit], np.full(hit.sum(), n), keys[hit]))
                place, size, key = (np.concatenate(x) for x in zip(*found))
                row = np.searchsorted(first, place, side="right") - 1
                by = np.argsort(row, kind="stable")
                place, size, key, row = place[by], size[by], key[by], row[by]
                inner = pa.StructArray.from_arrays(
                    [pa.array((place - first[row]).astype(np.int64)), pa.array(size.astype(np.int32)), pa.array(key.view(np.int64))],
                    ["at", "n", "key"])
                cuts = np.searchsorted(row, np.arange(stop - start + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(start, stop - start), *[batch.column(c).slice(start, stop - start) for c in keep],
                     pa.array(np.diff(first).astype(np.int64)), pa.ListArray.from_arrays(pa.array(cuts), inner)],
                    ["doc_id", *keep, "n_words", "found"])

    scanned = checkpointed(
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), *keep, "text")
        .mapInArrow(scan, "doc_id bigint, " + "".join(f"`{c}` {dict(docs.dtypes)[c]}, " for c in keep) + "n_words bigint, found array<struct<at: bigint, n: int, key: bigint>>")
        .withColumn("row", F.monotonically_increasing_id()))
    places = scanned.select("row", F.inline("found"))
    hits = places.join(windows.select("n", "key").distinct(), ["n", "key"])
    step = F.aggregate(
        F.array_sort(F.collect_set(F.struct("at", "n"))),
        F.struct(F.lit(0).cast("bigint").alias("end"), F.lit(0).cast("bigint").alias("words")),
        lambda done, next_: F.struct(
            F.greatest(done["end"], next_["at"] + next_["n"]).alias("end"),
            (done["words"] + F.greatest(F.lit(0), next_["at"] + next_["n"] - F.greatest(done["end"], next_["at"]))).alias("words")),
        lambda done: done["words"])
    words = hits.groupBy("row").agg(step.alias("n_hit"))
    named = (hits.select("row", "n", "key").distinct().join(windows.where("item_id IS NOT NULL"), ["n", "key"])
             .groupBy("row").agg(F.sort_array(F.collect_set("item_id")).alias("items")))
    items_of = F.coalesce("items", F.array().cast("array<string>"))
    return (scanned.drop("found").join(words, "row", "left").join(named, "row", "left")
            .select("doc_id", *keep, "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
                    F.size(items_of).cast("bigint").alias("n_items"),
                    F.sha2(F.concat_ws(",", items_of), 256).alias("items_sha256"),
                    F.col("n_hit").isNotNull().alias("contaminated")))
