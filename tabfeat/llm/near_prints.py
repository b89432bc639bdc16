"""Near-duplicate documents by SimHash: fingerprints of shingles, compared exactly tile by tile."""

from __future__ import annotations

import math
from itertools import combinations, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabfeat.llm import blocks as B
from tabfeat.llm.components import components
from tabfeat.session import checkpointed

BITS = 64
SEED = 42
TILE = 4096  # fingerprints in a tile
MOST_PARTS = 16
_ROWS = 64  # rows of a tile that are compared with the other tile at once
_LANES = np.uint64((1 << 32) | 1)


# --- fingerprints -------------------------------------------------------------------------

def _shingle_hashes(part: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every shingle, document behind document, and the first one of each document."""
    padded, starts, stops, first = B.words(part, at, B.LOWER_SPACED)
    # Every word is followed by one space, whatever stood between the words.
    kept = padded != 0x20
    kept[stops] = True
    text = padded[kept].tobytes()
    begins = np.concatenate([[0], np.cumsum(stops - starts + 1)])
    counts = np.diff(first)
    short = np.flatnonzero((counts > 0) & (counts < size))
    places = np.concatenate([first[short], np.flatnonzero(B.window_rows(first, size))])
    ends = begins[places + np.concatenate([counts[short], np.full(len(places) - len(short), size)])] - 1
    order = np.argsort(places, kind="stable")
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(text[a:b], SEED) for a, b in zip(begins[places[order]].tolist(), ends[order].tolist())),
                         np.uint64, len(places))
    shingles = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    return hashes, np.concatenate([[0], np.cumsum(shingles)])


def _majority(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Of each document the bits that are set in over half of its hashes."""
    counts = np.diff(first)
    some = np.flatnonzero(counts)
    prints = np.zeros(len(counts), np.uint64)
    for j in range(32):  # the votes for bits j and j + 32 are counted side by side
        sums = np.add.reduceat((hashes >> np.uint64(j)) & _LANES, first[some]) if len(some) else np.zeros(0, np.uint64)
        for bit, votes in ((j, sums & np.uint64(0xFFFFFFFF)), (j + 32, sums >> np.uint64(32))):
            prints[some] |= (2 * votes.astype(np.int64) > counts[some]).astype(np.uint64) << np.uint64(bit)
    return prints


def shingle_fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """(doc_id, fingerprint): SimHash over the XXH64 (seed 42) of every ``size``-word shingle, repeats included.

    Words are runs without ASCII white space, A-Z lower-cased, joined by one space; fewer words are one
    shingle. A null text and one without words have fingerprint 0. Other columns are ignored.
    """
    def made(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            for start, stop, part, at in B.slices(*B.flatten(batch.column("text"))):
                prints = _majority(*_shingle_hashes(part, at, size))
                yield pa.RecordBatch.from_arrays([ids.slice(start, stop - start), pa.array(prints.view(np.int64))], ["doc_id", "fingerprint"])

    B.bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(made, "doc_id bigint, fingerprint bigint")


# --- tiles --------------------------------------------------------------------------------

def _widths(parts: int) -> list[int]:
    edges = [BITS * i // parts for i in range(parts + 1)]
    return [b - a for a, b in zip(edges, edges[1:])]


def _base(parts: int, radius: int) -> int:
    """Digits of counts leave room for a step of ``radius`` to both sides, so that no two sums are equal."""
    return max(_widths(parts)) + 1 + 2 * radius


def _counts(fingerprint: Column, parts: int, radius: int) -> Column:
    """The population counts of the parts of a fingerprint, as digits of one number."""
    number, low = F.lit(0).cast("bigint"), 0
    for i, width in enumerate(_widths(parts)):
        part = F.shiftrightunsigned(fingerprint, low).bitwiseAND(F.lit((1 << width) - 1 if width < 63 else -1).cast("bigint"))
        number = number + (F.bit_count(part) + radius).cast("bigint") * F.lit(_base(parts, radius) ** i).cast("bigint")
        low += width
    return number


def _steps(parts: int, radius: int) -> list[int]:
    """How the counts of two fingerprints within the radius may differ, from the smaller number to the larger."""
    base, found = _base(parts, radius), {0}
    for changed in range(1, min(parts, radius) + 1):
        for places in combinations(range(parts), changed):
            for by in product([d for d in range(-radius, radius + 1) if d], repeat=changed):
                if sum(map(abs, by)) <= radius:
                    found.add(sum(d * base ** i for i, d in zip(places, by)))
    return sorted(s for s in found if s >= 0)


def _parts_wanted(prints: DataFrame, tile: int, radius: int) -> tuple[int, DataFrame]:
    """The smallest number of parts with which a fingerprint has, on average, at most a tile of others with its counts; and the counts.

    What has the same counts must be compared, so this keeps the comparisons in proportion to the
    fingerprints as long as the counts of parts tell them apart.
    """
    parts, most = 1, max(p for p in range(1, MOST_PARTS + 1) if _base(p, radius) ** p < 1 << 62)
    while True:
        sizes = checkpointed(prints.groupBy(_counts(F.col("fingerprint"), parts, radius).alias("counts")).agg(F.count("*").alias("n")))
        total, together = sizes.agg(F.sum("n"), F.sum(F.col("n").cast("double") * F.col("n"))).first()
        if parts >= most or (together or 0) <= tile * (total or 0):
            return parts, sizes
        # One more part takes off a factor of ten at first, and less the more there are.
        parts = min(most, parts + max(1, round(math.log10(together / (tile * total)))))


def _packed_tiles(prints: DataFrame, sizes: DataFrame, parts: int, radius: int, tile: int) -> DataFrame:
    """(counts, no, prints): the fingerprints with equal counts, in tiles of about ``tile``."""
    def packed(table: pa.Table) -> pa.Table:
        counts, no, own = (table[c].to_numpy() for c in ("counts", "no", "fingerprint"))
        order = np.lexsort((no, counts))
        counts, no, own = counts[order], no[order], own[order]
        at = np.flatnonzero(np.concatenate([[True], (counts[1:] != counts[:-1]) | (no[1:] != no[:-1])]))
        return pa.table({"counts": pa.array(counts[at]), "no": pa.array(no[at], pa.int64()),
                         "prints": pa.array([x.tobytes() for x in np.split(own, at[1:])], pa.binary())})

    total = sizes.agg(F.sum("n")).first()[0] or 0
    dealt = prints.withColumn("counts", _counts(F.col("fingerprint"), parts, radius)).join(
        sizes.select("counts", F.ceil(F.col("n") / tile).alias("tiles")), "counts")
    numbered = dealt.select("counts", F.pmod(F.xxhash64("fingerprint"), F.col("tiles")).alias("no"), "fingerprint")
    # Small tiles are packed together, about four full ones to a group.
    group = F.pmod(F.xxhash64("counts", "no"), F.lit(1 + total // (4 * tile)))
    return numbered.withColumn("pack", group).groupBy("pack").applyInArrow(packed, "counts bigint, no bigint, prints binary")


def compare_tiles(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links, as places in both tiles one behind the other, that connect all prints that differ in at most ``radius`` bits.

    Of the links within a group that is connected already none is kept, so thousands of near prints give
    a spanning forest.
    """
    label, offset = np.arange(len(left) + len(right)), len(left)
    found = []
    for start in range(0, len(left), _ROWS):
        x, y = np.nonzero(np.bitwise_count(left[start:start + _ROWS, None] ^ right[None, :]) <= radius)
        x, y = x + start, y + offset
        while True:
            apart = np.flatnonzero(label[x] != label[y])
            if not len(apart):
                break
            # Every group that has a smaller neighbour hangs itself on the smallest, by one link.
            x, y = x[apart], y[apart]
            low, high = np.minimum(label[x], label[y]), np.maximum(label[x], label[y])
            order = np.lexsort((low, high))
            first = order[np.flatnonzero(np.diff(high[order], prepend=-1))]
            found.append((x[first], y[first]))
            label[high[first]] = low[first]
            while (label[label] != label).any():
                label = label[label]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def print_links(prints: DataFrame, radius: int = 2, tile: int = TILE) -> DataFrame:
    """(a, b): links that connect all distinct ``fingerprint`` values that differ in at most ``radius`` bits.

    Fingerprints with equal population counts of their parts form tiles. Two prints within the radius
    have counts that differ by no more in sum, so all other pairs of tiles are skipped; the rest are
    compared whole by exclusive-or and bit counts. A pair of tiles returns a spanning forest of its links.
    """
    parts, sizes = _parts_wanted(prints, tile, radius)
    tiles = checkpointed(_packed_tiles(prints, sizes, parts, radius, tile))
    known = sizes.select("counts", F.ceil(F.col("n") / tile).alias("tiles"))
    steps = F.explode(F.array(*[F.lit(s).cast("bigint") for s in _steps(parts, radius)]))
    near = (known.select(F.col("counts").alias("from"), F.col("tiles").alias("rows"), steps.alias("step"))
            .withColumn("to", F.col("from") + F.col("step"))
            .join(known.select(F.col("counts").alias("to"), F.col("tiles").alias("columns")), "to"))
    met = (near.withColumn("i", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("rows") - 1)))
           .withColumn("j", F.explode(F.sequence(F.when(F.col("step") == 0, F.col("i")).otherwise(F.lit(0).cast("bigint")), F.col("columns") - 1))))

    def links(batches):
        for batch in batches:
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = (np.frombuffer(v.as_py(), np.uint64) for v in (x, y))
                both = np.concatenate([x, y]).view(np.int64)
                a, b = compare_tiles(x, y, radius)
                a, b = both[a], both[b]
                kept = a != b  # a tile meets itself
                yield pa.RecordBatch.from_arrays([pa.array(a[kept]), pa.array(b[kept])], ["a", "b"])

    left = tiles.select(F.col("counts").alias("from"), F.col("no").alias("i"), F.col("prints").alias("x"))
    right = tiles.select(F.col("counts").alias("to"), F.col("no").alias("j"), F.col("prints").alias("y"))
    B.bounded_batches(prints.sparkSession)
    return met.join(left, ["from", "i"]).join(right, ["to", "j"]).select("x", "y").mapInArrow(links, "a bigint, b bigint")


def near_prints(docs: DataFrame, size: int = 3, radius: int = 2) -> DataFrame:
    """Components of documents whose fingerprints link at ``radius`` or fewer differing bits.

    One row per input row: doc_id, fingerprint (16 hexadecimal digits), component_id (the smallest doc_id
    reachable, itself included) and n_linked: how many rows the component has. Equal fingerprints are one
    entry, so a group of copies is one print in one tile. Documents without words have fingerprint zero
    and are linked like any other. Rows are linked by their texts alone: rows with one doc_id but
    different texts are documents of their own, and a row with a null doc_id belongs to its component but
    names none (component_id is null where all ids are). Other columns are ignored.
    """
    rows = checkpointed(shingle_fingerprints(docs, size))
    distinct = checkpointed(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")))
    labels = components(checkpointed(print_links(distinct.select("fingerprint"), radius)))
    known = checkpointed(distinct.join(labels.withColumnRenamed("id", "fingerprint"), "fingerprint", "left")
                         .select("fingerprint", "least", "n", F.coalesce("component", "fingerprint").alias("component")))
    whole = known.groupBy("component").agg(F.min("least").alias("component_id"), F.sum("n").alias("n_linked"))
    named = known.select("fingerprint", "component").join(whole, "component")
    return rows.join(named, "fingerprint").select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), BITS // 4, "0").alias("fingerprint"), "component_id", "n_linked")
