"""Ranked lexical search with geometric blocks: posting lists clustered by document, bounded by coordinatewise maxima.

The items' words are the terms. One scan turns each document into the counts of the terms it holds. From
a few documents with high contributions each item gets a first threshold; terms whose greatest
contributions together stay below it need no list. The index is written in segments of some thousand
documents, so that nothing is shuffled and a term in a third of all documents is spread over all tasks.
A segment holds its documents' vectors and, for every other term, a list of its documents, clustered by
their likeness into blocks, with the coordinatewise maximum of each. A block is skipped only if its
maximum, scored as if it were a document, can't enter the best ones.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabfeat.llm import blocks as B
from tabfeat.session import checkpointed, scratch_path, tiny_table

ITEMS = 4_096  # items searched at once, and
ITEM_WORDS = 2_000_000  # their words: the search of more items takes one scan for each batch of them
SEGMENT = 8_192  # documents of a segment, at most, and
SEGMENT_TERMS = 1 << 20  # their terms, unless one document has more
BLOCK = 32  # documents of a block, about
PIECE = 1_024  # postings that are clustered together
COORDINATES = 64  # to which terms are folded when documents are clustered
PAIRS = 1 << 21  # pairs of terms looked at together

TABLE = np.full(256, 0x20, np.uint8)
for _low, _high in ((0x30, 0x3A), (0x61, 0x7B), (0x80, 0x100)):
    TABLE[_low:_high] = np.arange(_low, _high)
TABLE[0x41:0x5B] = np.arange(0x61, 0x7B)


def _runs(sizes: np.ndarray) -> np.ndarray:
    """0 … size - 1 for each size."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)


def _gathered(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.repeat(starts, sizes) + _runs(sizes)


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of runs of the given sizes; an empty run gives 0."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


class _Items:
    """A batch of items: their terms, and which terms each has how often.

    Term t is the t-th of the sorted distinct words; the numbers of an item's terms ascend.
    """

    def __init__(self, texts: list[str | None]):
        padded, starts, stops, first = B.words(*B.flatten(pa.array(texts, pa.string())), TABLE)
        flat = padded.tobytes()
        words = [flat[a:b] for a, b in zip(starts.tolist(), stops.tolist())]
        self.terms = sorted(set(words))
        number = {w: t for t, w in enumerate(self.terms)}
        self.size = np.array([len(w) for w in self.terms], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(self.terms), np.uint8)
        for self.seed in range(99):  # distinct terms get distinct hashes
            hashes = B.range_hashes(self.bytes, self.start, self.start + self.size, seed=self.seed)
            if len(np.unique(hashes)) == len(hashes):
                break
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[self.hashes >> np.uint64(42)] = True
        pairs = [np.unique([number[w] for w in words[a:b]], return_counts=True) for a, b in zip(first, first[1:])]
        self.of = [(np.asarray(t, np.int64), np.asarray(n, np.int64)) for t, n in pairs]

    def found(self, padded: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words that are terms, and which; equal hashes are compared byte by byte."""
        hashes = B.range_hashes(padded, starts, stops, seed=self.seed)
        at = np.flatnonzero(self.maybe[hashes >> np.uint64(42)])
        if not len(at):
            return at, at
        place = np.minimum(np.searchsorted(self.hashes, hashes[at]), len(self.hashes) - 1)
        term = self.order[place]
        good = (self.hashes[place] == hashes[at]) & (self.size[term] == stops[at] - starts[at])
        at, term = at[good], term[good]
        size = self.size[term]
        other = padded[_gathered(starts[at], size)] != self.bytes[_gathered(self.start[term], size)]
        good = _sums(other, size) == 0
        return at[good], term[good]


def _counted(items, docs: DataFrame) -> DataFrame:
    """(doc, n, terms, counts) of every document: how many words, and the counts of the terms it has."""
    def rows(batches):
        known = items.value
        for batch in batches:
            ids = batch.column("doc")
            for start, stop, part, at in B.slices(*B.flatten(batch.column("text"))):
                padded, starts, stops, first = B.words(part, at, TABLE)
                where, term = known.found(padded, starts, stops)
                row = np.searchsorted(first, where, side="right") - 1
                width = max(1, len(known.terms))
                keys, counts = np.unique(row * width + term, return_counts=True)
                cuts = np.searchsorted(keys // width, np.arange(stop - start + 1))
                terms, counts = (keys % width).astype(np.int32), counts.astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(start, stop - start), pa.array(np.diff(first).astype(np.int64)),
                     *[pa.array([x[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()) for x in (terms, counts)]],
                    ["doc", "n", "terms", "counts"])
    return docs.mapInArrow(rows, "doc bigint, n bigint, terms binary, counts binary")


class _Weights:
    """The whole corpus as a score needs it."""

    def __init__(self, documents: int, words: int, holders: np.ndarray):
        self.documents, self.words, self.holders = documents, words, holders
        self.weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in holders], np.int64)

    def contributions(self, term: np.ndarray, count: np.ndarray, n: np.ndarray) -> np.ndarray:
        m = 100 - 75 + (75 * n * self.documents) // max(1, self.words)
        return self.weight[term] * ((1_000_000_000 * count) // (1000 * count + 8 * m))


def _segments(batches) -> Iterator[pa.Table]:
    """Rows of a task in runs of bounded size."""
    held, rows, terms = [], 0, 0
    for batch in batches:
        # The binary lengths tell the numbers of terms.
        ends = np.cumsum(pc.binary_length(batch.column("terms")).to_numpy(zero_copy_only=False).astype(np.int64) // 4)
        start, before = 0, 0
        while start < batch.num_rows:
            stop = min(start + SEGMENT - rows, int(np.searchsorted(ends, before + SEGMENT_TERMS - terms, side="right")), batch.num_rows)
            if stop <= start and not rows:
                stop = start + 1
            if stop > start:
                held.append(batch.slice(start, stop - start))
                rows, terms = rows + stop - start, terms + int(ends[stop - 1]) - before
                start, before = stop, int(ends[stop - 1])
            if start < batch.num_rows:
                yield pa.Table.from_batches(held)
                held, rows, terms = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


class _Vectors:
    """The documents of a segment as sparse vectors of contributions."""

    def __init__(self, batch: pa.Table, weights: _Weights):
        terms = batch.column("terms").to_pylist()
        self.size = np.array([len(t) // 4 for t in terms], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.term = np.frombuffer(b"".join(terms), np.int32).astype(np.int64)
        count = np.frombuffer(b"".join(batch.column("counts").to_pylist()), np.int32).astype(np.int64)
        self.doc, self.row = batch.column("doc").to_numpy(), batch.column("row").to_numpy()
        self.owner = np.repeat(np.arange(len(self.doc)), self.size)
        self.value = weights.contributions(self.term, count, batch.column("n").to_numpy()[self.owner])

    def scores(self, which: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """The scores of some documents for an item, given as the dense multiplicities of its terms."""
        size = self.size[which]
        at = _gathered(self.start[which], size)
        return _sums(weight[self.term[at]] * self.value[at], size)


class _Best:
    """The best documents per item, without repeats of a row, as far as a task has seen them."""

    def __init__(self, k: int):
        self.k, self.kept = k, {}

    def add(self, item: int, score: np.ndarray, doc: np.ndarray, row: np.ndarray) -> None:
        if item in self.kept:
            score, doc, row = (np.concatenate(x) for x in zip(self.kept[item], (score, doc, row)))
        _, first = np.unique(row, return_index=True)
        order = first[np.lexsort((row[first], doc[first], -score[first]))][:self.k]
        self.kept[item] = score[order], doc[order], row[order]

    def threshold(self, item: int, least: tuple[int, int]) -> tuple[int, int]:
        """Score and doc_id that another document must reach: the larger score, then the smaller id."""
        score, doc, _ = self.kept.get(item, ((), (), ()))
        return max(least, (int(score[-1]), -int(doc[-1]))) if len(score) == self.k else least

    def batch(self) -> pa.RecordBatch:
        parts = [(np.full(len(s), q), s, d, r) for q, (s, d, r) in self.kept.items()]
        columns = [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 4
        return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["item", "score", "doc", "row"])


BEST = "item bigint, score bigint, doc bigint, row bigint"


def _firsts(items, weights, counted: DataFrame, k: int) -> DataFrame:
    """Good documents per item, from the k greatest contributions to each term in a task; and as item -1 - t the greatest one to term t."""
    def rows(batches):
        known, corpus = items.value, weights.value
        holders: dict[int, list[int]] = {}
        for q, (terms, _) in enumerate(known.of):
            for t in terms.tolist():
                holders.setdefault(t, []).append(q)
        most, best = np.zeros(len(known.terms), np.int64), _Best(k)
        for segment in _segments(batches):
            v = _Vectors(segment, corpus)
            np.maximum.at(most, v.term, v.value)
            order = np.lexsort((v.doc[v.owner], -v.value, v.term))
            term = v.term[order]
            begins = np.flatnonzero(np.diff(term, prepend=-1))
            rank = np.arange(len(term)) - np.repeat(begins, np.diff(np.append(begins, len(term))))
            top = order[rank < k]
            wanted: dict[int, list[np.ndarray]] = {}
            for t, docs in zip(*_grouped(v.term[top], v.owner[top])):
                for q in holders.get(t, ()):
                    wanted.setdefault(q, []).append(docs)
            weight = np.zeros(len(known.terms), np.int64)
            for q, docs in wanted.items():
                which = np.unique(np.concatenate(docs))
                terms, times = known.of[q]
                weight[terms] = times
                score = v.scores(which, weight)
                weight[terms] = 0
                best.add(q, score, v.doc[which], v.row[which])
        there = np.flatnonzero(most)
        yield best.batch()
        yield pa.RecordBatch.from_arrays([pa.array(-1 - there), pa.array(most[there]), pa.array(there * 0), pa.array(there * 0)],
                                         ["item", "score", "doc", "row"])
    return counted.mapInArrow(rows, BEST)


def _grouped(keys: np.ndarray, values: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    """Distinct sorted keys and the values of each."""
    at = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[at].tolist(), np.split(values, at[1:]) if len(at) else []


def _best(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc", "row")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


class _Lists:
    """Which terms need a list, for which items, and which coordinates these items can ask for."""

    def __init__(self, items: _Items, most: np.ndarray, thresholds: dict[int, tuple[int, int]]):
        self.threshold = [thresholds.get(q, (0, -B.NO_ID)) for q in range(len(items.of))]
        self.askers: dict[int, list[int]] = {}
        self.needed: list[list[int]] = []
        for q, (terms, times) in enumerate(items.of):
            greatest = times * most[terms]
            order = np.argsort(greatest, kind="stable")
            # A document with no more than the terms before has a score below the threshold.
            need = np.cumsum(greatest[order]) >= max(1, self.threshold[q][0])
            self.needed.append(terms[order[need]].tolist())
            for t in self.needed[-1]:
                self.askers.setdefault(t, []).append(q)
        width = len(items.terms)
        self.listed = np.zeros(width, bool)
        self.listed[list(self.askers)] = True
        # A mark for each pair of a list's term and another one that its items ask for; a pair marked by chance does no harm.
        self.left, self.right = ((B.mixed(np.arange(1, width + 1, dtype=np.uint64) + np.uint64(seed << 40)) >> np.uint64(40)).astype(np.int32)
                                 for seed in (1, 2))
        self.marks = np.zeros(1 << 24, bool)
        for t, askers in self.askers.items():
            for q in askers:
                self.marks[self.left[t] ^ self.right[items.of[q][0]]] = True

    def asked(self, term: np.ndarray, other: np.ndarray) -> np.ndarray:
        return self.marks[self.left[term] ^ self.right[other]]


def _clusters(points: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """A cluster per document: that of the most similar among evenly spaced documents."""
    if len(doc) <= BLOCK:
        return np.zeros(len(doc), np.int64)
    pivots = np.argsort(doc, kind="stable")[::BLOCK]
    return (points @ points[pivots].T).argmax(axis=1)


def _blocks(v: _Vectors, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The postings at ``places``, ordered by term and by cluster, and where blocks begin among them."""
    # Clusters decide only how tight the bounds are, so folding many terms to one coordinate is harmless.
    points = np.zeros((len(v.doc), COORDINATES), np.float32)
    np.add.at(points, (v.owner, B.mixed(v.term.astype(np.uint64)) % np.uint64(COORDINATES)), v.value.astype(np.float32))
    points /= np.maximum(np.linalg.norm(points, axis=1, keepdims=True), 1e-9)
    places = places[np.argsort(v.term[places], kind="stable")]
    term, owner = v.term[places], v.owner[places]
    cuts = np.append(np.flatnonzero(np.diff(term, prepend=-1)), len(places))
    cluster = np.zeros(len(places), np.int64)
    for a, b in zip(cuts, cuts[1:]):
        for x in range(a, b, PIECE):
            y = min(x + PIECE, b)
            cluster[x:y] = x + _clusters(points[owner[x:y]], v.doc[owner[x:y]])
    order = np.lexsort((owner, v.doc[owner], cluster, term))
    places, cluster, term = places[order], cluster[order], term[order]
    begins = np.flatnonzero((np.diff(cluster, prepend=-1) != 0) | (np.diff(term, prepend=-1) != 0))
    rank = np.arange(len(places)) - np.repeat(begins, np.diff(np.append(begins, len(places))))
    return places, np.flatnonzero(rank % (2 * BLOCK) == 0)


def _peaks(v: _Vectors, lists: _Lists, places: np.ndarray, heads: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The coordinatewise maxima of the blocks: how many coordinates each has, which, and the values."""
    found, sizes = [], v.size[v.owner[places]]
    ends = np.append(heads, len(places))[1:]
    sums = np.concatenate([[0], np.cumsum(sizes)])
    # Whole blocks together, about PAIRS pairs at once.
    cuts = [0, *(np.flatnonzero(np.diff(sums[ends] // PAIRS)) + 1).tolist(), len(heads)]
    for a, b in zip(cuts, cuts[1:]):
        if a == b:
            continue
        first, last = heads[a], ends[b - 1]
        at, size = places[first:last], sizes[first:last]
        block = np.repeat(np.arange(a, b), np.append(heads[a + 1:b], last) - heads[a:b])
        other = _gathered(v.start[v.owner[at]], size)
        good = lists.asked(np.repeat(v.term[at], size), v.term[other])
        other = other[good]
        keys = np.repeat(block, size)[good] * width + v.term[other]
        order = np.argsort(keys)
        keys = keys[order]
        new = np.flatnonzero(np.diff(keys, prepend=-1))
        found.append((keys[new], np.maximum.reduceat(v.value[other[order]], new) if len(new) else np.zeros(0, np.int64)))
    keys, values = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
    return np.bincount(keys // width, minlength=len(heads)), keys % width, values


#: Of a segment: its documents and their vectors; its blocks with term, smallest doc_id, size and members; their maxima.
_PARTS = {"doc": "i8", "row": "i8", "size": "i4", "term": "i4", "value": "i8", "block_term": "i4", "block_least": "i8", "block_size": "i4",
          "member": "i4", "peak_size": "i4", "peak_term": "i4", "peak": "i8"}
INDEX = ", ".join(f"{name} binary" for name in _PARTS)


def _indexed(lists, weights, counted: DataFrame) -> DataFrame:
    """The index, a segment a row."""
    def rows(batches):
        known, corpus = lists.value, weights.value
        width = max(1, len(known.listed))
        for segment in _segments(batches):
            v = _Vectors(segment, corpus)
            places, heads = _blocks(v, np.flatnonzero(known.listed[v.term]))
            if not len(places):
                continue
            peak_size, peak_term, peak = _peaks(v, known, places, heads, width)
            member = v.owner[places]
            made = {"doc": v.doc, "row": v.row, "size": v.size, "term": v.term, "value": v.value, "block_term": v.term[places[heads]],
                    "block_least": np.minimum.reduceat(v.doc[member], heads), "block_size": np.diff(np.append(heads, len(places))), "member": member,
                    "peak_size": peak_size, "peak_term": peak_term, "peak": peak}
            yield pa.RecordBatch.from_arrays([pa.array([made[name].astype(kind).tobytes()], pa.binary()) for name, kind in _PARTS.items()], list(_PARTS))
    return counted.mapInArrow(rows, INDEX)


class _Segment(_Vectors):
    """A segment of the index, as it was written."""

    def __init__(self, row: dict[str, bytes]):
        for name, kind in _PARTS.items():
            setattr(self, name, np.frombuffer(row[name], kind).astype(np.int64))
        self.start, self.block_start, self.peak_start = (np.cumsum(x) - x for x in (self.size, self.block_size, self.peak_size))
        at = np.flatnonzero(np.diff(self.block_term, prepend=-1))
        # Blocks of one term stand together.
        self.blocks = dict(zip(self.block_term[at].tolist(), zip(at.tolist(), np.append(at[1:], len(self.block_term)).tolist())))


def _searched(items, lists, index: DataFrame, k: int) -> DataFrame:
    """What the blocks that can hold one of an item's best documents give, as (item, score, doc, row)."""
    def rows(batches):
        known, asked = items.value, lists.value
        best, weight = _Best(k), np.zeros(len(known.terms), np.int64)
        for batch in batches:
            for record in batch.to_pylist():
                segment = _Segment(record)
                for q, listed in enumerate(asked.needed):
                    ranges = [segment.blocks[t] for t in listed if t in segment.blocks]
                    if not ranges:
                        continue
                    terms, times = known.of[q]
                    weight[terms] = times
                    block = np.concatenate([np.arange(a, b) for a, b in ranges])
                    size = segment.peak_size[block]
                    at = _gathered(segment.peak_start[block], size)
                    bound = _sums(weight[segment.peak_term[at]] * segment.peak[at], size)
                    score, least = best.threshold(q, asked.threshold[q])
                    block = block[(bound > score) | (bound == score) & (segment.block_least[block] <= -least)]
                    if len(block):
                        which = np.unique(segment.member[_gathered(segment.block_start[block], segment.block_size[block])])
                        scores = segment.scores(which, weight)
                        good = (scores > 0) & ((scores > score) | (scores == score) & (segment.doc[which] <= -least))
                        best.add(q, scores[good], segment.doc[which[good]], segment.row[which[good]])
                    weight[terms] = 0
        yield best.batch()
    return index.mapInArrow(rows, BEST)


def _batches(items: DataFrame) -> Iterator[tuple[list, list]]:
    """Item ids and texts, in batches whose terms fit a broadcast."""
    ids, texts, words = [], [], 0
    for item, text in items.toLocalIterator():
        more = len(text or "") // 2 + 1
        if ids and (len(ids) >= ITEMS or words + more > ITEM_WORDS):
            yield ids, texts
            ids, texts, words = [], [], 0
        ids.append(item)
        texts.append(text)
        words += more
    if ids:
        yield ids, texts


def search_items(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` documents with the highest scores above 0 for each item: item_id, rank, doc_id, score.

    Terms are runs of letters, digits and all non-ASCII characters, A-Z lower-cased; a null text has
    none. N counts the documents with a term, L all their terms, n one document's, df a term's documents
    and tf its occurrences in one. A term weighs w = floor(1000 ln((2N + 2) / (2 df + 1))); a document's m
    is 25 + (75 n N) div L; its score sums w ((10^9 tf) div (1000 tf + 8 m)) over the item's terms,
    repeats included. Equal scores go by ascending doc_id; a null doc_id comes last.

    Every row of either table stands for itself, repeated ids too. Items without terms, or whose terms no
    document has, give no rows. Only the items' words are indexed; statistics are of the whole corpus.
    Items are searched in batches of at most 4,096 with about two million words. Other columns are ignored.
    """
    spark = docs.sparkSession
    B.bounded_batches(spark)
    texts = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(B.NO_ID)).alias("doc"), "text")
    kind = dict(items.dtypes)["item_id"]
    schema = f"item_id {kind}, rank int, doc_id bigint, score bigint"
    result = None
    for ids, own in _batches(items.select("item_id", "text")):
        found = _search(texts, own, k)
        if found is not None:
            names = tiny_table(spark, list(enumerate(ids)), f"item bigint, item_id {kind}")
            named = found.join(F.broadcast(names), "item").select(
                "item_id", F.col("rank").cast("int").alias("rank"), F.when(F.col("doc") != B.NO_ID, F.col("doc")).alias("doc_id"), "score")
            result = named if result is None else result.union(named)
    return spark.createDataFrame([], schema) if result is None else result


def _search(docs: DataFrame, texts: list, k: int) -> DataFrame | None:
    context = docs.sparkSession.sparkContext
    known = _Items(texts)
    items = context.broadcast(known)
    counted = checkpointed(_counted(items, docs)).withColumn("row", F.monotonically_increasing_id())

    def holders(batches):
        counts = np.zeros(len(known.terms), np.int64)
        for batch in batches:
            term = np.frombuffer(b"".join(batch.column("terms").to_pylist()), np.int32)
            counts += np.bincount(term, minlength=len(counts))
        there = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(counts[there])], ["term", "docs"])

    size = counted.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    df = np.zeros(len(known.terms), np.int64)
    for t, n in counted.select("terms").mapInArrow(holders, "term bigint, docs bigint").groupBy("term").agg(F.sum("docs")).collect():
        df[t] = n
    if not df.any():
        return None
    corpus = _Weights(size[0], size[1], df)
    weights = context.broadcast(corpus)

    firsts = checkpointed(_firsts(items, weights, counted, k))
    most = np.zeros(len(known.terms), np.int64)
    for t, value in firsts.where("item < 0").groupBy("item").agg(F.max("score")).collect():
        most[-1 - t] = value
    last = _best(firsts.where("item >= 0 AND score > 0"), k).where(F.col("rank") == k).select("item", "score", "doc").collect()
    lists = context.broadcast(_Lists(known, most, {q: (score, -doc) for q, score, doc in last}))

    path = scratch_path(docs.sparkSession, "lexical_index")
    _indexed(lists, weights, counted).write.parquet(path)
    index = docs.sparkSession.read.parquet(path)
    return _best(checkpointed(_searched(items, lists, index, k)), k)


#: The same by SQL, over every pair of an item's term and a document that has it.
ORACLE = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
asked AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
sizes AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM sizes),
postings AS (SELECT doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), whole),
scores AS (
  SELECT item_id, doc_id,
         sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * docs) // terms)))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN sizes USING (doc_id), whole GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
