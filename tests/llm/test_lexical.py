"""Ranked search against a plain version: odd texts, ties, hot terms, small blocks."""

import random

import brute
import numpy as np
import pyarrow as pa
import pytest

from tabfeat.llm import lexical as L

DOCS = "doc_id bigint, text string, row bigint, term string, n int, score double"
ITEMS = "item_id bigint, text string, rank int, doc string"


def found(spark, rows, items, k=10):
    docs = spark.createDataFrame([(i, t, 1, "t", 2, 0.5) for i, t in rows], DOCS).repartition(3)
    asked = spark.createDataFrame([(i, t, 1, "d") for i, t in items], ITEMS)
    return sorted((tuple(r) for r in L.search_items(docs, asked, k).collect()), key=str)


def test_odd_texts_and_items(spark):
    rng = random.Random(3)
    vocabulary = ["the", "The", "of", "café", "CAFÉ", "漢字", "x1", "a_b", "½", *(f"w{i}" for i in range(60))]
    rows = [(i, rng.choice([" ", ", ", "\n"]).join(rng.choice(vocabulary[:rng.choice([5, 20, 69])]) for _ in range(rng.choice([1, 5, 40, 300]))))
            for i in range(120, 0, -1)]
    rows += [(121, None), (122, ""), (123, " ,.! "), (7, "the the"), (7, "the the"), (None, "w1 w2 w3"), (None, None), (130, "w5 " * 40_000), (131, "w1 w2 w3")]
    items = [(1, "the of w1"), (2, None), (3, ""), (4, "nowhere at all"), (5, "w5"), (6, "w1 w2 w3 w1 CAFÉ"), (None, "x1 ½ a b"), (1, "the of w1"),
             (8, " ".join(vocabulary)), (9, "the")]
    assert found(spark, rows, items) == brute.ranked(rows, items)
    assert found(spark, rows, items, 3) == brute.ranked(rows, items, 3)


class Held:
    """Stands for a broadcast value, or for a frame whose batches are mapped here."""

    def __init__(self, value):
        self.value = value

    def mapInArrow(self, rows, schema):
        return list(rows(iter(self.value)))


def _counted(texts, items, ids=None):
    docs = pa.RecordBatch.from_arrays([pa.array(ids or range(len(texts)), pa.int64()), pa.array(texts)], ["doc", "text"])
    made, row = [], 0
    for b in L._counted(Held(items), Held([docs])):
        made.append(b.append_column("row", pa.array(range(row, row + b.num_rows), pa.int64())))
        row += b.num_rows
    return made


def _best(batches):
    best = {}
    for batch in batches:
        for r in batch.to_pylist():
            if r["item"] >= 0 and r["score"] > 0:
                best.setdefault(r["item"], set()).add((-r["score"], r["doc"], r["row"]))
    return {q: sorted(v)[:10] for q, v in best.items()}


@pytest.mark.parametrize("block, piece, segment", [(32, 1024, 8192), (2, 16, 64), (4, 7, 1)])
def test_a_hot_term_and_a_third_of_copies(monkeypatch, block, piece, segment):
    monkeypatch.setattr(L, "BLOCK", block)
    monkeypatch.setattr(L, "PIECE", piece)
    monkeypatch.setattr(L, "SEGMENT", segment)
    monkeypatch.setattr(L, "SEGMENT_TERMS", 20 * segment)
    rng = random.Random(4)
    rows = [(i, "hot " + " ".join(f"w{min(rng.randrange(1, 40), rng.randrange(1, 40))}" for _ in range(rng.randint(1, 30)))) for i in range(300)]
    rows += [(1000 + i, "hot copy of one text w3 w4") for i in range(200)] + [(i, "cold text w1") for i in range(2000, 2100)]
    rng.shuffle(rows)
    asked = [(0, "hot"), (1, "copy text"), (2, "w3 w4 hot"), (3, "w1 w1 w2"), (4, "text hot one w39 w38"), (5, "cold cold hot")]
    items = L._Items([t for _, t in asked])
    counted = _counted([t for _, t in rows], items, [i for i, _ in rows])
    terms = np.concatenate([np.frombuffer(b"".join(b.column("terms").to_pylist()), np.int32) for b in counted])
    weights = L._Weights(len(rows), sum(sum(b.column("n").to_pylist()) for b in counted), np.bincount(terms, minlength=len(items.terms)))
    firsts = L._firsts(Held(items), Held(weights), Held(counted), 10)
    most = np.zeros(len(items.terms), np.int64)
    for r in (r for b in firsts for r in b.to_pylist() if r["item"] < 0):
        most[-1 - r["item"]] = max(most[-1 - r["item"]], r["score"])
    lists = L._Lists(items, most, {q: (-v[9][0], -v[9][1]) for q, v in _best(firsts).items() if len(v) == 10})
    index = L._indexed(Held(lists), Held(weights), Held(counted))
    got = [(q, r, doc, -score) for q, v in _best(L._searched(Held(items), Held(lists), Held(index), 10)).items() for r, (score, doc, _) in enumerate(v, 1)]
    assert sorted(got, key=str) == brute.ranked(rows, asked)


def test_empty_tables_and_batches_of_items(spark, monkeypatch):
    assert found(spark, [], [(1, "a")]) == found(spark, [(1, "a b")], []) == found(spark, [(1, None)], [(1, "a")]) == []
    rows, items = [(i, f"a b{i % 3} c{i}") for i in range(20)], [(i, f"a b{i % 3} c{i}") for i in range(9)]
    whole = found(spark, rows, items)
    monkeypatch.setattr(L, "ITEMS", 4)
    assert found(spark, rows, items) == whole == brute.ranked(rows, items)


def test_segments_are_bounded_and_blocks_bound_their_documents(monkeypatch):
    rng = random.Random(5)
    texts = [" ".join(f"w{min(rng.randrange(50), rng.randrange(50))}" for _ in range(rng.randint(1, 60))) for _ in range(500)]
    items = L._Items([" ".join(f"w{i}" for i in range(a, a + 20)) for a in (0, 10, 25)])
    batches = _counted(texts, items)
    monkeypatch.setattr(L, "SEGMENT", 70)
    monkeypatch.setattr(L, "SEGMENT_TERMS", 900)
    parts = list(L._segments(batches))
    assert sum(p.num_rows for p in parts) == 500 and max(p.num_rows for p in parts) <= 70 and len(parts) < 20
    assert all(sum(len(t) for t in p["terms"].to_pylist()) <= 4 * 900 for p in parts)
    monkeypatch.setattr(L, "SEGMENT", 500)
    monkeypatch.setattr(L, "SEGMENT_TERMS", 10**6)
    (segment,) = L._segments(batches)
    weights = L._Weights(500, 15_000, np.bincount(np.frombuffer(b"".join(segment["terms"].to_pylist()), np.int32), minlength=len(items.terms)))
    lists = L._Lists(items, np.full(len(items.terms), 10**9), {})
    v = L._Vectors(segment, weights)
    places, heads = L._blocks(v, np.flatnonzero(lists.listed[v.term]))
    sizes, coordinates, values = L._peaks(v, lists, places, heads, len(items.terms))
    ends = np.append(heads, len(places))[1:]
    assert sorted(places) == np.flatnonzero(lists.listed[v.term]).tolist() and (ends - heads).max() <= 2 * L.BLOCK
    begin = np.cumsum(sizes) - sizes
    tight = 0
    for q, (terms, times) in enumerate(items.of):
        weight = np.zeros(len(items.terms), np.int64)
        weight[terms] = times
        for i in range(len(heads)):
            if int(v.term[places[heads[i]]]) in lists.needed[q]:
                peak = {int(t): int(x) for t, x in zip(coordinates[begin[i]:begin[i] + sizes[i]], values[begin[i]:begin[i] + sizes[i]])}
                scores = v.scores(v.owner[places[heads[i]:ends[i]]], weight)
                bound = sum(n * peak.get(t, 0) for t, n in zip(terms.tolist(), times.tolist()))
                assert bound >= scores.max()
                tight += bound < 1.6 * scores.max()
    assert tight > len(heads) / 3


def test_lists_leave_weak_terms_out():
    items = L._Items(["rare common", "common"])
    most = np.array([1_000_000, 9_000_000])
    lists = L._Lists(items, most, {0: (8_000_000, -5), 1: (900_000, -5)})
    assert lists.askers == {1: [0], 0: [1]}  # the first item reaches its threshold by its rare term only
    assert L._Lists(items, most, {}).askers == {0: [0, 1], 1: [0]}
