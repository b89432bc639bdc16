"""Hard negatives against a plain version; the curve, the bounds and which blocks are read."""

import random
from itertools import product

import brute
import numpy as np
import pytest

from tabfeat.llm import hard_negatives as H

SCHEMA = "vec_id bigint, embedding array<float>, label int, tile int, block string, v double, score int"


def found(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1, "b", 0.5, 2) for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in H.mine_hard_negatives(df, **options).collect()), key=str)


def vectors(rng, n, width, spread=0.2):
    return [[rng.gauss(0, spread) for _ in range(width)] for _ in range(n)]


def as_floats(rows):
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows]


def test_odd_rows(spark):
    rng = random.Random(1)
    rows = [(20 * i, v, rng.randrange(3)) for i, v in enumerate(vectors(rng, 60, 6))]
    rows += [(None, [0.1] * 6, 1), (None, [0.1] * 6, 1), (100, None, 1), (200, [0.1] * 5 + [None], 1), (300, [float("nan")] * 6, 2), (400, [float("inf")] * 6, 0),
             (500, [0.2] * 6, None), (600, [], 1), (700, [0.5, 0.5], 1), (701, [0.5] * 9, 2), (800, [0.0] * 6, 0), (100, [0.3] * 6, 1), (100, [0.3] * 6, 1),
             (-100, [0.4] * 6, -1), (None, [0.2] * 6, None), (900, [20000.0] * 6, 1)]
    rows = as_floats(rows)
    want = brute.hard_negatives(rows)
    assert found(spark, rows) == want and len(want) > 200
    assert found(spark, rows, positives=2, negatives=3) == brute.hard_negatives(rows, 2, 3)


def test_empty_small_and_too_large(spark):
    assert found(spark, []) == found(spark, [(100, [0.5], 1)]) == found(spark, [(1, [0.5], 1), (2, [0.5], 2)]) == []
    assert found(spark, [(100, None, None)]) == []
    with pytest.raises(Exception, match="beyond 2"):
        found(spark, [(100, [1e30], 1), (1, [0.1], 2)])


def test_a_third_of_equal_vectors_in_small_blocks(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(10 * i, v, rng.randrange(4)) for i, v in enumerate(vectors(rng, 400, 8))]
    rows += [(10 * i + 1, [0.25] * 8, rng.randrange(4)) for i in range(150)] + [(100 * i, [0.25] * 8, 2) for i in range(500, 505)]
    rows = as_floats(rows)
    monkeypatch.setattr(H, "ROWS", 16)
    monkeypatch.setattr(H, "RUN", 2)
    monkeypatch.setattr(H, "ANCHORS", 3)
    assert found(spark, rows) == brute.hard_negatives(rows)


def test_the_curve_goes_from_neighbour_to_neighbour():
    for axes, bits in ((2, 4), (3, 3), (4, 2), (5, 1)):
        cells = np.array(list(product(range(2**bits), repeat=axes)))
        keys = H.hilbert_keys(cells, bits)
        order = np.lexsort(keys.T[::-1])
        assert len(np.unique(keys, axis=0)) == len(cells)
        assert (np.abs(np.diff(cells[order], axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_every_score():
    rng = np.random.default_rng(3)
    x, rows = rng.integers(-99, 99, (20, 7)), rng.integers(-99, 99, (30, 7))
    below, above = H.bounds(x, rows.min(axis=0)[None], rows.max(axis=0)[None])
    scores = x @ rows.T
    assert (below[:, 0] <= scores.min(axis=1)).all() and (above[:, 0] >= scores.max(axis=1)).all()


def test_blocks_that_cannot_hold_a_result_are_not_read(spark, monkeypatch):
    rng = random.Random(4)
    # Ten far groups, two to a label: an anchor's positives are in its own group.
    rows = [(5 * i, [8.0 * (d == i % 10) + rng.gauss(0, 0.01) for d in range(10)], (i % 10 // 2 - (i % 7 == 0)) % 10) for i in range(1000)]
    read = []
    chosen = H._chosen
    monkeypatch.setattr(H, "ROWS", 32)
    monkeypatch.setattr(H, "RUN", 1)
    monkeypatch.setattr(H, "_chosen", lambda tiles, blocks, moments: read.append((chosen(tiles, blocks, moments).count(), tiles.count() * blocks.count())) or chosen(tiles, blocks, moments))
    assert found(spark, as_floats(rows)) == brute.hard_negatives(as_floats(rows))
    assert read[0][0] < 0.35 * read[0][1]
