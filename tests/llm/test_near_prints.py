"""Near-duplicates by fingerprints against a plain version, and the tiles."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tabfeat.llm import near_prints as N

SCHEMA = "doc_id bigint, text string, fingerprint string, component int, counts int, n double, no string"


def found(df):
    return sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in df.collect()), key=str)


def expected(rows):
    return sorted(((i, *v) for i, v in brute.print_components(rows).items()), key=str)


def test_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert found(N.near_prints(docs)) == expected(rows)


def test_odd_texts_and_clashing_columns(spark):
    rng = random.Random(1)
    words = [f"w{rng.randrange(99)}" for _ in range(300)]
    texts = [None, "", " \n\t\x0b ", "One", "one", "one two", "One\ntwo", "one  two", "a b c", "a b c a b c", "été ÉTÉ 漢字 \u0085", "\u2003x",
             " ".join(words), " ".join(words[:150] + ["new"] + words[150:]), "x" * 5000, " ".join(words * 90)]
    rows = list(enumerate(texts, 5))
    docs = spark.createDataFrame([(i, t, "f", 1, 2, 0.5, "n") for i, t in rows], SCHEMA)
    got = found(N.near_prints(docs))
    assert got == expected(rows) and {g[0]: g[1:] for g in got}[7] == ("0" * 16, 5)
    assert found(N.near_prints(docs, size=1)) == sorted(((i, *v) for i, v in brute.print_components(rows, 1).items()), key=str)


def test_empty_repeated_and_null_ids(spark):
    schema = "doc_id bigint, text string"
    assert N.near_prints(spark.createDataFrame([], schema)).count() == 0
    docs = spark.createDataFrame([(4, "a b"), (4, "a b"), (None, "a b"), (None, "z"), (4, "q r s")], schema)
    rows = {(r["doc_id"], r["component_id"], r["n_linked"]) for r in N.near_prints(docs).collect()}
    assert N.near_prints(docs).count() == 5 and rows == {(4, 4, 3), (None, 4, 3), (None, None, 1), (4, 4, 1)}


@pytest.mark.parametrize("tile", [4096, 64, 7])
def test_tiles_lose_no_link(spark, tile):
    rng = random.Random(2)
    prints = [rng.getrandbits(64) for _ in range(300)] + [0, (1 << 64) - 1, 1, 3]
    prints = list({q for p in prints for q in [p, *(p ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3))) for _ in range(3))]})
    # A chain, and a hot group: all within a few bits of one print.
    prints += [prints[0] ^ (1 << a) ^ (1 << b) for a in range(40) for b in range(a)]
    prints = list(set(prints))
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(p,) for p in signed], "fingerprint bigint")
    parent = {p: p for p in signed}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [tuple(r) for r in N.print_links(df, 2, tile).collect()]
    assert all((a ^ b) & (2**64 - 1) and ((a ^ b) & (2**64 - 1)).bit_count() <= 2 for a, b in links)
    for a, b in links:
        parent[root(a)] = root(b)
    near = [(a, b) for k, a in enumerate(signed) for b in signed[:k] if ((a ^ b) & (2**64 - 1)).bit_count() <= 2]
    assert len(near) > 5000 and all(root(a) == root(b) for a, b in near)


def test_more_parts_keep_what_is_compared_in_proportion(spark):
    prints = spark.range(200_000).select(F.xxhash64("id").alias("fingerprint"))
    for tile, parts in ((40_000, 1), (4_096, 2), (256, 4), (1, 8)):
        found, sizes = N._parts_wanted(prints, tile, 2)
        assert found >= parts and sizes.agg(F.sum(F.col("n") * F.col("n"))).first()[0] <= tile * 200_000 * 1.3
    for parts in (1, 2, 5, 16):
        steps = N._steps(parts, 2)
        assert len(steps) == parts * parts + parts + 1 and steps[0] == 0
