"""Near-duplicate documents by MinHash with tensored banding."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabfeat.llm import blocks as B
from tabfeat.llm.components import components
from tabfeat.session import checkpointed, small_side

SIDE = 8  # half keys on each side; every pair of a left and a right one is a table
HASHES = 4 * SIDE  # two hashes to a half key
WORDS = HASHES // 4  # the 16-bit hashes are kept four to a number
LEAST_EQUAL = 14  # of 32 hashes: at a similarity of 0.8, fewer agree once in a million pairs
PACK = 4096  # weight of the pairs of blocks that a call takes together
BLOCK = 1024  # weight of a block of a large bucket or cluster
UNIT = 4096  # a row weighs 1, and 1 more for so many bytes of its set
_SKETCH = [f"m{i}" for i in range(WORDS)]


def _sets(part: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each document, one behind the other, and their cuts."""
    padded, starts, stops, first = B.words(part, at, B.LOWER_SPACED)
    word = B.range_hashes(padded, starts, stops)
    counts = np.diff(first)
    short = np.flatnonzero((counts > 0) & (counts < size))
    places = np.concatenate([first[short], np.flatnonzero(B.window_rows(first, size))])
    sizes = np.concatenate([counts[short], np.full(len(places) - len(short), size)])
    keys = B.range_hashes(word, places, places + sizes, seed=1)
    row = np.searchsorted(first, places, side="right") - 1
    order = np.lexsort((keys, row))
    keys, row = keys[order], row[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (row[1:] != row[:-1])
    return keys[new], np.searchsorted(row[new], np.arange(len(at)))


def _sketches(size: int):
    """Per document: size and hash of its set, and the least hashes."""
    seeds = B.mixed(np.arange(1, HASHES + 3, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)

    def sketch(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            for start, stop, part, at in B.slices(*B.flatten(batch.column("text"))):
                keys, cuts = _sets(part, at, size)
                some = np.flatnonzero(np.diff(cuts))
                begins = cuts[some]
                least = np.zeros((HASHES, stop - start), np.uint64)
                whole = np.zeros((2, stop - start), np.uint64)
                if len(some):
                    for i in range(HASHES):
                        least[i, some] = np.minimum.reduceat(keys * seeds[i], begins)
                    for i in range(2):
                        whole[i, some] = np.add.reduceat(B.mixed(keys ^ seeds[HASHES + i]), begins)
                # The top bits of a minimum are always small, so it is mixed first.
                least = B.mixed(least) >> np.uint64(48)
                shifts = np.uint64(16) * np.arange(4, dtype=np.uint64)[:, None]
                packed = [np.bitwise_or.reduce(least[4 * i:4 * i + 4] << shifts) for i in range(WORDS)]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(start, stop - start), pa.array(np.diff(cuts).astype(np.int64)),
                     *[pa.array(x.view(np.int64)) for x in (*whole, *packed)]],
                    ["doc_id", "n", "s0", "s1", *_SKETCH])
    return sketch


def _set_rows(size: int):
    def rows(batches):
        for batch in batches:
            ids = batch.column("id")
            for start, stop, part, at in B.slices(*B.flatten(batch.column("text"))):
                keys, cuts = _sets(part, at, size)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(start, stop - start),
                     pa.array([keys[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())], ["id", "keys"])
    return rows


def _half(value: Column, low: bool) -> Column:
    return value.bitwiseAND(F.lit(0xFFFFFFFF)) if low else F.shiftrightunsigned(value, 32)


def _tables(reps: DataFrame) -> DataFrame:
    """(key, id) for every table: a left and a right half key, and which two they are."""
    left = [_half(F.col(_SKETCH[i // 2]), i % 2 == 0) for i in range(SIDE)]
    right = [_half(F.col(_SKETCH[WORDS // 2 + i // 2]), i % 2 == 0) for i in range(SIDE)]
    keys = [F.struct(F.lit(i * SIDE + j).alias("t"), F.shiftleft(a, 32).bitwiseOR(b).alias("key"))
            for i, a in enumerate(left) for j, b in enumerate(right)]
    return reps.select("id", F.inline(F.array(*keys))).select("t", "key", "id")


def _may_link(left: str, right: str, percent: int) -> Column:
    """The sizes allow the similarity, and enough of the 16-bit hashes agree."""
    differ = [F.col(f"{left}.{name}").bitwiseXOR(F.col(f"{right}.{name}")) for name in _SKETCH]
    equal = [x.bitwiseAND(F.lit(0xFFFF << shift)) == 0 for x in differ for shift in (0, 16, 32)]
    equal += [F.shiftrightunsigned(x, 48) == 0 for x in differ]
    a, b = F.col(f"{left}.n"), F.col(f"{right}.n")
    return (100 * F.least(a, b) >= percent * F.greatest(a, b)) & (
        reduce(Column.__add__, [e.cast("int") for e in equal]) >= LEAST_EQUAL)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""
    def links(batches):
        for batch in batches:
            found = []
            for x, y in zip(batch.column("keys_a").to_pylist(), batch.column("keys_b").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                same = int(B.among(x, y).sum())
                found.append(100 * same >= percent * (len(x) + len(y) - same))
            yield batch.select(["a", "b"]).filter(pa.array(found, pa.bool_()))

    left = sets.select(F.col("id").alias("a"), F.col("keys").alias("keys_a"))
    right = sets.select(F.col("id").alias("b"), F.col("keys").alias("keys_b"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "keys_a", "keys_b")
    return joined.mapInArrow(links, "a bigint, b bigint")


def _in_blocks(members: DataFrame, group: list[str], weight: Column) -> tuple[DataFrame, int]:
    """Rows of (group, id, component, …) sent to every pair of blocks in which they meet another component, and their whole weight.

    The members of a group's largest component and the others are cut into blocks that weigh about
    ``BLOCK``; a pair of blocks has one of the others at least. However large a group, a task gets two blocks.
    """
    counts = members.groupBy(*group, "component").agg(F.sum(weight).alias("c"))
    sizes = (counts.groupBy(*group).agg(F.max(F.struct("c", "component")).alias("top"), F.sum("c").alias("all"))
             .where("all > top.c").select(*group, F.col("top.component").alias("largest"), F.col("top.c").alias("most"), "all",
                                          F.ceil(F.expr("(all - top.c) / %d" % BLOCK)).cast("int").alias("others"),
                                          F.ceil(F.expr("top.c / %d" % BLOCK)).cast("int").alias("blocks")))
    sent = sizes.agg(F.expr("sum(most * others + (all - most) * (others + blocks))")).first()[0] or 0
    sizes = sizes.drop("most", "all")
    inside = F.col("component") == F.col("largest")
    turn = F.xxhash64("id")
    own = F.when(inside, F.col("others") + F.pmod(turn, F.col("blocks"))).otherwise(F.pmod(turn, F.col("others"))).cast("int")
    met = F.when(inside, F.sequence(F.lit(0), F.col("others") - 1)).otherwise(F.sequence(F.lit(0), F.col("others") + F.col("blocks") - 1))
    return (members.join(sizes, group).withColumn("own", own).withColumn("met", F.explode(met))
            .select(*members.columns, "own", F.least("own", "met").alias("i"), F.greatest("own", "met").alias("j"))), sent


def _packed(members: DataFrame, group: list[str], whole: bool) -> DataFrame:
    """Pairs of blocks, packed into groups that weigh about ``PACK``, as most of them are small.

    What a pack weighs is counted after the rows were copied to every pair of blocks.
    """
    weight = F.lit(1) + (F.expr("8 * n div %d" % UNIT) if whole else F.lit(0))
    rows, sent = _in_blocks(members, group, weight.cast("bigint"))
    return (rows.withColumn("pair", F.xxhash64(*group, "i", "j"))
            .select(F.pmod(F.xxhash64("pair"), F.lit(1 + sent // PACK)).alias("pack"), "pair", "id", "component", "n", "own", *_SKETCH,
                    *(["keys"] if whole else [])))


def _block_links(members: DataFrame, group: list[str], percent: int, whole: bool) -> DataFrame:
    """(a, b): links between components that meet in a group: by sketch, as components, or on whole sets, as ids.

    Of the links that join the same two components one is enough.
    """
    def linked(ids, component, n, own, lanes, keys):
        label = np.unique(component, return_inverse=True)[1]
        if whole:
            codes = np.unique(np.concatenate(keys), return_inverse=True)[1]
            sizes = np.array([len(k) for k in keys])
            begins = np.cumsum(sizes) - sizes
            mark = np.zeros(codes.max() + 1, np.int64)
        left, right = np.flatnonzero(own == own.min()), np.flatnonzero(own == own.max())
        for x in left:
            y = right[label[right] != label[x]]
            y = y[100 * np.minimum(n[y], n[x]) >= percent * np.maximum(n[y], n[x])]
            y = y[(lanes[y] == lanes[x]).sum(axis=1) >= LEAST_EQUAL]
            if whole and len(y):
                own_codes = codes[begins[x]:begins[x] + sizes[x]]
                mark[own_codes] = 1
                ends = np.cumsum(sizes[y])
                at = np.repeat(begins[y] - (ends - sizes[y]), sizes[y]) + np.arange(ends[-1])
                same = np.add.reduceat(mark[codes[at]], ends - sizes[y])
                mark[own_codes] = 0
                y = y[100 * same >= percent * (n[x] + n[y] - same)]
            for other, first in zip(*np.unique(label[y], return_index=True)):
                yield (ids[x], ids[y[first]]) if whole else (component[x], component[y[first]])
                label[label == other] = label[x]

    def links(table: pa.Table) -> pa.Table:
        table = table.sort_by("pair")
        ids, component, n, own, pair = (table[c].to_numpy() for c in ("id", "component", "n", "own", "pair"))
        lanes = np.column_stack([table[c].to_numpy() for c in _SKETCH]).astype(np.int64).view(np.uint16)
        keys = [np.frombuffer(k, np.uint64) for k in table["keys"].to_pylist()] if whole else None
        cuts = [0, *(np.flatnonzero(pair[1:] != pair[:-1]) + 1).tolist(), len(pair)]
        found = [link for a, b in zip(cuts, cuts[1:]) if b - a > 1
                 for link in linked(ids[a:b], component[a:b], n[a:b], own[a:b], lanes[a:b], keys and keys[a:b])]
        return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})

    return _packed(members, group, whole).groupBy("pack").applyInArrow(links, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Components of documents whose word shingles have a Jaccard similarity of ``percent`` or more.

    Words are runs without ASCII white space, A-Z lower-cased; a document's set holds its distinct
    ``size``-word shingles, or its whole sequence if that is shorter. Equal sets are one class, found
    by a hash of the set. Classes meet in 8 x 8 tables, keyed by pairs of half keys from two
    collections of 16 hashes; a pair at the threshold is missed about once in 1,700. Each bucket
    compares its members with its smallest. Buckets whose members are then in several components
    compare all sketches across components, in pairs of blocks of bounded size, and what may be linked
    is compared on whole sets in the same way. Every link is confirmed on the full sets.

    One row per input row: doc_id, n_shingles, component_id (the smallest doc_id reachable, itself
    included) and kept (doc_id = component_id). A document without words, and one with a null doc_id
    (component_id null, kept), is linked with nothing; rows with one doc_id count as one document,
    also if their sets differ. Other columns are ignored.
    """
    B.bounded_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    longs = ", ".join(f"{name} bigint" for name in ("doc_id", "n", "s0", "s1", *_SKETCH))
    sketches = checkpointed(texts.mapInArrow(_sketches(size), longs))
    known = sketches.where("doc_id IS NOT NULL AND n > 0")
    classes = checkpointed(known.groupBy("n", "s0", "s1").agg(
        F.min("doc_id").alias("id"), *[F.min(name).alias(name) for name in _SKETCH]))
    reps = classes.select("id", "n", *_SKETCH)
    tables = _tables(reps)
    shared = tables.groupBy("t", "key").agg(F.count("*").alias("members"), F.min("id").alias("pivot")).where("members > 1")
    members = checkpointed(tables.join(shared.drop("members"), ["t", "key"]))
    sets = checkpointed(texts.select(F.col("doc_id").alias("id"), "text")
                        .join(small_side(members.select("id").distinct()), "id", "left_semi")
                        .mapInArrow(_set_rows(size), "id bigint, keys binary"))
    # A doc_id with several sets joins their classes.
    repeated = known.groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1").select("doc_id")
    same = (known.join(repeated, "doc_id", "left_semi").join(classes.select("n", "s0", "s1", "id"), ["n", "s0", "s1"])
            .select(F.col("id").alias("a"), F.col("doc_id").alias("b")))

    met = members.where("id <> pivot").select("id", "pivot").distinct()
    pairs = (met.join(reps.alias("a"), met["id"] == F.col("a.id")).join(reps.alias("b"), met["pivot"] == F.col("b.id"))
             .where(_may_link("a", "b", percent)).select(F.col("a.id").alias("a"), F.col("b.id").alias("b")))
    links = checkpointed(same.union(_verified(pairs, sets, percent)))
    labels = checkpointed(components(links))

    now = members.join(labels, "id", "left").select("t", "key", "id", F.coalesce("component", "id").alias("component"))
    several = (now.groupBy("t", "key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
               .where("lo <> hi").select("t", "key"))
    unsettled = checkpointed(now.join(several, ["t", "key"]).join(reps, "id"))
    if not unsettled.isEmpty():
        near = _block_links(unsettled, ["t", "key"], percent, False)
        clusters = components(near).select(F.col("id").alias("component"), F.col("component").alias("cluster"))
        wide = checkpointed(unsettled.drop("t", "key").distinct().join(clusters, "component").join(sets, "id"))
        more = _block_links(wide, ["cluster"], percent, True)
        labels = checkpointed(components(links.union(more)))

    named = classes.select("n", "s0", "s1", "id").join(labels, "id", "left").select(
        "n", "s0", "s1", F.coalesce("component", "id").alias("component"))
    by_set = [F.col(f"d.{c}") == F.col(f"c.{c}") for c in ("n", "s0", "s1")]
    joined = (sketches.select("doc_id", "n", "s0", "s1").alias("d")
              .join(named.alias("c"), reduce(Column.__and__, by_set) & F.col("d.doc_id").isNotNull(), "left"))
    component = F.coalesce("c.component", "d.doc_id")
    return joined.select("doc_id", F.col("d.n").alias("n_shingles"), component.alias("component_id"),
                         (component.isNull() | (component == F.col("doc_id"))).alias("kept"))
