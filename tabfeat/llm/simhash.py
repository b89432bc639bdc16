"""SimHash fingerprints, and the search within a Hamming radius by permuted block tables. JVM expressions only."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabfeat.llm.blocks import NO_ID
from tabfeat.operators.rank import global_rank
from tabfeat.session import checkpointed

BITS = 64
HALF = 32
HEAVIEST = 8
_LANES = (1 << HALF) | 1
_SPACE = "[ \\t\\n\\x0B\\f\\r]+"


def _votes(word: Column) -> list[Column]:
    """Sums that count the votes for bits j and j + 32, side by side in one number; and all votes.

    A word weighs its length, up to 8, each time it occurs.
    """
    weight = F.least(F.char_length(word), F.lit(HEAVIEST)).cast("bigint")
    sums = [F.sum(F.shiftright(F.xxhash64(word), j).bitwiseAND(F.lit(_LANES)) * weight).alias(f"v{j}") for j in range(HALF)]
    return [*sums, F.sum(weight).alias("votes")]


def _fingerprint() -> Column:
    """A bit is set where more than half of the votes are for it."""
    def bit(j: int) -> Column:
        lane = F.col(f"v{j % HALF}")
        count = F.shiftright(lane, HALF) if j >= HALF else lane.bitwiseAND(F.lit((1 << HALF) - 1))
        return F.when(2 * count > F.col("votes"), F.lit((1 << j) - (1 << 64 if j == 63 else 0))).otherwise(F.lit(0).cast("bigint"))
    return reduce(Column.bitwiseOR, [bit(j) for j in range(BITS)])


def fingerprints(texts: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """(key, fingerprint) of every key's text; an empty text has fingerprint 0.

    Terms are runs without ASCII white space. The votes of a text are added up where it is read.
    """
    words = texts.select(*key, F.explode(F.split(text, _SPACE)).alias("word"))
    return words.groupBy(*key).agg(*_votes(F.col("word"))).select(*key, _fingerprint().alias("fingerprint"))


def hexadecimal(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), BITS // 4, "0")


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _block_keys(fingerprint: Column, radius: int, blocks: int) -> Column:
    """A key for every choice of blocks that stay equal when ``radius`` bits differ."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]

    def block(i: int) -> Column:
        mask = (1 << (edges[i + 1] - edges[i])) - 1
        return F.shiftrightunsigned(fingerprint, edges[i]).bitwiseAND(F.lit(mask))

    return F.array(*[F.struct(F.lit(t).alias("table"), F.xxhash64(*[block(i) for i in chosen]).alias("block"))
                     for t, chosen in enumerate(combinations(range(blocks), blocks - radius))])


def near_links(queries: DataFrame, corpus: DataFrame, radius: int = 3, blocks: int = 5) -> DataFrame:
    """(fingerprint, other, n_other): for each distinct fingerprint of ``queries``, every fingerprint of
    ``corpus`` within the radius, itself included, and the rows of ``corpus`` that have it.

    If at most ``radius`` bits differ, some choice of ``blocks - radius`` blocks is equal: every choice is
    a table, keyed by its blocks. Equal fingerprints are one entry with their count, so a group of copies
    is one row of each table; who is in it tells the corpus itself. A pair that meets in several tables
    is one link.
    """
    entries = corpus.groupBy("fingerprint").agg(F.count("*").alias("n")).select(
        "n", F.col("fingerprint").alias("other"), F.inline(_block_keys(F.col("fingerprint"), radius, blocks)))
    asked = queries.select("fingerprint").distinct().select(
        "fingerprint", F.inline(_block_keys(F.col("fingerprint"), radius, blocks)))
    return (asked.join(entries, ["table", "block"]).where(distance(F.col("fingerprint"), F.col("other")) <= radius)
            .groupBy("fingerprint", "other").agg(F.max("n").alias("n_other")))


def within_radius(queries: DataFrame, corpus: DataFrame, radius: int = 3, blocks: int = 5) -> DataFrame:
    """(fingerprint, n_near): for each distinct fingerprint of ``queries``, the rows of ``corpus`` within the radius."""
    return near_links(queries, corpus, radius, blocks).groupBy("fingerprint").agg(F.sum("n_other").alias("n_near"))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("id"),
                       F.coalesce("text", F.lit("")).alias("text"))


def _asked(query_step: int) -> Column:
    return F.col("id").isNotNull() & (F.col("id") % query_step == 0) & (F.col("id") != NO_ID)


def document_links(docs: DataFrame, radius: int = 3, query_step: int = 50) -> DataFrame:
    """Links of the fingerprints of all rows whose doc_id is divisible by ``query_step`` with those of all rows.

    One row per link: fingerprint, other (16 hexadecimal digits, never the same), n_bits (those that differ)
    and n_other (rows that have the other). Together with the fingerprints that ``edited_neighbours`` gives
    of every row these are all pairs of rows within the radius; pairs of copies are not written out. Null
    and empty texts have fingerprint 0 and are linked like others; null doc_ids ask nothing but are found.
    """
    texts, hashed = _texts(docs), F.xxhash64("text")
    rows = texts.groupBy("id", hashed.alias("h")).agg(F.count("*").alias("copies"))
    # Copies of a row vote alike, so they leave the fingerprint as it is.
    own = checkpointed(fingerprints(texts.select("id", hashed.alias("h"), "text"), ["id", "h"]).join(rows, ["id", "h"]))
    corpus = own.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    links = near_links(own.where(_asked(query_step)), corpus, radius).where("fingerprint <> other")
    return links.select(hexadecimal(F.col("fingerprint")).alias("fingerprint"), hexadecimal(F.col("other")).alias("other"),
                        distance(F.col("fingerprint"), F.col("other")).cast("bigint").alias("n_bits"), "n_other")


def edited_neighbours(docs: DataFrame, radius: int = 3, query_step: int = 50) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness.

    The edited text has the last floor(n_chars / 2) code points replaced by the first as many (or all) of
    the next document, ascending doc_id, after the last the first. One row per input row: doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, and n_near: how many other
    rows lie within the radius, for the rows whose doc_id is divisible by ``query_step``, else null.

    A null text is empty. A null doc_id counts as larger than any other. Of several texts under one
    doc_id the next document is the one with the smallest hash; a single document is its own next.
    Likeness is the share of equal bits. Other columns are ignored.
    """
    texts = _texts(docs)
    hashed, size = F.xxhash64("text"), F.char_length("text")
    variants = checkpointed(texts.groupBy("id", hashed.alias("h"), size.alias("n")).agg(F.count("*").alias("copies")))
    ranked = global_rank(variants.groupBy("id").agg(F.min("h").alias("h"), F.max("n").alias("n")), ["id"], "rank")
    total = F.lit(ranked.count())
    # Each document's first characters go to the one before it, as many as that may need.
    follows = checkpointed(ranked.select((F.pmod(F.col("rank") - 2, total) + 1).alias("rank"), F.col("id").alias("next"), "h")
                           .join(ranked.select("rank", F.col("id").alias("to"), F.floor(F.col("n") / 2).cast("int").alias("need")), "rank"))
    # The hash is compared behind the join, which so shares the shuffle of the texts by id.
    heads = (texts.join(follows.withColumnRenamed("next", "id"), "id")
             .select(F.col("to").alias("id"), F.when(hashed == F.col("h"), F.left("text", "need")).alias("head"))
             .groupBy("id").agg(F.max("head").alias("head")))
    half = F.floor(size / 2).cast("int")
    edited = F.concat(F.left("text", size - half), F.left("head", half))
    both = texts.join(heads, "id").select("id", hashed.alias("h"), "text", edited.alias("edited"))
    kinds = both.select("id", "h", F.sha2("edited", 256).alias("sha"), F.inline(F.array(
        F.struct(F.lit(0).alias("kind"), F.col("text").alias("text")), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text")))))
    made = checkpointed(fingerprints(kinds, ["id", "h", "sha", "kind"]))
    own = made.where("kind = 0").select("id", "h", "sha", "fingerprint")
    changed = made.where("kind = 1").select("id", "h", F.col("fingerprint").alias("edited_fingerprint"))
    after = (follows.join(own.select(F.col("id").alias("next"), "h", F.col("fingerprint").alias("next_fingerprint")), ["next", "h"])
             .select(F.col("to").alias("id"), "next_fingerprint"))
    rows = (variants.join(own, ["id", "h"]).join(changed, ["id", "h"]).join(after, "id")
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))))
    asked = _asked(query_step)
    near = within_radius(own.where(asked), variants.select("id", "h", "copies").join(own, ["id", "h"])
                         .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))), radius)

    def likeness(other: str) -> Column:
        return 1 - distance(F.col("fingerprint"), F.col(other)) / BITS

    return (rows.join(near, "fingerprint", "left").select(
        F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), F.col("n").cast("bigint").alias("n_chars"),
        F.col("sha").alias("edited_sha256"), hexadecimal(F.col("fingerprint")).alias("fingerprint"),
        hexadecimal(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        likeness("edited_fingerprint").alias("near_edited"), likeness("next_fingerprint").alias("near_next"),
        F.when(asked, F.col("n_near") - 1).alias("n_near")))
