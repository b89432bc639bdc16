"""Collapse of cumulative conversation snapshots, and rendering of what is left. JVM expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabfeat.session import checkpointed


_WORDS = 2


def _turn_marks() -> list[Column]:
    """Two 64-bit hashes of a turn at its place."""
    return [F.xxhash64(F.lit(seed), "k", F.char_length("role"), "role", "text").alias(f"t{seed}") for seed in range(_WORDS)]


def format_conversations(turns: DataFrame, opening: str = "<|", closing: str = "|>", end: str = "<|end|>") -> DataFrame:
    """Render the maximal conversations of a log that also holds their earlier snapshots.

    Every turn prefix of a conversation has a rolling hash over the places, roles and texts so far: its
    number of turns and 128 bits that each turn changes once. A conversation whose last hash is that of a
    shorter prefix of another one is a snapshot of it and is left out; of conversations with the same
    turns the smallest conv_id stays.

    The hashes are running values of a window over hashes of the turns, so the work is linear in the
    turns; a conversation that holds a third of all turns is sorted by one task, which spills what it
    can't hold. Only a kept conversation is put together.

    Input: conv_id, turn, role, text; turns are ordered by turn, equal numbers by role and text. Null
    roles and texts count as empty; rows with a null conv_id are left out, a null turn comes first. Other
    columns are ignored. One row per kept conversation: conv_id, n_turns, n_copies (conversations with
    the same turns), rendered.
    """
    clean = turns.where("conv_id IS NOT NULL").select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    whole = Window.partitionBy("conv_id")
    order = whole.orderBy(F.asc_nulls_first("turn"), "role", "text")
    placed = clean.withColumn("k", F.row_number().over(order))
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    prefix = ["k", *[f"h{seed}" for seed in range(_WORDS)]]
    rolling = (placed.select("*", *_turn_marks())
               .select("conv_id", "k", *[F.bit_xor(f"t{seed}").over(so_far).alias(f"h{seed}") for seed in range(_WORDS)],
                       F.count("*").over(whole).alias("n_turns")))
    hashed = checkpointed(rolling)
    shorter = hashed.where("k < n_turns").select(*prefix).distinct()
    firsts = hashed.where("k = n_turns").groupBy(*prefix).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    kept = firsts.join(shorter, prefix, "left_anti").select("conv_id", "n_copies", F.col("k").cast("bigint").alias("n_turns"))
    line = F.concat(F.lit(opening), F.col("role"), F.lit(closing), F.lit("\n"), F.col("text"), F.lit(end))
    lines = F.array_sort(F.collect_list(F.struct("k", line.alias("line"))))
    return (placed.join(kept, "conv_id").groupBy("conv_id", "n_turns", "n_copies")
            .agg(F.array_join(F.transform(lines, lambda t: t["line"]), "\n").alias("rendered")))


ORACLE = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k
           FROM conversations WHERE conv_id IS NOT NULL),
p AS (SELECT conv_id, k, string_agg(length(role) || ':' || role || length(text) || ':' || text, '' ORDER BY k)
             OVER (PARTITION BY conv_id ORDER BY k) AS said FROM t),
w AS (SELECT conv_id, max(k) AS n FROM t GROUP BY conv_id),
f AS (SELECT p.conv_id, p.said, w.n FROM p JOIN w ON p.conv_id = w.conv_id AND p.k = w.n),
s AS (SELECT DISTINCT p.said FROM p JOIN w ON p.conv_id = w.conv_id AND p.k < w.n),
g AS (SELECT said, min(conv_id) AS conv_id, count(*) AS n_copies FROM f GROUP BY said),
m AS (SELECT conv_id, n_copies FROM g WHERE said NOT IN (SELECT said FROM s))
SELECT t.conv_id, count(*) AS n_turns, any_value(m.n_copies) AS n_copies,
       string_agg('<|' || role || '|>' || chr(10) || text || '<|end|>', chr(10) ORDER BY k) AS rendered
FROM t JOIN m ON t.conv_id = m.conv_id GROUP BY t.conv_id
"""
