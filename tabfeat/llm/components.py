"""Connected components of a graph given as links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabfeat.session import checkpointed, let_go


def components(links: DataFrame) -> DataFrame:
    """(id, component): for every id in ``links(a, b)`` the smallest id that it reaches.

    Every step keeps what is connected and hangs ids on smaller ones, until all hang on the smallest
    one. A minimum per id is combined before its shuffle, so an id with many links is no hot row.
    """
    edges = checkpointed(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                         .where("a <> b").distinct())
    before = None
    while (now := edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()) != before:
        before = now
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))
        # Every larger neighbour hangs on the smallest of the neighbourhood …
        large = (edges.select(F.col("b").alias("a"), F.col("a").alias("far")).join(least, "a")
                 .select(F.col("far").alias("a"), F.col("least").alias("b")))
        # … and every smaller one on the smallest of these.
        small = large.distinct()
        low = small.groupBy("a").agg(F.min("b").alias("least"))
        edges = checkpointed(
            small.join(low, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b")
            .union(low.select("a", F.col("least").alias("b"))).distinct())
        del both, least, large, small, low
        let_go(links.sparkSession)
    ids = edges.groupBy("a").agg(F.min("b").alias("component"))
    roots = ids.select(F.col("component").alias("a")).distinct().withColumn("component", F.col("a"))
    return ids.union(roots).withColumnRenamed("a", "id")
