"""Seeded, engine-independent row order from the row key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_digest(key: Sequence[str], seed: int, purpose: str = "split") -> Column:
    """Hex digest that orders rows as a seeded shuffle would, whatever the partitioning.

    Different purposes give independent orders, so that for example the rows that lose a value
    are not all in one split.
    """
    parts = [F.col(k).cast("string") for k in key]
    return F.md5(F.concat_ws("|", *parts, F.lit(f"{purpose}-{seed}")))


def share_mark(share: float) -> str:
    """Digests below this text make up ``share`` of all digests."""
    return "g" if share >= 1 else format(int(share * 2**32), "08x")


def digest_bucket(digest: Column, buckets: int) -> Column:
    """Bucket number 0..buckets-1, equal shares of the digest range."""
    passed = [(digest >= share_mark(i / buckets)).cast("int") for i in range(1, buckets)]
    number = F.lit(0)
    for p in passed:
        number = number + p
    return number
