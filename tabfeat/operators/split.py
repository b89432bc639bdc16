"""Seeded train / validation / test splits and seeded missing-value injection."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabfeat.functions.hashing import digest_bucket, key_digest, share_mark
from tabfeat.operators.rank import joint_cutoffs
from tabfeat.spec import FeatureSpec


@dataclass(frozen=True)
class SplitOptions:
    test_size: float = 0.2
    validation_size: float = 0.2
    seed: int = 42

    def __post_init__(self) -> None:
        if self.seed < 0:
            raise ValueError("seed must not be negative")
        for label, size in (("test_size", self.test_size), ("validation_size", self.validation_size)):
            if not 0 < size < 1:
                raise ValueError(f"{label} must lie between 0 and 1")
        if self.test_size + self.validation_size >= 1:
            raise ValueError("test_size and validation_size must sum to less than 1")

    def sizes(self, rows: int) -> tuple[int, int]:
        """Row counts of test and validation; the rest is train."""
        test = math.ceil(self.test_size * rows)
        share = self.validation_size / (1 - self.test_size)
        return test, math.ceil(share * (rows - test))

    def ranks(self, rows: int) -> list[int]:
        """Ranks of the last test row and the last validation row."""
        test, validation = self.sizes(rows)
        return [test, test + validation]


def _labelled(df: DataFrame, spec: FeatureSpec, digest: Column, cuts: list[str | None]) -> DataFrame:
    test_cut, validation_cut = cuts
    label = F.when(digest <= F.lit(test_cut), "test") if test_cut else F.when(F.lit(False), "test")
    if validation_cut:
        label = label.when(digest <= F.lit(validation_cut), "val")
    return df.withColumn(spec.split, label.otherwise("train"))


def _nulled(df: DataFrame, column: str, digest: Column, cut: str | None) -> DataFrame:
    return df if cut is None else df.withColumn(column, F.when(digest > F.lit(cut), F.col(column)))


def split_exact(df: DataFrame, spec: FeatureSpec, options: SplitOptions = SplitOptions()) -> DataFrame:
    """Exact split sizes: two digest cutoffs are found by counting, the split itself is a projection."""
    digest = key_digest(spec.key, options.seed)
    (cuts,) = joint_cutoffs(df, [digest], lambda rows: [options.ranks(rows)])
    return _labelled(df, spec, digest, cuts)


def split_with_missing(df: DataFrame, spec: FeatureSpec, options: SplitOptions = SplitOptions(),
                       column: str | None = None, share: float = 0.05) -> DataFrame:
    """``inject_missing`` and ``split_exact`` at once: all their cutoffs come from the same two scans."""
    column = column or spec.features[0]
    if column in spec.key:
        raise ValueError("a key column may not be nulled: the split is made by it")
    missing, digest = key_digest(spec.key, options.seed, "missing"), key_digest(spec.key, options.seed)
    (cut,), cuts = joint_cutoffs(df, [missing, digest], lambda rows: [[int(share * rows)], options.ranks(rows)])
    return _labelled(_nulled(df, column, missing, cut), spec, digest, cuts)


def split_hash(df: DataFrame, spec: FeatureSpec, options: SplitOptions = SplitOptions()) -> DataFrame:
    """Approximate split sizes from the digest alone: no pass over the data, works on a stream."""
    digest = key_digest(spec.key, options.seed)
    test, validation = share_mark(options.test_size), share_mark(options.test_size + options.validation_size)
    return df.withColumn(
        spec.split, F.when(digest < test, "test").when(digest < validation, "val").otherwise("train"))


def inject_missing(df: DataFrame, spec: FeatureSpec, column: str | None = None,
                   share: float = 0.05, seed: int = 42) -> DataFrame:
    """Null exactly ``int(share * rows)`` randomly chosen values of one feature (the first by default)."""
    column = column or spec.features[0]
    digest = key_digest(spec.key, seed, "missing")
    ((cut,),) = joint_cutoffs(df, [digest], lambda rows: [[int(share * rows)]])
    return _nulled(df, column, digest, cut)


def fold_number(spec: FeatureSpec, folds: int, seed: int = 42) -> Column:
    """Cross-validation fold of a row."""
    return digest_bucket(key_digest(spec.key, seed, "fold"), folds)
