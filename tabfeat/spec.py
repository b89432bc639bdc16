"""Roles of the columns of a feature table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class FeatureSpec:
    """Which columns identify a row, feed a model, are predicted, and mark the split.

    The target lives in the same frame as the features, so nothing is ever aligned by
    position. ``key`` must identify a row; integer and string columns are safe to hash,
    floating point columns are not (their text form differs between engines).
    """

    key: tuple[str, ...]
    features: tuple[str, ...]
    target: str | None = None
    split: str = "split"
    order_by: tuple[str, ...] = ()

    @classmethod
    def infer(cls, df: DataFrame, key: Sequence[str], target: str | None = None,
              split: str = "split", order_by: Sequence[str] = ()) -> FeatureSpec:
        """Take every numeric column that has no other role as a feature."""
        taken = {*key, target, split, *order_by}
        features = tuple(
            f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in taken
        )
        return cls(tuple(key), features, target, split, tuple(order_by))

    def with_features(self, features: Sequence[str]) -> FeatureSpec:
        return replace(self, features=tuple(features))

    def require_target(self) -> str:
        if self.target is None:
            raise ValueError("this operation needs a target column")
        return self.target

    def ordering(self) -> tuple[str, ...]:
        return self.order_by or self.key


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _null_if_nan(name: str) -> Column:
    return F.when(~F.isnan(name), F.col(name)).alias(name)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Make null the only form of a missing value."""
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(*[(_null_if_nan(f"`{c}`") if c in floating else F.col(f"`{c}`")).alias(c) for c in df.columns])


def known_target(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Rows whose target is present: the only rows a fit or a metric may use."""
    return df.where(F.col(spec.require_target()).isNotNull())


def training_rows(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """The training split, or everything when the frame was never split."""
    return df.where(F.col(spec.split) == "train") if spec.split in df.columns else df
