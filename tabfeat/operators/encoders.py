"""Encoders for text columns."""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabfeat.operators.rank import global_rank
from tabfeat.session import small_side

COLUMN_LIMIT = 1_000


def encode_onehot(df: DataFrame, column: str, form: str = "columns", column_limit: int = COLUMN_LIMIT) -> DataFrame:
    """One 0/1 column per category in sorted order, or with ``form="vector"`` one sparse vector.

    The form never depends on the data: too many categories for columns are an error.
    """
    if form not in ("columns", "vector"):
        raise ValueError(f"unknown form: {form}")
    if form == "vector":
        indexer = StringIndexer(inputCol=column, outputCol=f"{column}_index", handleInvalid="keep",
                                stringOrderType="alphabetAsc").fit(df)
        indexed = indexer.transform(df)
        encoder = OneHotEncoder(inputCol=f"{column}_index", outputCol=f"{column}_onehot", dropLast=False)
        return encoder.fit(indexed).transform(indexed).drop(f"{column}_index", column)
    categories = [r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct()
                  .limit(column_limit + 1).collect()]
    if len(categories) > column_limit:
        raise ValueError(f"more than {column_limit} categories: use form='vector'")
    flags = [F.col(column).eqNullSafe(F.lit(v)).cast("int").alias(f"{column}_{v}") for v in sorted(categories)]
    return df.select(*[c for c in df.columns if c != column], *flags)


def ordinal_codes(df: DataFrame, column: str, target: str | None = None) -> DataFrame:
    """``(category, code)``: categories numbered by mean target, or alphabetically without a target."""
    if target is None:
        ordered = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.lit(0.0).alias("mean"))
    else:
        ordered = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.avg(target).alias("mean"))
    ranked = global_rank(ordered, ["mean", column], "code")
    return ranked.select(column, (F.col("code") - 1).cast("int").alias("code"))


def encode_ordinal(df: DataFrame, column: str, target: str | None = None, name: str | None = None) -> DataFrame:
    """Replace categories by their codes; the code table is broadcast only while it is small."""
    codes = ordinal_codes(df, column, target).withColumnRenamed("code", name or f"{column}_code")
    return df.join(small_side(codes), column, "left").drop(column)
