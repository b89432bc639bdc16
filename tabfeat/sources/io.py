"""Feature tables and results in and out of storage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabfeat.spec import FeatureSpec, nan_to_null

WRITERS = 32
WRITER_BYTES = 16 << 20  # of a file that is being written


def load_features(spark: SparkSession, path: str, spec: FeatureSpec, fmt: str = "parquet",
                  schema: T.StructType | str | None = None) -> DataFrame:
    """Key, features (as double) and target of a stored table; only these columns are read."""
    reader = spark.read.option("header", True) if fmt == "csv" else spark.read
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.format(fmt).load(path)
    numbers = [*spec.features, *([spec.target] if spec.target else [])]
    return nan_to_null(df.select(*spec.key, *[F.col(c).cast("double").alias(c) for c in numbers]))


@contextmanager
def _open_writers(spark: SparkSession) -> Iterator[None]:
    """A task keeps a file of every folder open, up to ``WRITERS``, instead of sorting its rows by folder first."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(max(WRITERS, int(before))))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def save_splits(df: DataFrame, spec: FeatureSpec, path: str, fmt: str = "parquet") -> None:
    """One folder per split, so that reading one split prunes the others."""
    writer = df.write.mode("overwrite").partitionBy(spec.split).option("parquet.block.size", WRITER_BYTES)
    with _open_writers(df.sparkSession):
        (writer.option("header", True) if fmt == "csv" else writer).format(fmt).save(path)


def load_splits(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                split: str | None = None, split_column: str = "split") -> DataFrame:
    """Read saved splits with the schema they were written with; ``split`` reads just one."""
    reader = spark.read.schema(schema)
    df = (reader.option("header", True) if fmt == "csv" else reader).format(fmt).load(path)
    return df if split is None else df.where(F.col(split_column) == split)


def save_results(metrics: DataFrame, predictions: DataFrame, path: str) -> None:
    """Metrics as JSON (infinities survive as text), predictions as parquet by model and split."""
    metrics.withColumn("value", F.col("value").cast("string")).write.mode("overwrite").json(f"{path}/metrics")
    with _open_writers(predictions.sparkSession):
        (predictions.write.mode("overwrite").partitionBy("model", "split").option("parquet.block.size", WRITER_BYTES)
         .parquet(f"{path}/predictions"))


def load_results(spark: SparkSession, path: str, predictions_schema: T.StructType | str) -> tuple[DataFrame, DataFrame]:
    metrics = spark.read.schema("model string, split string, metric string, value string").json(f"{path}/metrics")
    predictions = spark.read.schema(predictions_schema).parquet(f"{path}/predictions")
    return metrics.withColumn("value", F.col("value").cast("double")), predictions


def export_table(df: DataFrame, path: str) -> None:
    """A result table as CSV with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)
