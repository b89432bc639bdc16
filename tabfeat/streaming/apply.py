"""Fitted chains on streams: everything a chain leaves behind is a stateless projection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tabfeat.operators.split import SplitOptions, split_hash
from tabfeat.plans.chain import FeatureChain
from tabfeat.spec import FeatureSpec, nan_to_null


def read_feature_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    return nan_to_null(spark.readStream.schema(schema).format(fmt).load(path))


def prepared_stream(stream: DataFrame, spec: FeatureSpec, chain: FeatureChain,
                    options: SplitOptions | None = None) -> DataFrame:
    """The chain's features for every arriving row, with a hash split when options are given."""
    if options is not None:
        stream = split_hash(stream, spec, options)
    return chain.transform(stream)


def write_features(stream: DataFrame, path: str, checkpoint: str):
    """Append arriving features as parquet, everything available now."""
    return (stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(availableNow=True).start())
