"""Session level helpers: shared scratch space, size-checked broadcasts, tiny tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 500_000
_ARROW = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        existing = spark.sparkContext.getCheckpointDir()
        if existing is not None:
            return existing
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="tabfeat-")
        spark.sparkContext.setCheckpointDir(folder)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise a frame in the shared folder and cut its lineage."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def let_go(spark: SparkSession) -> None:
    """Have the files removed of shuffles that no frame needs any more.

    Spark does so when the driver's memory is next cleaned. A loop of small steps may end before that, and
    keep the files of all its steps, two for every task of every shuffle.
    """
    spark.sparkContext._jvm.System.gc()


def small_side(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a join side only when it is counted to be small; else leave the join to Spark."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def tiny_table(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """A DataFrame from a handful of fitted values held by the driver."""
    fields = T.StructType.fromDDL(schema).fields
    rows = list(rows)
    if any(f.dataType.simpleString() not in _ARROW for f in fields):
        return spark.createDataFrame(rows, schema).coalesce(1)
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    # An Arrow table becomes a local relation: scanning it starts no Python worker.
    arrays = [pa.array(c, _ARROW[f.dataType.simpleString()]) for c, f in zip(columns, fields, strict=True)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, [f.name for f in fields]), schema)
