"""Keyed feature frames over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabfeat.operators.split import SplitOptions, inject_missing, split_exact, split_hash, split_with_missing
from tabfeat.spec import FeatureSpec, nan_to_null

LINE_KEY = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "price_cents")
LINE = FeatureSpec(LINE_KEY, ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "line_no"), "charge")
LINE_INTER = FeatureSpec(LINE_KEY, ("l_extendedprice", "l_discount", "l_quantity", "l_tax"), "discount_amount")
EVENTS = FeatureSpec(("event_id",), ("value", "hour", "day", "user"), "log_value", order_by=("ts", "event_id"))
DOCS = FeatureSpec(("doc_id",), ("n_chars",), "quality")
ACCOUNTS = FeatureSpec(("c_custkey",), ("c_acctbal", "nation"))
PARTS = FeatureSpec(("p_partkey",), ("p_size", "part_no"), "p_retailprice")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _line(spark: SparkSession, folder: str, features: tuple[str, ...], target: str) -> DataFrame:
    amounts = {
        "line_no": F.col("l_linenumber").cast("double"),
        "price_cents": F.round(F.col("l_extendedprice") * 100).cast("bigint"),
        "charge": F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax")),
        "discount_amount": F.col("l_extendedprice") * F.col("l_discount"),
    }
    names = (*LINE_KEY, *features, target)
    return nan_to_null(table(spark, folder, "lineitem").select(
        *[amounts[n].alias(n) if n in amounts else F.col(n) for n in names]))


def line(spark: SparkSession, folder: str) -> DataFrame:
    return _line(spark, folder, LINE.features, LINE.target)


def line_inter(spark: SparkSession, folder: str) -> DataFrame:
    return _line(spark, folder, LINE_INTER.features, LINE_INTER.target)


def line_null(spark: SparkSession, folder: str) -> DataFrame:
    return inject_missing(line(spark, folder), LINE, "l_quantity", 0.05, 42)


def line_split(spark: SparkSession, folder: str) -> DataFrame:
    return split_with_missing(line(spark, folder), LINE, SplitOptions(), "l_quantity", 0.05)


def line_inter_split(spark: SparkSession, folder: str) -> DataFrame:
    return split_exact(line_inter(spark, folder), LINE_INTER)


def events(spark: SparkSession, folder: str) -> DataFrame:
    return nan_to_null(table(spark, folder, "events").select(
        "event_id", "ts", "value",
        F.hour("ts").cast("double").alias("hour"), F.dayofmonth("ts").cast("double").alias("day"),
        F.col("user_id").cast("double").alias("user"), F.log1p("value").alias("log_value")))


def docs(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels").select("doc_id", F.col("quality").cast("double").alias("quality"))
    sizes = table(spark, folder, "documents").select("doc_id", F.col("n_chars").cast("double").alias("n_chars"))
    return sizes.join(labels, "doc_id")


def accounts(spark: SparkSession, folder: str) -> DataFrame:
    return nan_to_null(table(spark, folder, "customer").select(
        "c_custkey", "c_acctbal", F.col("c_nationkey").cast("double").alias("nation"), "c_mktsegment"))


def parts(spark: SparkSession, folder: str) -> DataFrame:
    return nan_to_null(table(spark, folder, "part").select(
        "p_partkey", F.col("p_size").cast("double").alias("p_size"),
        F.col("p_partkey").cast("double").alias("part_no"), "p_retailprice", "p_brand"))


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Three closed-form predictors of the line charge, split by key hash: input of every metric query."""
    price, discount = F.col("l_extendedprice"), F.col("l_discount")
    guesses = F.map_from_arrays(
        F.array(F.lit("list_price"), F.lit("net_price"), F.lit("typical_rate")),
        F.array(price, price * (1 - discount), price * 0.988))
    # The split is decided per line, before each line becomes one row per model.
    return split_hash(line(spark, folder), LINE).select(
        F.explode(guesses).alias("model", "pred"), "split", *LINE_KEY, F.col("charge").alias("y"), "line_no",
    ).select("model", "split", *LINE_KEY, "line_no", "y", "pred")
