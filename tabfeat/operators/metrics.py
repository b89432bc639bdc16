"""Ten regression metrics per group of predictions, model comparison and importances.

Predictions are rows ``(model, split, key..., y, pred)``. Everything but the median and the
order-based error comes from one grouped aggregate; groups may be as uneven as they like,
because every aggregate combines before its shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabfeat.fixed_values import HIGHER_IS_BETTER, METRICS
from tabfeat.operators.quantiles import grouped_medians
from tabfeat.session import BROADCAST_ROWS, checkpointed

GROUP = ("model", "split")
SCALED = "mean_absolute_scaled_error"
_INF = float("inf")


def _scored(predictions: DataFrame) -> DataFrame:
    return predictions.where(F.col("y").isNotNull() & F.col("pred").isNotNull())


def moment_metrics() -> dict[str, Column]:
    """The eight metrics that are plain aggregates."""
    y, p = F.col("y"), F.col("pred")
    e = y - p
    percent = F.avg(F.when(y != 0, F.abs(e / F.nullif(y, F.lit(0.0))))) * 100
    scale = (F.abs(y) + F.abs(p)) / 2
    symmetric = F.avg(F.when(scale != 0, F.abs(e) / F.nullif(scale, F.lit(0.0)))) * 100
    sse = F.sum(e * e)
    sst = F.count("*") * F.var_pop(y)
    close = F.bool_and(F.abs(e) <= 1e-8 + 1e-5 * F.abs(p))
    return {
        "mse": F.avg(e * e),
        "rmse": F.sqrt(F.avg(e * e)),
        "mae": F.avg(F.abs(e)),
        "r2": F.when(sst == 0, F.when(sse == 0, 1.0).otherwise(0.0)).otherwise(1 - F.try_divide(sse, sst)),
        "mape": F.coalesce(percent, F.lit(_INF)),
        "smape": F.coalesce(symmetric, F.lit(_INF)),
        "max_error": F.max(F.abs(e)),
        "explained_variance": F.when(F.var_pop(y) == 0, F.when(close, 1.0).otherwise(0.0))
        .otherwise(1 - F.try_divide(F.var_pop(e), F.var_pop(y))),
    }


def naive_errors(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str = "y") -> DataFrame:
    """Absolute steps between neighbours in ``order``, per group: ``(by..., steps, total)``.

    Rows are dealt to buckets by ranges of group and order, so a group with most of the rows has most of
    the buckets. A window looks back inside a bucket only; what steps from one bucket to the next comes
    from a table with one row per bucket and group. Steps from or to a null value do not count.
    """
    names = {c: f"o{i}" for i, c in enumerate(order)}
    groups = {c: f"g{i}" for i, c in enumerate(by)}
    rows = df.select(*[F.col(c).alias(g) for c, g in groups.items()], *[F.col(c).alias(n) for c, n in names.items()],
                     F.col(value).cast("double").alias("v"))
    bucketed = rows.repartitionByRange(*groups.values(), *names.values()).withColumn("bucket", F.spark_partition_id())
    inside = Window.partitionBy("bucket", *groups.values()).orderBy(*names.values())
    # A bucket's ends are marked by the window: the extremes of a struct would sort all rows once more.
    pieces = (bucketed.select("bucket", *groups.values(), "v", F.abs(F.col("v") - F.lag("v").over(inside)).alias("step"),
                              F.lag(F.lit(1)).over(inside).isNull().alias("is_first"),
                              F.lead(F.lit(1)).over(inside).isNull().alias("is_last"))
              .groupBy("bucket", *groups.values())
              .agg(F.count("step").alias("steps"), F.coalesce(F.sum("step"), F.lit(0.0)).alias("total"),
                   F.max(F.when(F.col("is_first"), F.col("v"))).alias("first_v"),
                   F.max(F.when(F.col("is_last"), F.col("v"))).alias("last_v")))
    along = Window.partitionBy(*groups.values()).orderBy("bucket")
    joint = F.abs(F.col("first_v") - F.lag("last_v").over(along))
    return (pieces.withColumn("joint", joint).groupBy(*groups.values())
            .agg((F.sum("steps") + F.count("joint")).alias("steps"), (F.sum("total") + F.coalesce(F.sum("joint"), F.lit(0.0))).alias("total"))
            .withColumnsRenamed({g: c for c, g in groups.items()}))


_MARKS = ("_low", "_high", "_xor")


def _series_mark(order: Sequence[str]) -> Column:
    return F.xxhash64(*order, F.col("y").cast("double"))


def _series_sums(wanted: bool) -> list[Column]:
    """Sums over a group's marks that no order of its rows changes; null if there are too many."""
    low, high = F.col("_h").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("_h", 32)
    return [F.try_sum(low).alias("_low"), F.try_sum(high).alias("_high"), F.bit_xor("_h").alias("_xor")] if wanted else []


def _series_errors(rows: DataFrame, table: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``naive_errors`` of the groups in ``table``, worked out once for groups with the same targets in the same order.

    That is common: every model predicts the same rows. Such groups agree in their numbers of rows and in all
    sums of their marks. Rows are sorted by the number of their group instead of its names. More
    groups than may be broadcast are sorted by name, each for itself.
    """
    if table.limit(BROADCAST_ROWS + 1).count() > BROADCAST_ROWS:
        return naive_errors(rows, by, order)
    own = F.when(F.col("_low").isNull() | F.col("_high").isNull(), F.struct(*[F.col(c) for c in by]))
    numbered = table.select(*by, F.row_number().over(Window.orderBy(*by)).alias("_g"), "_n", *_MARKS, own.alias("_own"))
    alike = Window.partitionBy("_n", *_MARKS, "_own")
    groups = checkpointed(numbered.withColumn("_of", F.min("_g").over(alike)).select(*by, "_g", "_of"))
    first = groups.where("_g = _of")
    told = F.broadcast(first.select(F.col("_g").alias("_group"), *[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)]))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_by{i}")) for i, c in enumerate(by)])
    found = naive_errors(rows.select(*dict.fromkeys([*by, *order]), F.col("y").alias("_y")).join(told, same), ["_group"], order, "_y")
    return groups.join(found, F.col("_of") == F.col("_group")).select(*by, "steps", "total")


def metric_table(predictions: DataFrame, order_by: Sequence[str], by: Sequence[str] = GROUP,
                 metrics: Sequence[str] = METRICS) -> DataFrame:
    """One row per group, one column per metric; only what the named metrics need is computed.

    Ten groups and ten thousand take the same path: nothing about a group is held by the driver.
    """
    rows = _scored(predictions)
    series = [_series_mark(order_by).alias("_h")] if SCALED in metrics else []
    plain = moment_metrics()
    error = F.abs(F.col("y") - F.col("pred"))
    wanted = [m for m in plain if m in metrics or (m == "mae" and SCALED in metrics)]
    moments = [F.count("*").alias("_n"), *[plain[m].alias(m) for m in wanted], *_series_sums(bool(series))]
    if "median_ae" in metrics:
        # Several scans follow: keep the few columns they need, and let go of them before returning.
        kept = rows.select(*by, "y", "pred", *series).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            table = checkpointed(kept.groupBy(*by).agg(*moments))
            medians = checkpointed(grouped_medians(kept, by, error, "median_ae"))
        finally:
            kept.unpersist()
        table = checkpointed(_same_group(table, medians, by))
    else:
        table = rows.select("*", *series).groupBy(*by).agg(*moments)
    if SCALED in metrics:
        # The groups' series are compared before any row is sorted, so this scan comes first.
        table = table if "median_ae" in metrics else checkpointed(table)
        table = _same_group(table, _series_errors(rows, table, by, order_by), by)
        table = table.withColumn(SCALED, F.when(
            (F.col("steps") > 0) & (F.col("total") > 0),
            F.try_divide(F.col("mae"), F.try_divide(F.col("total"), F.col("steps")))).otherwise(F.lit(_INF)))
    return table.select(*by, *metrics)


def scored_counts(predictions: DataFrame, by: Sequence[str] = GROUP) -> DataFrame:
    """How many rows of each group the metrics are of, and how many have no target or no prediction: (by…, n, n_dropped)."""
    good = F.col("y").isNotNull() & F.col("pred").isNotNull()
    return predictions.groupBy(*by).agg(F.count_if(good).alias("n"), F.count_if(~good).alias("n_dropped"))


def _same_group(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    keys = reduce(lambda a, b: a & b, [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in by])
    joined = left.alias("l").join(right.alias("r"), keys, "left")
    return joined.select("l.*", *[F.col(f"r.{c}") for c in right.columns if c not in by])


def to_long(table: DataFrame, by: Sequence[str] = GROUP, metrics: Sequence[str] = METRICS) -> DataFrame:
    return table.unpivot(list(by), list(metrics), "metric", "value")


def all_metrics(predictions: DataFrame, order_by: Sequence[str], by: Sequence[str] = GROUP) -> DataFrame:
    return to_long(metric_table(predictions, order_by, by), by)


def one_metric(predictions: DataFrame, metric: str, order_by: Sequence[str] = (), by: Sequence[str] = GROUP) -> DataFrame:
    return to_long(metric_table(predictions, order_by, by, [metric]), by, [metric])


def compare_models(metrics: DataFrame, splits: Sequence[str] = ("test", "val")) -> DataFrame:
    """One row per model with ``test_*`` and ``val_*`` columns, best test error first."""
    names = [f"{s}_{m}" for s in splits for m in METRICS]
    named = metrics.where(F.col("split").isin(list(splits))).select(
        "model", F.concat_ws("_", "split", "metric").alias("name"), "value")
    wide = named.groupBy("model").pivot("name", names).agg(F.first("value"))
    return wide.orderBy(F.asc_nulls_last("test_rmse"), "model")


def best_model(metrics: DataFrame, metric: str = "rmse", split: str = "test") -> DataFrame:
    """``(metric, model, value)`` of the best model; null when nothing was evaluated."""
    if metric not in METRICS:
        raise ValueError(f"unknown metric: {metric}")
    sign = -1 if metric in HIGHER_IS_BETTER else 1
    # NaN orders last, like the worst score.
    preference = F.struct((F.col("value") * sign).alias("v"), F.col("model").alias("m"))
    return (metrics.where((F.col("split") == split) & (F.col("metric") == metric) & F.col("value").isNotNull())
            .agg(F.min_by("model", preference).alias("model"), F.min_by("value", preference).alias("value"))
            .select(F.lit(metric).alias("metric"), "model", "value"))


def predictions_of(predictions: DataFrame, model: str) -> DataFrame:
    return predictions.where(F.col("model") == model)


def importance_pivot(importance: DataFrame, models: Sequence[str] | None = None) -> DataFrame:
    """Features by models, absent ones as 0, with their average over all models, largest first."""
    if models is None:
        models = [r[0] for r in importance.select("model").distinct().orderBy("model").collect()]
    wide = importance.groupBy("feature").pivot("model", list(models)).agg(F.sum("importance")).fillna(0.0)
    total = reduce(lambda a, b: a + b, [F.col(f"`{m}`") for m in models], F.lit(0.0))
    return wide.withColumn("average", total / max(1, len(models))).orderBy(F.desc("average"), "feature")


def top_features(importance: DataFrame, n: int = 15, score: str = "importance") -> DataFrame:
    return importance.orderBy(F.desc_nulls_last(score), "feature").limit(n)


def format_metrics(metrics: DataFrame, precision: int = 4) -> DataFrame:
    """Values as text with fixed decimals."""
    return metrics.withColumn("text", F.format_string(f"%.{precision}f", "value"))


def segment_spread(predictions: DataFrame, order_by: Sequence[str], segment: str,
                   by: Sequence[str] = GROUP) -> DataFrame:
    """Every metric's smallest and largest value over the segments of a group, and their distance."""
    long = all_metrics(predictions, order_by, (*by, segment))
    return (long.groupBy(*by, "metric")
            .agg(F.min("value").alias("lowest"), F.max("value").alias("highest"), F.count("*").alias("segments"))
            .withColumn("spread", F.col("highest") - F.col("lowest")))
