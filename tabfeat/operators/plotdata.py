"""The tables behind residual, distribution, comparison and summary charts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabfeat.functions.shape import inverse_normal
from tabfeat.operators.profile import histograms
from tabfeat.operators.quantiles import exact_ranks
from tabfeat.operators.rank import global_rank
from tabfeat.session import tiny_table


def residuals(predictions: DataFrame) -> DataFrame:
    return predictions.withColumn("residual", F.col("y") - F.col("pred"))


def residual_histogram(predictions: DataFrame, bins: int = 30) -> DataFrame:
    return histograms(residuals(predictions), ["residual"], bins)


def qq_points(predictions: DataFrame, key: Sequence[str]) -> DataFrame:
    """Normal probability plot: every ordered residual against its normal quantile, ``(rank, theoretical, ordered)``."""
    values = residuals(predictions).select(*key, F.col("residual").alias("ordered")).where("ordered is not null")
    ranked = global_rank(values, ["ordered", *key])
    n = ranked.count()
    return ranked.select("rank", inverse_normal(_plot_position(F.col("rank"), n)).alias("theoretical"), "ordered")


def _plot_position(rank: Column, n: int) -> Column:
    end = 0.5 ** (1 / n) if n else 0.5
    return F.when(rank == n, end).when(rank == 1, 1 - end).otherwise((rank.cast("double") - 0.3175) / (n + 0.365))


def qq_quantiles(predictions: DataFrame, points: int = 1_001) -> DataFrame:
    """The probability plot thinned to evenly spaced ranks, first and last included: ``(rank, theoretical, ordered)``.

    The residuals at these ranks are found by counting, so nothing is sorted and only ``points`` rows are
    kept; with no more residuals than that all of them are shown.
    """
    def ranks(n: int) -> set[int]:
        return {k * (n - 1) // (points - 1) for k in range(points)} if n > points else set(range(n))

    n, found = exact_ranks(residuals(predictions), F.col("residual"), ranks)
    table = tiny_table(predictions.sparkSession, [(r + 1, v) for r, v in sorted(found.items())], "rank bigint, ordered double")
    return table.select("rank", inverse_normal(_plot_position(F.col("rank"), n)).alias("theoretical"), "ordered")


def qq_line(points: DataFrame) -> DataFrame:
    """Least-squares line through the probability plot."""
    return points.agg(F.regr_slope("ordered", "theoretical").alias("slope"),
                      F.regr_intercept("ordered", "theoretical").alias("intercept"),
                      F.corr("ordered", "theoretical").alias("r"))


def radar_scores(comparison: DataFrame) -> DataFrame:
    """Errors turned into 0..1 scores over the compared models, largest best; R2 stays as it is.

    The comparison has one row per model. With a single model, or equal errors, a score is null.
    """
    everything = Window.partitionBy()

    def score(c: str):
        lo, hi = F.min(c).over(everything), F.max(c).over(everything)
        return (1 - F.try_divide(F.col(c) - lo, hi - lo)).alias(c)

    return comparison.select("model", F.col("test_r2"), score("test_rmse"), score("test_mae"))


def metric_bars(metrics: DataFrame, split: str = "test") -> DataFrame:
    return metrics.where((F.col("split") == split) & F.col("metric").isin("rmse", "mae", "r2"))


def identity_line(predictions: DataFrame) -> DataFrame:
    """Ends of the diagonal in a plot of predictions against targets."""
    return predictions.agg(F.least(F.min("y"), F.min("pred")).alias("low"),
                           F.greatest(F.max("y"), F.max("pred")).alias("high"))


def summary_counts(metrics: DataFrame, importance: DataFrame, experiments: int | None = None) -> DataFrame:
    """Experiments, models, features, and the model with the smallest test error."""
    models = F.count_distinct("model")
    rmse = (F.col("split") == "test") & (F.col("metric") == "rmse")
    by_error = F.when(rmse, F.struct(F.col("value").alias("v"), F.col("model").alias("m")))
    rows = metrics.select("model", "split", "metric", "value", F.lit(None).cast("string").alias("feature"))
    names = importance.select(*[F.lit(None).cast(t).alias(c) for c, t in rows.dtypes[:-1]], "feature")
    return rows.unionByName(names).agg(
        (models if experiments is None else F.lit(experiments)).cast("bigint").alias("experiments"),
        models.alias("models"),
        F.count_distinct("feature").alias("features"),
        F.min_by(F.when(rmse, F.col("model")), by_error).alias("best_model"),
        F.min(F.when(rmse, F.col("value"))).alias("best_rmse"))


def shape_change(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows and columns before and after a feature chain."""
    def shape(df: DataFrame, label: str) -> DataFrame:
        return df.agg(F.count("*").alias("n_rows")).select(
            F.lit(label).alias("stage"), "n_rows", F.lit(len(df.columns)).cast("bigint").alias("n_columns"))

    return shape(before, "before").unionByName(shape(after, "after"))
