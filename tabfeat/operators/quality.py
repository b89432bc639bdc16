"""Data-quality, privacy and bias findings as rows ``(check, item, severity, message, value)``."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabfeat import fixed_values as fixed
from tabfeat.operators.profile import per_column
from tabfeat.operators.quantiles import quantiles
from tabfeat.session import checkpointed, small_side, tiny_table
from tabfeat.spec import nan_to_null, numeric_columns, text_columns

FINDING = "check string, item string, severity string, message string, value double"
_MARK = "_row_mark"


def _findings(rows: DataFrame, check: str, severity: str, message: str, item: str | Column, value: str) -> DataFrame:
    item = F.col(item) if isinstance(item, str) else item
    return rows.select(F.lit(check).alias("check"), item.alias("item"), F.lit(severity).alias("severity"),
                       F.lit(message).alias("message"), F.col(value).cast("double").alias("value"))


def no_findings(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], FINDING)


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


@dataclass(frozen=True)
class ColumnCheck:
    """A check of single columns: an aggregate that tells whether one is conspicuous, and the value to report."""

    check: str
    severity: str
    message: str
    columns: Sequence[str]
    found: Callable[[str], Column]
    value: Callable[[str], Column]


def column_findings(df: DataFrame, checks: Sequence[ColumnCheck]) -> DataFrame:
    """The findings of any number of column checks, all from a single scan."""
    asked = [(check, c) for check in checks for c in check.columns]
    if not asked:
        return no_findings(df.sparkSession)
    flat = df.agg(*[a for i, (check, c) in enumerate(asked)
                    for a in (check.found(_quoted(c)).alias(f"found_{i}"), check.value(_quoted(c)).cast("double").alias(f"value_{i}"))])
    rows = [F.struct(F.lit(check.check).alias("check"), F.lit(c).alias("item"), F.lit(check.severity).alias("severity"),
                     F.lit(check.message).alias("message"), F.col(f"value_{i}").alias("value"), F.col(f"found_{i}").alias("found"))
            for i, (check, c) in enumerate(asked)]
    return flat.select(F.inline(F.filter(F.array(*rows), lambda r: r["found"]))).drop("found")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _missing_check(columns: Sequence[str]) -> ColumnCheck:
    def share(c: str) -> Column:
        return F.avg(F.col(c).isNull().cast("double"))

    return ColumnCheck("quality", "warning", "more than half of the values are missing", columns,
                       lambda c: share(c) > fixed.HIGH_MISSING_SHARE, share)


def _constant_check(columns: Sequence[str]) -> ColumnCheck:
    return ColumnCheck("quality", "warning", "at most one distinct value", columns,
                       lambda c: F.min(c).eqNullSafe(F.max(c)), F.count)


def _outlier_check(fences: Mapping[str, tuple[float, float]]) -> ColumnCheck:
    by_name = {_quoted(c): f for c, f in fences.items()}

    def share(c: str) -> Column:
        return F.try_divide(_outside(c, by_name[c]), F.count("*"))

    return ColumnCheck("quality", "info", "many values beyond the quartile fences", list(fences),
                       lambda c: share(c) > fixed.HIGH_OUTLIER_SHARE, share)


def high_missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return column_findings(nan_to_null(df), [_missing_check(columns or df.columns)])


def constant_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """At most one distinct value: smallest equals largest, or nothing but nulls."""
    return column_findings(nan_to_null(df), [_constant_check(columns or df.columns)])


def _row_mark(columns: Sequence[str]) -> Column:
    return F.xxhash64(*columns, *[F.col(c).isNull() for c in columns])


def duplicate_rows(df: DataFrame, columns: Sequence[str] | None = None, method: str = "exact") -> DataFrame:
    """Rows beyond the first of each group of equal rows; missing equals missing.

    ``hash``, for wide or long-text tables, counts the rows by a hash of 8 bytes first. Only rows that
    share theirs with another row are then shuffled and compared as a whole, so the number is exact
    whatever collides. Copies are added up before they are shuffled, and rows that only share a hash
    go to different tasks.
    """
    names = list(columns or df.columns)
    df, columns = nan_to_null(df).select(*map(_quoted, names)), [_quoted(c) for c in names]
    if method == "hash":
        marked = df.withColumn(_MARK, _row_mark(columns))
        shared = checkpointed(marked.groupBy(_MARK).count().where("count > 1").select(_MARK))
        df = marked.join(small_side(shared), _MARK, "left_semi")
    elif method != "exact":
        raise ValueError(f"unknown duplicate method: {method}")
    extra = df.groupBy(*columns).agg((F.count("*") - 1).alias(_MARK)).agg(F.sum(_MARK).alias("extra"))
    return _findings(extra.where("extra > 0"), "quality", "info", "rows equal to an earlier row",
                     F.lit("rows"), "extra")


def _outside(c: str, fences: tuple[float, float]) -> Column:
    return F.count_if((F.col(c) < fences[0]) | (F.col(c) > fences[1]))


def outlier_fences(df: DataFrame, columns: Sequence[str], method: str = "exact") -> dict[str, tuple[float, float]]:
    """The Tukey fences of every column that has a value."""
    fences = {}
    for c, (q1, q3) in quantiles(df, columns, (0.25, 0.75), method).items():
        if q1 is not None:
            reach = fixed.OUTLIER_FENCE * (q3 - q1)
            fences[c] = (q1 - reach, q3 + reach)
    return fences


def high_outliers(df: DataFrame, columns: Sequence[str] | None = None, method: str = "exact") -> DataFrame:
    """Columns with more than a tenth of the rows beyond the Tukey fences."""
    df = nan_to_null(df)
    return column_findings(df, [_outlier_check(outlier_fences(df, list(columns or numeric_columns(df)), method))])


def outlier_shares(df: DataFrame, columns: Sequence[str] | None = None, method: str = "exact") -> DataFrame:
    df = nan_to_null(df)
    fences = outlier_fences(df, list(columns or numeric_columns(df)), method)
    if not fences:
        return tiny_table(df.sparkSession, [], "column string, outliers bigint, share double")
    return per_column(df, list(fences), outliers=lambda c: _outside(c, fences[c]),
                      share=lambda c: F.try_divide(_outside(c, fences[c]), F.count("*")))


def data_quality(df: DataFrame, columns: Sequence[str] | None = None, method: str = "exact",
                 duplicates: str = "exact") -> DataFrame:
    """All four quality checks; NaN counts as missing.

    The column checks share one scan, behind those that find the quartiles; duplicates take their own.
    """
    columns = list(columns or df.columns)
    df = nan_to_null(df)
    numeric = [c for c in numeric_columns(df) if c in columns]
    fences = outlier_fences(df, numeric, method) if numeric else {}
    checks = [_missing_check(columns), _constant_check(columns), _outlier_check(fences)]
    return _union([column_findings(df, checks), duplicate_rows(df, columns, duplicates)])


def _name_check(df: DataFrame) -> ColumnCheck:
    pattern = re.compile("|".join(fixed.PII_KEYWORDS), re.IGNORECASE)
    return ColumnCheck("privacy", "failed", "the column name suggests personal data",
                       [c for c in df.columns if pattern.search(c)], lambda c: F.lit(True), F.count)


def _text_check(columns: Sequence[str], pattern: str, message: str) -> ColumnCheck:
    def hits(c: str) -> Column:
        return F.count_if(F.col(c).contains(pattern) if pattern == fixed.EMAIL_LOOSE else F.col(c).rlike(pattern))

    return ColumnCheck("privacy", "failed", message, columns, lambda c: hits(c) > 0, hits)


def _email_check(columns: Sequence[str], mode: str) -> ColumnCheck:
    return _text_check(columns, {"loose": fixed.EMAIL_LOOSE, "strict": fixed.EMAIL_STRICT}[mode],
                       "values look like email addresses")


def _phone_check(columns: Sequence[str], mode: str) -> ColumnCheck:
    return _text_check(columns, {"loose": fixed.PHONE_LOOSE, "strict": fixed.PHONE_STRICT}[mode],
                       "values look like phone numbers")


def pii_columns(df: DataFrame) -> DataFrame:
    """Columns whose name contains a personal keyword, with how many values they hold."""
    return column_findings(df, [_name_check(df)])


def pii_email(df: DataFrame, columns: Sequence[str] | None = None, mode: str = "loose") -> DataFrame:
    """Text columns holding addresses, with the number of such values. ``loose`` looks for ``@`` only."""
    return column_findings(df, [_email_check(columns or text_columns(df), mode)])


def pii_phone(df: DataFrame, columns: Sequence[str] | None = None, mode: str = "loose") -> DataFrame:
    return column_findings(df, [_phone_check(columns or text_columns(df), mode)])


def privacy_check(df: DataFrame, mode: str = "loose", enabled: bool = True) -> DataFrame:
    """Names, addresses and phone numbers, from one scan."""
    if not enabled:
        return no_findings(df.sparkSession)
    texts = text_columns(df)
    return column_findings(df, [_name_check(df), _email_check(texts, mode), _phone_check(texts, mode)])


def mask_pii(df: DataFrame, texts: Sequence[str], identifiers: Sequence[str] = (), salt: str = "") -> DataFrame:
    """Addresses and phone numbers replaced in texts, identifiers replaced by salted digests."""
    def masked(c: str) -> Column:
        if c in texts:
            clean = F.regexp_replace(F.col(c), fixed.EMAIL_STRICT, "[email]")
            return F.regexp_replace(clean, fixed.PHONE_STRICT, "[phone]").alias(c)
        if c in identifiers:
            return F.sha2(F.concat(F.lit(salt), F.col(c).cast("string")), 256).alias(c)
        return F.col(c)

    return df.select(*[masked(c) for c in df.columns])


def bias_importance(importance: DataFrame) -> DataFrame:
    """Per model: one dominating feature, or very uneven importances."""
    stats = importance.groupBy("model").agg(
        F.max("importance").alias("top"), F.stddev_pop("importance").alias("std"))
    dominating = _findings(stats.where(F.col("top") > fixed.MAX_IMPORTANCE), "bias", "warning",
                           "one feature dominates the predictions", "model", "top")
    uneven = _findings(stats.where(F.col("std") > fixed.MAX_IMPORTANCE_STD), "bias", "warning",
                       "importance is unevenly distributed", "model", "std")
    return dominating.unionByName(uneven)


def bias_pred_range(predictions: DataFrame) -> DataFrame:
    """Models whose predictions span less than a tenth of the target's range."""
    spans = predictions.groupBy("model").agg(
        (F.max("pred") - F.min("pred")).alias("pred_span"), (F.max("y") - F.min("y")).alias("y_span"))
    narrow = spans.where(F.col("pred_span") < fixed.MIN_PREDICTION_RANGE * F.col("y_span"))
    return _findings(narrow.withColumn("share", F.try_divide(F.col("pred_span"), F.col("y_span"))),
                     "bias", "warning", "predictions span a limited range", "model", "share")


def bias_check(importance: DataFrame | None, predictions: DataFrame, enabled: bool = True) -> DataFrame:
    if not enabled:
        return no_findings(predictions.sparkSession)
    ranges = bias_pred_range(predictions)
    return ranges if importance is None else bias_importance(importance).unionByName(ranges)


def check_status(findings: DataFrame, checks: Sequence[str], disabled: Sequence[str] = ()) -> DataFrame:
    """``(check, findings, status)`` for every check that was asked for, found anything or not."""
    spark = findings.sparkSession
    asked = tiny_table(spark, [(c, c in disabled) for c in checks], "check string, disabled boolean")
    counted = findings.groupBy("check").agg(
        F.count("*").alias("findings"), F.max(F.col("severity") == "failed").alias("failed"))
    status = (F.when(F.col("disabled"), "disabled").when(F.col("failed"), "failed")
              .when(F.col("findings") > 0, "warning").otherwise("passed"))
    return (asked.join(counted, "check", "left")
            .select("check", F.coalesce("findings", F.lit(0)).cast("bigint").alias("findings"),
                    status.alias("status")))


def safety_rollup(status: DataFrame) -> DataFrame:
    """Worst status over all checks (error, failed, warning, passed; disabled is neutral) and its sentence."""
    order = ["passed", "warning", "failed", "error"]
    level = F.coalesce(F.max(F.array_position(F.array(*[F.lit(s) for s in order]), F.col("status"))), F.lit(1))
    worst = status.agg(F.greatest(level, F.lit(1)).cast("int").alias("level"))
    sentences = F.array(*[F.lit(fixed.SUMMARY[s]) for s in order])
    return worst.select(F.element_at(F.array(*[F.lit(s) for s in order]), F.col("level")).alias("overall_status"),
                        F.element_at(sentences, F.col("level")).alias("summary"))


def recommendations(status: DataFrame) -> DataFrame:
    """The advice of every check that found something."""
    advice = tiny_table(status.sparkSession,
                        [(c, i, t) for c, texts in fixed.RECOMMENDATIONS.items() for i, t in enumerate(texts)],
                        "check string, position int, recommendation string")
    return status.where("findings > 0").join(F.broadcast(advice), "check").select("check", "position", "recommendation")


def safety_report(status: DataFrame) -> DataFrame:
    """``(check, status, findings, recommendations)`` per check."""
    counts = recommendations(status).groupBy("check").agg(F.count("*").alias("recommendations"))
    return (status.join(counts, "check", "left")
            .select("check", "status", "findings",
                    F.coalesce("recommendations", F.lit(0)).cast("bigint").alias("recommendations")))


def safety_findings(df: DataFrame, predictions: DataFrame | None = None, importance: DataFrame | None = None,
                    privacy: bool = True, bias: bool = True) -> tuple[DataFrame, DataFrame]:
    """All findings on a table, and the status per check; bias is checked only where a model is given."""
    parts, checks, disabled = [privacy_check(df, enabled=privacy), data_quality(df)], ["privacy", "quality"], []
    if not privacy:
        disabled.append("privacy")
    if predictions is not None:
        parts.append(bias_check(importance, predictions, bias))
        checks.append("bias")
        if not bias:
            disabled.append("bias")
    findings = _union(parts)
    return findings, check_status(findings, checks, disabled)
