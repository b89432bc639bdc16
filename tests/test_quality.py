import pytest
from pyspark.sql import functions as F

from tabfeat.fixed_values import RECOMMENDATIONS
from tabfeat.operators import quality
from tabfeat.operators.selection import fit_prune
from tabfeat.plans.models import Regressor
from tabfeat.spec import FeatureSpec


@pytest.fixture(scope="module")
def phones(spark):
    return spark.createDataFrame([("555-123-4567", 1), ("no", 2), (None, 3), ("a@b.c", 4)], "contact string, n int")


def items(df):
    return {(r["item"], r["value"]) for r in df.collect()}


def test_text_patterns(phones):
    assert items(quality.pii_phone(phones)) == {("contact", 1.0)}
    assert items(quality.pii_email(phones)) == {("contact", 1.0)}
    assert items(quality.pii_email(phones, mode="strict")) == set()
    masked = quality.mask_pii(phones, ["contact"], ["n"], "s").collect()
    assert masked[0]["contact"] == "[phone]" and len(masked[0]["n"]) == 64 and masked[2]["contact"] is None


def test_names(spark):
    df = spark.createDataFrame([(1, 2, 3, None)], "ZipCode int, price int, width int, email string")
    assert {i for i, _ in items(quality.pii_columns(df))} == {"ZipCode", "width", "email"}


@pytest.mark.parametrize("method", ["exact", "hash"])
def test_duplicate_rows_treat_missing_as_equal(spark, method):
    df = spark.createDataFrame([(1, None), (1, None), (1, "x"), (None, "x"), (None, "x"), (None, "x")], "a int, b string")
    assert items(quality.duplicate_rows(df, method=method)) == {("rows", 3.0)}
    assert quality.duplicate_rows(df.distinct(), method=method).count() == 0


def test_hashed_duplicates_are_exact_when_everything_collides(spark, monkeypatch):
    monkeypatch.setattr(quality, "_row_mark", lambda columns: F.pmod(F.xxhash64(*columns), F.lit(3)))
    rows = [(i % 40 if i < 100 else i, f"t{i % 40 if i < 100 else i}") for i in range(160)]
    df = spark.createDataFrame(rows, "`a.b` int, t string").repartition(5)
    assert items(quality.duplicate_rows(df, method="hash")) == {("rows", 60.0)}
    monkeypatch.setattr(quality, "_row_mark", lambda columns: F.lit(7))
    assert items(quality.duplicate_rows(df, method="hash")) == {("rows", 60.0)}
    assert quality.duplicate_rows(df.distinct(), method="hash").count() == 0


def test_column_checks_share_a_scan(spark, phones):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    read = phones.mapInArrow(counted, phones.schema)
    apart = quality.pii_columns(phones).union(quality.pii_email(phones)).union(quality.pii_phone(phones))
    assert sorted(quality.privacy_check(read).collect()) == sorted(apart.collect()) and seen.value == 4
    dotted = phones.withColumnsRenamed({"contact": "k.contact", "n": "k.n"})
    assert items(quality.privacy_check(dotted)) == {("k.contact", 1.0)}
    assert quality.constant_columns(dotted.where("`k.n` = 1")).count() == 2


def test_columns(spark):
    rows = [(1.0, None, 5.0, None if i < 6 else 1.0, 0.0 if i < 8 else 1e6 * i) for i in range(10)]
    df = spark.createDataFrame(rows, "one double, nothing double, five double, gaps double, tail double")
    assert items(quality.high_missing(df)) == {("nothing", 1.0), ("gaps", 0.6)}
    assert {i for i, _ in items(quality.constant_columns(df))} == {"one", "nothing", "five", "gaps"}
    assert items(quality.high_outliers(df)) == {("tail", 0.2)}
    assert quality.data_quality(df.limit(0)).where("check <> 'quality'").count() == 0


def test_status_and_report(spark, phones):
    findings, status = quality.safety_findings(phones)
    assert dict(status.select("check", "status").collect()) == {"privacy": "failed", "quality": "passed"}
    assert quality.safety_rollup(status).first()["overall_status"] == "failed"
    assert quality.recommendations(status).count() == len(RECOMMENDATIONS["privacy"])
    _, off = quality.safety_findings(phones.select("n"), privacy=False)
    assert dict(off.select("check", "status").collect()) == {"privacy": "disabled", "quality": "passed"}
    assert quality.safety_rollup(off).first()["overall_status"] == "passed"
    assert {r["recommendations"] for r in quality.safety_report(off).collect()} == {0}


def test_bias(spark):
    importance = spark.createDataFrame([("m", "a", 0.9), ("m", "b", 0.1), ("n", "a", 0.5), ("n", "b", 0.5)],
                                       "model string, feature string, importance double")
    assert items(quality.bias_importance(importance)) == {("m", 0.9), ("m", 0.4)}
    narrow = spark.createDataFrame([("m", 0.0, 5.0), ("m", 10.0, 5.5)], "model string, y double, pred double")
    assert items(quality.bias_pred_range(narrow)) == {("m", 0.05)}
    assert quality.bias_check(importance, narrow, enabled=False).count() == 0


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(float("nan") if i < 7 else float(i), i) for i in range(10)], "a double, i int")
    found = {(r["check"], r["message"]) for r in quality.data_quality(df, ["a"]).collect()}
    assert any("missing" in m for _, m in found) and not any("quartile" in m for _, m in found)


def test_importance_of_a_linear_model_is_in_shares(spark):
    rows = [(i, float(i % 7), float(i % 5), 200.0 * (i % 7) + 140.0 * (i % 5)) for i in range(200)]
    spec = FeatureSpec(("id",), ("a", "b"), "y")
    df = spark.createDataFrame(rows, "id int, a double, b double, y double")
    importance = Regressor("linear_regression").fit(df, spec).importance(df)
    assert importance.agg({"importance": "sum"}).first()[0] == pytest.approx(1)
    assert quality.bias_importance(importance).where("item like '%dominates%' or message like '%dominates%'").count() == 0


def test_ordering_columns_are_no_features(spark):
    df = spark.createDataFrame([(1, 2, 3.0, 4.0)], "id int, hour int, x double, y double")
    assert FeatureSpec.infer(df, ("id",), "y", order_by=("hour",)).features == ("x",)


def test_near_half_share_and_text_columns_are_pruned(spark):
    df = spark.createDataFrame([(i, 1.0 if i < 5004 else float(i), "a" if i < 9600 else "b", float(i)) for i in range(10000)],
                               "id int, x double, t string, z double")
    assert fit_prune(df, ["id"], ["x", "z"], 0.5002)[0].features == ("z",)
    assert fit_prune(df, ["id"], ["t", "z"], 0.95)[0].features == ("z",)
