"""Scalar expressions on hand-made values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from arrears.functions import clean, dates, measures
from arrears.operators import schema


def one(spark, expr, value, kind="string"):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(F.expr(expr) if isinstance(expr, str) else expr).first()[0]


@pytest.mark.parametrize(
    "text, number",
    [("12.5_", 12.5), ("_", None), ("", None), (None, None), ("-3", -3.0), ("--3", None), ("1.2.3", None), ("abc", None), ("1,234", 1234.0)],
)
def test_clean_numeric(spark, text, number):
    assert one(spark, clean.clean_numeric("x"), text) == number


@pytest.mark.parametrize("text, number", [("23_", 23), ("7.9", 7), ("-7.9", -7), ("99999999999", None), (None, None)])
def test_clean_integer_truncates(spark, text, number):
    assert one(spark, clean.clean_integer("x"), text) == number


@pytest.mark.parametrize(
    "text, months",
    [("22 Years and 1 Months", 265), ("1 Year and 0 Month", 12), ("5 Years", 60), ("7 Months", 7), ("NA", 0), (None, 0)],
)
def test_credit_history(spark, text, months):
    assert one(spark, clean.credit_history_months("x"), text) == months


def test_sentinels_and_blanks(spark):
    assert one(spark, clean.sentinel_to_null("x", "!@9#%8"), "!@9#%8") is None
    assert one(spark, clean.sentinel_to_null("x", "_"), "__") == "__"
    assert one(spark, clean.sentinel_to_null("x", "it's\\"), "it's\\") is None
    assert [one(spark, clean.non_blank_flag("x"), v) for v in ("a", "  ", "", None)] == [1, 0, 0, 0]


@pytest.mark.parametrize(
    "age, bucket",
    [(18, "18_24"), (24, "18_24"), (25, "25_34"), (34, "25_34"), (35, "35_49"), (49, "35_49"), (50, "50_plus"), (0, None), (-4, None), (None, None)],
)
def test_age_bucket(spark, age, bucket):
    assert one(spark, measures.age_bucket("x"), age, "int") == bucket


@pytest.mark.parametrize(
    "score, band",
    [(0.0, "00-20"), (0.2, "00-20"), (0.2000001, "20-40"), (0.8, "60-80"), (1.0, "80-100"), (1.01, None), (-0.01, None), (None, None)],
)
def test_score_band_is_right_closed(spark, score, band):
    assert one(spark, measures.score_band("x"), score, "double") == band


def test_ratios(spark):
    df = spark.createDataFrame([(3.0, 2.0), (3.0, 0.0), (None, 2.0), (0.0, 4.0)], "a double, b double")
    rows = df.selectExpr(f"{measures.safe_ratio('a', 'b')} AS r", f"{measures.ceil_ratio('a', 'b')} AS c").collect()
    assert [r["r"] for r in rows] == [1.5, None, None, 0.0]
    assert [r["c"] for r in rows] == [2, 0, 0, 0]


def test_row_statistics_and_nulls(spark):
    df = spark.createDataFrame([(1.0, None, 3.0), (None, None, None), (2.0, 4.0, 6.0)], "a double, b double, c double")
    cols = ["a", "b", "c"]
    rows = df.selectExpr(
        f"{measures.row_mean(cols)} AS m", f"{measures.row_mean(cols, skip_nulls=False)} AS strict",
        f"{measures.row_min(cols)} AS lo", f"{measures.row_max(cols)} AS hi",
    ).collect()
    assert [tuple(r) for r in rows] == [(2.0, None, 1.0, 3.0), (None, None, None, None), (4.0, 4.0, 2.0, 6.0)]


def test_sigmoid_and_log_odds_are_clipped(spark):
    assert one(spark, measures.sigmoid("x"), 0.0, "double") == 0.5
    assert one(spark, measures.sigmoid("x"), 1e6, "double") == pytest.approx(1.0)
    assert one(spark, measures.log_odds("x"), 0.0, "double") == pytest.approx(-9.21024, abs=1e-4)


def test_month_spine_snaps_to_first(spark):
    days = [r[0] for r in dates.month_spine(spark, "2023-11-17", "2024-02-01").collect()]
    assert days == [dt.date(2023, 11, 1), dt.date(2023, 12, 1), dt.date(2024, 1, 1), dt.date(2024, 2, 1)]
    assert dates.month_spine(spark, "2024-02-01", "2023-02-01").count() == 0


def test_month_filters_and_windows(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 31),), (dt.date(2024, 2, 29),), (dt.date(2024, 3, 1),)], "d date")
    day = F.lit("2024-02-10").cast("date")
    assert [r[0].month for r in df.filter(dates.in_month(F.col("d"), day)).collect()] == [2]
    assert df.filter(dates.up_to_month(F.col("d"), day)).count() == 2
    w = dates.ModelWindows.before(F.lit("2024-09-01").cast("date"))
    found = spark.range(1).select(w.train_test_start, w.train_test_end, w.oot_start, w.oot_end).first()
    assert [str(x) for x in found] == ["2023-07-01", "2024-06-30", "2024-07-01", "2024-08-31"]


def test_schema_checks(spark):
    df = spark.createDataFrame([("1", "x", "2024-01-01")], "a string, b string, d string")
    typed = schema.enforce_types(df, {"a": "int", "b": "double", "d": "date"}).first()
    assert tuple(typed) == (1, None, dt.date(2024, 1, 1))
    with pytest.raises(ValueError, match="label"):
        schema.require_columns(df, ["a", "label"])
    with pytest.raises(ValueError):
        schema.union_by_name([])
    assert schema.drop_pii(df, ["a", "SSN"]).columns == ["b", "d"]


def test_feature_roles_exclude_leaks(spark):
    df = spark.createDataFrame([], "loan_id string, label int, DPD_max int, Monthly_Balance double, Age int, Job string, d date")
    roles = schema.feature_roles(df)
    assert (roles.numeric, roles.categorical, roles.suspicious, roles.other) == (["Age"], ["Job"], ["DPD_max", "Monthly_Balance"], ["d"])
    assert "Monthly_Balance" in schema.feature_roles(df, fragments=["dpd"]).numeric
    with pytest.raises(ValueError):
        schema.feature_roles(df.select("loan_id", "label"))
