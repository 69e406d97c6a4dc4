"""Aggregates over labels, predictions and training rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears.constants import FORBIDDEN_COLUMNS, LABEL_DPD, LABEL_SNAPSHOT, LEAKAGE_FRAGMENTS
from arrears.functions.dates import is_whole_months_apart, month_label
from arrears.operators.schema import FeatureRoles, feature_roles, require_columns


def label_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("row_count"))


def class_guard(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows, classes and whether a model can be fitted, in one pass."""
    rows, classes = F.count(F.lit(1)), F.countDistinct(label)
    return df.agg(
        rows.alias("row_count"), classes.alias("class_count"), ((rows > 0) & (classes >= 2)).alias("is_usable")
    )


def bad_rate_by_mob(ledger: DataFrame, dpd: int = LABEL_DPD, mob: str = "mob") -> DataFrame:
    """Share of ledger rows at or above ``dpd`` days past due, per month on book."""
    flag = F.when(F.col("dpd") >= dpd, 1).otherwise(0)
    return ledger.groupBy(mob).agg(F.avg(flag).alias("bad_rate")).orderBy(mob)


def prediction_summary(predictions: DataFrame) -> DataFrame:
    return predictions.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.countDistinct(LABEL_SNAPSHOT).alias("prediction_months"),
        F.avg("prediction_score").alias("average_score"),
        F.avg("prediction").alias("predicted_default_rate"),
    )


def monthly_rates(predictions: DataFrame) -> DataFrame:
    """Rows, observed and predicted default rate, average score and accuracy per label month."""
    hit = (F.col("label").cast("int") == F.col("prediction").cast("int")).cast("double")
    return (
        predictions.withColumn("label_month", month_label(F.col(LABEL_SNAPSHOT)))
        .groupBy("label_month")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.avg("label").alias("observed_default_rate"),
            F.avg("prediction").alias("predicted_default_rate"),
            F.avg("prediction_score").alias("average_score"),
            F.avg(hit).alias("accuracy"),
        )
    )


def temporal_mismatches(
    df: DataFrame, months: int = 6, label_date: str = LABEL_SNAPSHOT, start_date: str = "loan_start_date"
) -> DataFrame:
    """Rows whose label date is not exactly ``months`` after the loan start."""
    return df.filter(~is_whole_months_apart(F.col(label_date), F.col(start_date), months))


def leakage_counts(df: DataFrame, months: int = 6, label_date: str = LABEL_SNAPSHOT) -> DataFrame:
    """One row: ``row_count`` and ``mismatch_rows``, after checking the required columns."""
    require_columns(df, ["label", label_date, "loan_start_date"])
    apart = is_whole_months_apart(F.col(label_date), F.col("loan_start_date"), months)
    return df.agg(
        F.count(F.lit(1)).alias("row_count"), F.count(F.when(~apart, 1)).alias("mismatch_rows")
    )


def check_leakage(df: DataFrame, months: int = 6, label_date: str = LABEL_SNAPSHOT) -> int:
    """Raise unless every label lies exactly ``months`` after the loan start; returns the rows checked."""
    found = leakage_counts(df, months, label_date).first()
    if found["mismatch_rows"]:
        raise ValueError(f"{found['mismatch_rows']} labels are not exactly {months} months after the loan start")
    return found["row_count"]


def leakage_report(
    df: DataFrame, roles: FeatureRoles, months: int = 6, label_date: str = LABEL_SNAPSHOT
) -> DataFrame:
    """(check_name, status, detail) for the checks made before training.

    Each status follows from the rows and from the columns that are used: a
    forbidden name or a leakage fragment among them fails, as does an empty
    frame, a misplaced label date, or a kind of feature of which there is none
    although the frame has such columns.
    """

    def listed(names: list[str]) -> str:
        return ", ".join(names) if names else "none"

    def passed(good) -> Column:
        return F.when(good if isinstance(good, Column) else F.lit(good), "PASS").otherwise("FAIL")

    used = [*roles.numeric, *roles.categorical]
    banned = [c for c in used if c in FORBIDDEN_COLUMNS]
    leaking = [c for c in used if any(fragment in c.lower() for fragment in LEAKAGE_FRAGMENTS)]
    offered = feature_roles(df)
    checks = [
        ("rows_loaded", passed(F.col("row_count") > 0), F.col("row_count").cast("string")),
        ("temporal_alignment", passed(F.col("mismatch_rows") == 0), F.col("mismatch_rows").cast("string")),
        ("forbidden_columns_excluded", passed(not banned), F.lit(listed(banned or sorted(roles.forbidden)))),
        ("leakage_patterns_excluded", passed(not leaking), F.lit(listed(leaking or sorted(roles.suspicious)))),
        ("numeric_features_used", passed(bool(roles.numeric) or not offered.numeric), F.lit(listed(roles.numeric))),
        ("categorical_features_used", passed(bool(roles.categorical) or not offered.categorical), F.lit(listed(roles.categorical))),
    ]
    rows = F.array(
        *[F.struct(F.lit(n).alias("check_name"), s.alias("status"), d.alias("detail")) for n, s, d in checks]
    )
    return leakage_counts(df, months, label_date).select(F.inline(rows))
