"""Silver frames to feature store, label store and training set."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from arrears.constants import (
    CLICK_COLUMNS,
    CUSTOMER,
    FEATURE_STORE_COLUMNS,
    FEATURE_STORE_VERSION,
    LABEL_DPD,
    LABEL_MOB,
    LABEL_SNAPSHOT,
    NUMERIC_FEATURES,
    SNAPSHOT,
)
from arrears.functions import measures
from arrears.operators.joins import join_point_in_time, join_snapshots
from arrears.operators.schema import coerce_numeric, drop_pii


def gold_features(clickstream: DataFrame, attributes: DataFrame, financials: DataFrame, keys: Sequence[str] = (CUSTOMER, SNAPSHOT)) -> DataFrame:
    """Customer-month feature store: three sources joined, ratios and buckets added."""
    derived = {
        "feature_store_def": f"'{FEATURE_STORE_VERSION}'",
        "age_bucket": measures.age_bucket("Age"),
        "debt_to_income_ratio": measures.safe_ratio("Outstanding_Debt", "Annual_Income"),
        "emi_to_salary_ratio": measures.safe_ratio("Total_EMI_per_month", "Monthly_Inhand_Salary"),
        "available_cash_after_emi": "Monthly_Inhand_Salary - Total_EMI_per_month",
        "clickstream_mean": measures.row_mean(CLICK_COLUMNS),
        "clickstream_min": measures.row_min(CLICK_COLUMNS),
        "clickstream_max": measures.row_max(CLICK_COLUMNS),
    }
    joined = join_snapshots([clickstream, attributes, financials], keys)
    return joined.selectExpr(*[f"{derived[c]} AS {c}" if c in derived else c for c in FEATURE_STORE_COLUMNS])


def at_month_on_book(ledger: DataFrame, mob: int) -> DataFrame:
    return ledger.filter(f"mob = {int(mob)}")


def gold_labels(ledger: DataFrame, dpd: int = LABEL_DPD, mob: int = LABEL_MOB) -> DataFrame:
    """Default flag of every loan at one month on book."""
    return at_month_on_book(ledger, mob).selectExpr(
        "loan_id",
        "Customer_ID",
        "loan_start_date",
        f"CASE WHEN dpd >= {int(dpd)} THEN 1 ELSE 0 END AS label",
        f"'{int(dpd)}dpd_{int(mob)}mob' AS label_def",
        f"{SNAPSHOT} AS {LABEL_SNAPSHOT}",
    )


def gold_training(labels: DataFrame, features: DataFrame, dealt_by: Sequence[str] = ()) -> DataFrame:
    """Labels with the features of the loan start date."""
    return coerce_numeric(drop_pii(join_point_in_time(labels, features, dealt_by)), NUMERIC_FEATURES)
