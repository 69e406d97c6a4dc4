"""Joins of labels with features, and of features with each other."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.constants import CUSTOMER, FEATURE_SNAPSHOT, LABEL_SNAPSHOT, SNAPSHOT


def join_snapshots(frames: Sequence[DataFrame], keys: Sequence[str] = (CUSTOMER, SNAPSHOT)) -> DataFrame:
    """Inner join of frames that are all unique on the same key.

    Every join uses the same key, so each side is partitioned once and the
    partitioning of the first join serves the next.
    """
    first, *rest = frames
    for other in rest:
        first = first.join(other, list(keys), "inner")
    return first


def join_point_in_time(labels: DataFrame, features: DataFrame, dealt_by: Sequence[str] = ()) -> DataFrame:
    """Labels with the features known on the day the loan started.

    A customer with very many loans is a skewed key of a plain join, which
    adaptive execution splits. ``features`` is unique on (customer, snapshot). The day of the features
    stays in the result as ``feature_snapshot_date``. ``dealt_by`` are columns of
    both sides that follow from customer and day and say where rows lie; they
    join as well and are dropped.
    """
    as_of = features.withColumnRenamed(SNAPSHOT, "loan_start_date")
    joined = labels.join(as_of, [CUSTOMER, "loan_start_date", *dealt_by])
    label_columns = [c for c in labels.columns if c not in dealt_by]
    feature_columns = [c for c in features.columns if c not in (CUSTOMER, SNAPSHOT, *dealt_by)]
    return joined.select(*label_columns, F.col("loan_start_date").alias(FEATURE_SNAPSHOT), *feature_columns)


def join_label_month(labels: DataFrame, features: DataFrame) -> DataFrame:
    """Labels with the features of the label month; labels without any keep nulls."""
    same_month = features.withColumnRenamed(SNAPSHOT, LABEL_SNAPSHOT)
    joined = labels.join(same_month, [CUSTOMER, LABEL_SNAPSHOT], "left")
    feature_columns = [c for c in features.columns if c not in (CUSTOMER, SNAPSHOT)]
    return joined.select(*labels.columns, *feature_columns)
