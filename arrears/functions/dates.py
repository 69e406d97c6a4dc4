"""Calendar arithmetic: month labels, month spine, model windows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def month_start(c: Column) -> Column:
    return F.trunc(c, "MM")


def month_label(c: Column) -> Column:
    """``2024-06``"""
    return F.date_format(c, "yyyy-MM")


def date_token(c: Column) -> Column:
    """``2024_06_01``, as used in partition and model names."""
    return F.date_format(c, "yyyy_MM_dd")


def in_month(c: Column, day: Column) -> Column:
    """True within the calendar month of ``day``.

    Written as a range on the bare column so that it prunes partitions and
    reaches the scan.
    """
    first = month_start(day)
    return (c >= first) & (c < F.add_months(first, 1))


def before(column: Column, day: Column) -> Column:
    """Strictly earlier than a day; null is not."""
    return column < day


def up_to_month(c: Column, day: Column) -> Column:
    return c < F.add_months(month_start(day), 1)


def month_sequence(start: Column, end: Column) -> Column:
    """Firsts of month from the month of ``start`` up to ``end`` inclusive."""
    first = month_start(start)
    return F.when(
        end >= first, F.sequence(first, end.cast("date"), F.expr("interval 1 month"))
    ).otherwise(F.array().cast("array<date>"))


def month_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    return spark.range(1).select(F.explode(month_sequence(first, last)).alias("month_start"))


def is_whole_months_apart(later: Column, earlier: Column, months: int) -> Column:
    return F.months_between(later, earlier) == F.lit(float(months))


@dataclass(frozen=True)
class ModelWindows:
    """Training, test and out-of-time windows before a training date."""

    train_test_start: Column
    train_test_end: Column
    oot_start: Column
    oot_end: Column

    @staticmethod
    def before(day: Column, train_test_months: int = 12, oot_months: int = 2) -> "ModelWindows":
        oot_start = F.add_months(day, -oot_months)
        return ModelWindows(
            train_test_start=F.add_months(oot_start, -train_test_months),
            train_test_end=F.date_sub(oot_start, 1),
            oot_start=oot_start,
            oot_end=F.date_sub(day, 1),
        )
