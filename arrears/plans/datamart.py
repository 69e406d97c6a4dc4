"""Bronze, silver and gold tables on storage, built for a whole date range at once."""

from __future__ import annotations

from calendar import monthrange
from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.constants import CUSTOMER, LABEL_DPD, LABEL_MOB, LABEL_SNAPSHOT, SNAPSHOT
from arrears.operators.schema import union_by_name
from arrears.plans import gold, silver
from arrears.plans.graph import Step, run_steps
from arrears.session import scan_bytes, settings
from arrears.sources.counts import rows_by_partition, stored_counts, write_counted
from arrears.sources.registry import SOURCES, with_snapshot_date
from arrears.sources.tables import (
    MOST_ROWS,
    PART,
    deals_evenly,
    dealt,
    overwrite_partitions,
    read_table,
    rebuild_table,
    snapshots_between,
    table_exists,
)

FEATURE_SOURCES = ("clickstream", "attributes", "financials")
GOLD_TABLES = {"feature_store": SNAPSHOT, "label_store": LABEL_SNAPSHOT, "training_dataset": LABEL_SNAPSHOT}
#: Shuffle files go when the table they were for is written, not when the driver happens to collect its garbage.
SETTINGS = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.parquet.compression.codec": "zstd"}
#: Bytes of files that a task reads at most: packed columns are some twenty times as much in rows, which a task sorts in memory to shuffle them.
SCAN_BYTES = 16 << 20


@dataclass(frozen=True)
class Datamart:
    """Paths of the tables below one root."""

    root: str

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def read(self, spark: SparkSession, layer: str, table: str) -> DataFrame:
        return read_table(spark, self.path(layer, table))

    def tables(self) -> list[tuple[str, str]]:
        return [(layer, s) for layer in ("bronze", "silver") for s in SOURCES] + [("gold", t) for t in GOLD_TABLES]


@dataclass(frozen=True)
class DateRange:
    """Closed range of snapshot dates; ``None`` is open."""

    start: str | None = None
    end: str | None = None

    @staticmethod
    def month(day: str) -> "DateRange":
        """The calendar month of ``day``."""
        d = date.fromisoformat(day)
        first = d.replace(day=1)
        return DateRange(first.isoformat(), d.replace(day=monthrange(d.year, d.month)[1]).isoformat())

    def shift_months(self, months: int) -> "DateRange":
        return DateRange(_shift(self.start, months), _shift(self.end, months))

    @property
    def is_open(self) -> bool:
        return self.start is None and self.end is None


def _shift(day: str | None, months: int) -> str | None:
    """Same day ``months`` away; the last day of a month stays a last day."""
    if day is None:
        return None
    d = date.fromisoformat(day)
    index = d.year * 12 + d.month - 1 + months
    year, month = index // 12, index % 12 + 1
    last = monthrange(year, month)[1]
    is_last = d.day == monthrange(d.year, d.month)[1]
    return date(year, month, last if is_last else min(d.day, last)).isoformat()


def _clip(df: DataFrame, days: DateRange, date_column: str = SNAPSHOT) -> DataFrame:
    return snapshots_between(df, days.start, days.end, date_column)


Writer = Callable[..., str]


@dataclass(frozen=True)
class Made:
    """Rows of a table, and whether they were dealt by its partitions already."""

    rows: DataFrame
    is_dealt: bool = False


def build_steps(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    mart: Datamart,
    feature_days: DateRange,
    label_days: DateRange,
    tie_break: Sequence[str] = (),
    dpd: int = LABEL_DPD,
    mob: int = LABEL_MOB,
) -> dict[str, Step]:
    """One step for each table, named layer.table; every table is counted as it is written."""
    write: Writer = rebuild_table if label_days.is_open else overwrite_partitions
    days = {s: label_days if s == "lms" else feature_days for s in raw}

    def step(layer: str, table: str, needs: Sequence[str], rows: Callable[[], DataFrame | Made], label: str | None = None, write: Writer = write) -> Step:
        by, range_ = GOLD_TABLES.get(table, SNAPSHOT), days.get(table, feature_days if table == "feature_store" else label_days)

        def run() -> str:
            made = rows()
            frame, writer = (made.rows, partial(write, is_dealt=made.is_dealt)) if isinstance(made, Made) else (made, write)
            return write_counted(writer, frame, mart.path(layer, table), [by], label, range_.start, range_.end)

        return Step(needs, run)

    def stored(layer: str, table: str, range_: DateRange) -> DataFrame:
        return _clip(mart.read(spark, layer, table), range_, GOLD_TABLES.get(table, SNAPSHOT))

    def rows_of(layer: str, table: str, range_: DateRange) -> dict[str, int]:
        return rows_by_partition(spark, mart.path(layer, table), range_.start, range_.end)

    def once_per_snapshot(name: str) -> Made:
        """Silver rows of a customer source; a key too frequent for one task is shuffled by itself, after a first choice where its rows are."""
        bronze, rows = stored("bronze", name, days[name]), rows_of("bronze", name, days[name])
        even = deals_evenly(bronze, rows, SNAPSHOT, [CUSTOMER])
        return Made(silver.BUILDERS[name](bronze, tie_break, rows if even else None), even)

    def features() -> Made:
        frames, rows = [stored("silver", s, feature_days) for s in FEATURE_SOURCES], Counter()
        for s in FEATURE_SOURCES:
            rows.update(rows_of("silver", s, feature_days))
        if not rows.total():
            return Made(gold.gold_features(*frames))
        # A customer is there once a snapshot, so tasks get as many rows as they should.
        return Made(gold.gold_features(*[dealt(f, rows, SNAPSHOT, [CUSTOMER]) for f in frames], keys=[SNAPSHOT, PART, CUSTOMER]), True)

    def labelled_features() -> Made:
        """The training set. Few labels may be sent to the features, and a customer of very many loans needs a join that divides them."""
        labels, known = stored("gold", "label_store", label_days), stored("gold", "feature_store", feature_days)
        rows = rows_of("gold", "feature_store", feature_days)
        many = sum(rows_of("gold", "label_store", label_days).values()) > MOST_ROWS
        if not many or not deals_evenly(labels, rows, "loan_start_date", [CUSTOMER]):
            return Made(gold.gold_training(labels, known))
        by_start, by_snapshot = dealt(labels, rows, "loan_start_date", [CUSTOMER]), dealt(known, rows, SNAPSHOT, [CUSTOMER])
        return Made(gold.gold_training(by_start, by_snapshot, [PART]), True)

    # Made row by row from a table whose partitions are the same months, so no rows need to move.
    in_place = partial(write, gathered=True)
    steps = {}
    for name, df in raw.items():
        steps[f"bronze.{name}"] = step("bronze", name, [], lambda df=df, name=name: _clip(with_snapshot_date(df), days[name]))
        if name == "lms":
            steps["silver.lms"] = step("silver", "lms", ["bronze.lms"], lambda: silver.silver_lms(stored("bronze", "lms", days["lms"])), write=in_place)
        else:
            steps[f"silver.{name}"] = step("silver", name, [f"bronze.{name}"], lambda name=name: once_per_snapshot(name))
    steps["gold.feature_store"] = step("gold", "feature_store", [f"silver.{s}" for s in FEATURE_SOURCES], features)
    steps["gold.label_store"] = step("gold", "label_store", ["silver.lms"], lambda: gold.gold_labels(stored("silver", "lms", label_days), dpd, mob), write=in_place)
    steps["gold.training_dataset"] = step(
        "gold",
        "training_dataset",
        ["gold.feature_store", "gold.label_store"],
        labelled_features,
        "label",
    )
    return steps


def backfill(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    mart: Datamart,
    start: str | None = None,
    end: str | None = None,
    tie_break: Sequence[str] = (),
    dpd: int = LABEL_DPD,
    mob: int = LABEL_MOB,
) -> Datamart:
    """Build every layer once for the label months ``start`` .. ``end``.

    The ledger is taken for those months, the customer sources for the months
    ``mob`` earlier, when the loans started. With both bounds open the mart is
    built from everything, replacing what was there. A second run over the
    same range gives the same tables, and other months are left alone. Tables
    that do not need each other are built at the same time; where a source
    fails, the tables that do without it are built all the same.
    """
    label_days = DateRange(start, end)
    with settings(spark, SETTINGS), scan_bytes(spark, SCAN_BYTES):
        run_steps(spark, build_steps(spark, raw, mart, label_days.shift_months(-mob), label_days, tie_break, dpd, mob))
    return mart


def run_month(
    spark: SparkSession, raw: Mapping[str, DataFrame], mart: Datamart, execution_date: str, **options
) -> Datamart:
    """One scheduled month: the labels of that month and the features that go with them."""
    month = DateRange.month(execution_date)
    return backfill(spark, raw, mart, month.start, month.end, **options)


def table_counts(tables: Mapping[tuple[str, str], DataFrame]) -> DataFrame:
    """(layer, table_name, row_count), one row per table; an empty table counts zero."""
    return union_by_name(
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count"
            )
            for (layer, name), df in tables.items()
        ]
    )


def summary(tables: Mapping[tuple[str, str], DataFrame], training: DataFrame) -> DataFrame:
    """Row counts of all tables and the label distribution of the training set."""
    labels = training.groupBy("label").agg(F.count(F.lit(1)).alias("row_count"))
    return table_counts(tables).unionByName(
        labels.select(
            F.lit("label_distribution").alias("layer"), F.col("label").cast("string").alias("table_name"), "row_count"
        )
    )


def mart_summary(spark: SparkSession, mart: Datamart) -> DataFrame:
    """Summary of the tables on storage, from the counts stored as they were written; tables not built yet are left out.

    A table that was written without counts is counted now.
    """
    training = ("gold", "training_dataset")
    stored = {t: stored_counts(spark, mart.path(*t)) for t in mart.tables() if table_exists(spark, mart.path(*t))}
    if training not in stored:
        raise FileNotFoundError(f"{mart.path(*training)} has not been built")
    parts = [c.select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count") for (layer, name), c in stored.items() if c is not None]
    uncounted = {t: mart.read(spark, *t) for t, c in stored.items() if c is None}
    labels = stored[training]
    if labels is None:
        labels = uncounted[training].groupBy(F.col("label").cast("string").alias("label")).agg(F.count(F.lit(1)).alias("row_count"))
    parts.append(labels.select(F.lit("label_distribution").alias("layer"), F.col("label").alias("table_name"), "row_count"))
    if uncounted:
        parts.append(table_counts(uncounted))
    summed = union_by_name(parts).groupBy("layer", "table_name").agg(F.sum("row_count").alias("row_count"))
    # A table that was written empty has no partition to count.
    empty = [t for t, c in stored.items() if c is not None]
    present = spark.createDataFrame(empty or [training], "layer string, table_name string")
    missing = present.join(summed, ["layer", "table_name"], "left_anti").withColumn("row_count", F.lit(0).cast("bigint"))
    return summed.unionByName(missing)
