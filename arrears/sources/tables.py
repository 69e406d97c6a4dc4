"""Date-partitioned Parquet tables: read whole or by snapshot, overwrite by partition, rebuild."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.constants import SNAPSHOT
from arrears.sources.registry import with_snapshot_date
from arrears.sources.versions import last_commit, read_commit

#: Column of ``dealt`` rows, rows that a task should get, and how many it may get by chance or by a frequent key.
PART, ROWS_A_TASK, MOST_ROWS = "_part", 250_000, 1_000_000


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Every partition of a table; of one that keeps versions, as the last commit names them."""
    if not isinstance(path, str):
        raise TypeError(f"table path must be a string, got {type(path).__name__}")
    commit = last_commit(spark, path)
    if commit is not None:
        rows = read_commit(spark, path, commit)
        if rows is None:
            raise FileNotFoundError(f"{path} has no partition yet")
        return rows
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise FileNotFoundError(f"{path} has not been built") from error
        raise


def table_exists(spark: SparkSession, path: str) -> bool:
    """True once a table holds data files; an empty folder does not count."""
    try:
        read_table(spark, path)
        return True
    except FileNotFoundError:
        return False


def read_snapshot(spark: SparkSession, path: str, day: str, date_column: str = SNAPSHOT) -> DataFrame:
    """One snapshot; the filter is on the partition column, so only its files are listed."""
    return read_table(spark, path).filter(F.col(date_column) == F.lit(day).cast("date"))


def _partitioned(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Bring the rows of a partition together without tying it to one task.

    A rebalance lets adaptive execution merge small partitions and split big
    ones, so a month with a third of all rows is written by many tasks and a
    small month by one.
    """
    return df.hint("rebalance", *by)


def _deal(spark: SparkSession, rows: Mapping[str, int], by: str, keys: Sequence[str]) -> tuple[int, Column]:
    """Number of tasks, and the task of a row: tasks take partitions in their order and divide them by a hash of ``keys``."""
    total = max(sum(rows.values()), 1)
    tasks = max(-(-total // ROWS_A_TASK), min(spark.sparkContext.defaultParallelism, -(-total * 10 // ROWS_A_TASK)))
    below, places = 0, []
    for day, n in sorted(rows.items()):
        places += [F.lit(day).cast("date"), F.struct(F.lit(below).cast("bigint").alias("below"), F.lit(n).cast("bigint").alias("n"))]
        below += n
    place = F.create_map(*places)[F.col(f"`{by}`")]
    chance = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in keys]), F.lit(1 << 20))
    row = place["below"] + F.shiftright(chance * place["n"], 20)
    return tasks, F.coalesce(F.floor(row / F.lit(-(-total // tasks))).cast("int"), F.lit(0))


def dealt(df: DataFrame, rows: Mapping[str, int], by: str, keys: Sequence[str]) -> DataFrame:
    """Rows brought to the task that ``PART`` names, a new column that follows from ``by`` and ``keys``.

    Rows that agree in them come to one task, and a task gets neighbouring
    partitions, so what groups or joins by ``by``, ``PART`` and ``keys`` can be
    written without moving rows again. ``rows`` are the rows of each partition,
    for which an estimate will do: they say how partitions are divided.
    """
    tasks, part = _deal(df.sparkSession, rows, by, keys)
    return df.withColumn(PART, part).repartitionById(tasks, F.col(PART))


def deals_evenly(df: DataFrame, rows: Mapping[str, int], by: str, keys: Sequence[str]) -> bool:
    """Whether ``dealt`` gives no task too many rows, as a very frequent key would; counts ``df`` once."""
    if not sum(rows.values()):
        return False
    parts = df.groupBy(_deal(df.sparkSession, rows, by, keys)[1].alias(PART)).agg(F.count(F.lit(1)).alias("n"))
    return (parts.agg(F.max("n")).first()[0] or 0) <= MOST_ROWS


def overwrite_partitions(df: DataFrame, path: str, by: Sequence[str] = (SNAPSHOT,), gathered: bool = False, is_dealt: bool = False) -> str:
    """Replace the partitions present in ``df``, leave all others alone.

    Rows without a date belong to no snapshot and are left out. A table that
    keeps versions is refused, since its readers would not see the change.
    ``gathered`` says that the tasks of ``df`` hold few partitions each, as those
    that scan a table of the same partitions do; its rows are then not moved.
    Nor are those of which ``is_dealt`` says that they were ``dealt``.
    """
    by = list(by)
    if last_commit(df.sparkSession, path) is not None:
        raise ValueError(f"{path} keeps versions; change it by upsert_versioned, or rebuild it")
    dated = df.dropna(subset=by)
    (
        (dated if gathered or is_dealt else _partitioned(dated, by))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )
    return path


def rebuild_table(df: DataFrame, path: str, by: Sequence[str] = (SNAPSHOT,), gathered: bool = False, is_dealt: bool = False) -> str:
    """Clear the target, then write; ``gathered`` and ``is_dealt`` as in ``overwrite_partitions``."""
    by = list(by)
    dated = df.dropna(subset=by)
    (
        (dated if gathered or is_dealt else _partitioned(dated, by))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*by)
        .parquet(path)
    )
    return path


def write_small(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """One-file report table: metrics, leaderboards, summaries of a few rows."""
    # Merging partitions keeps their order, so a sorted report stays sorted in its one file.
    writer = df.coalesce(1).write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
    return path


def snapshots_between(df: DataFrame, start: str | None, end: str | None, date_column: str = SNAPSHOT) -> DataFrame:
    """Closed date range; either bound may be open."""
    if start is not None:
        df = df.filter(F.col(date_column) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(F.col(date_column) <= F.lit(end).cast("date"))
    return df


def ingest_snapshots(raw: DataFrame, path: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Raw rows of a date range into a bronze table, all months in one scan; returns the range read back."""
    dated = snapshots_between(with_snapshot_date(raw), start, end)
    overwrite_partitions(dated, path)
    return snapshots_between(raw.sparkSession.read.schema(dated.schema).parquet(path), start, end)
