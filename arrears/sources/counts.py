"""Row counts of partitioned tables, stored beside them when they are written."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.sources.tables import read_table, snapshots_between, table_exists, write_small

#: Folder inside a table; names that begin so are no data to Spark.
COUNTS = "_counts"
SCHEMA = "partition string, label string, row_count bigint"


def write_counted(
    write: Callable[..., str], df: DataFrame, path: str, by: Sequence[str], label: str | None = None, start: str | None = None, end: str | None = None
) -> str:
    """``write(df, path, by)``, then bring the stored counts up to date.

    ``start`` and ``end`` are the dates between which the write may replace
    partitions, None being open. Only those partitions are counted again, from
    the metadata of their files or, with ``label``, from that column; the counts
    of others stay as they are. One row for each partition (and label) comes to
    the driver.
    """
    spark, column = df.sparkSession, by[0]
    write(df, path, list(by))
    untouched = [r for r in _stored(spark, path) if (start is not None and r["partition"] < start) or (end is not None and r["partition"] > end)]
    fresh: list = []
    if table_exists(spark, path):
        inside = snapshots_between(read_table(spark, path), start, end, column)
        named = F.col(label).cast("string") if label else F.lit(None).cast("string")
        fresh = inside.groupBy(F.col(column).cast("string").alias("partition"), named.alias("label")).agg(F.count(F.lit(1)).alias("row_count")).collect()
    lines = spark.createDataFrame([tuple(r) for r in (*untouched, *fresh)], SCHEMA)
    write_small(lines, f"{path}/{COUNTS}", "json")
    return path


def _stored(spark: SparkSession, path: str) -> list:
    counts = stored_counts(spark, path)
    return counts.collect() if counts is not None else []


def rows_by_partition(spark: SparkSession, path: str, start: str | None = None, end: str | None = None) -> dict[str, int]:
    """Rows of the partitions between two dates by the stored counts; none for a table without."""
    found: dict[str, int] = {}
    for r in _stored(spark, path):
        if (start is None or r["partition"] >= start) and (end is None or r["partition"] <= end):
            found[r["partition"]] = found.get(r["partition"], 0) + r["row_count"]
    return found


def stored_counts(spark: SparkSession, path: str) -> DataFrame | None:
    """(partition, label, row_count) as the last counted write left them, None for a table without."""
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{COUNTS}")
    if not location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(location):
        return None
    return spark.read.schema(SCHEMA).json(f"{path}/{COUNTS}")
