"""Append new rows to a keyed table, keep the last row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.constants import LABEL_SNAPSHOT, LOAN
from arrears.operators.dedup import keep_last
from arrears.session import drop_path, scratch_path
from arrears.sources.tables import overwrite_partitions, read_table, rebuild_table, table_exists
from arrears.sources.versions import commit_version, last_commit, new_version, plain_partitions, read_commit


def merge_keep_last(
    existing: DataFrame, new: DataFrame, keys: Sequence[str] = (LOAN, LABEL_SNAPSHOT), order_by: Sequence[str] = ()
) -> DataFrame:
    """Rows of both; for a key in both the new row wins, within one side the last by ``order_by``."""
    both = existing.withColumn("_run", F.lit(0)).unionByName(new.withColumn("_run", F.lit(1)))
    return keep_last(both, keys, ["_run", *order_by]).drop("_run")


def upsert_table(
    new: DataFrame,
    path: str,
    keys: Sequence[str] = (LOAN, LABEL_SNAPSHOT),
    by: str = LABEL_SNAPSHOT,
    order_by: Sequence[str] = (),
) -> str:
    """Merge ``new`` into a table partitioned by ``by``, rewriting only the partitions it touches.

    ``by`` has to be one of the keys. ``new`` is worked out once, and the merged
    rows are staged in the shared folder before partitions are replaced, as a
    table cannot be read and overwritten by one job; both stages are deleted
    afterwards. A failure leaves the table as it was or partly replaced by
    complete partitions, and running again gives the same result. A table that
    keeps versions gets a new one, see ``upsert_versioned``.
    """
    _check_keys(keys, by)
    spark = new.sparkSession
    if last_commit(spark, path) is not None:
        return upsert_versioned(new, path, keys, by, order_by)
    if not table_exists(spark, path):
        return overwrite_partitions(keep_last(new, keys, order_by), path, [by])
    arrived, staged = scratch_path(spark, "upsert_new"), scratch_path(spark, "upsert_merged")
    new.write.parquet(arrived)
    new = spark.read.schema(new.schema).parquet(arrived)
    current = read_table(spark, path).select(*new.columns).join(new.select(by).distinct(), by, "left_semi")
    merged = merge_keep_last(current, new, keys, order_by)
    merged.write.parquet(staged)
    overwrite_partitions(spark.read.schema(merged.schema).parquet(staged), path, [by])
    for folder in (arrived, staged):
        drop_path(spark, folder)
    return path


def upsert_versioned(
    new: DataFrame,
    path: str,
    keys: Sequence[str] = (LOAN, LABEL_SNAPSHOT),
    by: str = LABEL_SNAPSHOT,
    order_by: Sequence[str] = (),
) -> str:
    """Merge ``new`` into a table partitioned by ``by`` as one new version, of which readers see all or nothing.

    Only the partitions ``new`` touches are written; nothing is overwritten, so
    the merge reads the table and writes the version in one job. A failure
    leaves the table as it was. Where another writer commits meanwhile,
    ``CommitConflict`` is raised and the call may be repeated. A plain table
    becomes one with versions, its untouched partitions stay in place. Read it
    by ``read_table``; ``drop_old_versions`` deletes what is no longer needed.
    """
    _check_keys(keys, by)
    spark = new.sparkSession
    before = last_commit(spark, path) or plain_partitions(spark, path)
    version, folder = new_version(path)
    arrived = scratch_path(spark, "upsert_new")
    try:
        current = read_commit(spark, path, before)
        if current is None:
            rows = keep_last(new, keys, order_by)
        else:
            new.write.parquet(arrived)
            new = spark.read.schema(new.schema).parquet(arrived)
            touched = current.select(*new.columns).join(new.select(by).distinct(), by, "left_semi")
            rows = merge_keep_last(touched, new, keys, order_by)
        rebuild_table(rows, folder, [by])
        commit_version(spark, path, version, before)
    except BaseException:
        drop_path(spark, folder)
        raise
    finally:
        drop_path(spark, arrived)
    return path


def _check_keys(keys: Sequence[str], by: str) -> None:
    if by not in keys:
        raise ValueError(f"the partition column {by} has to be one of the keys {list(keys)}")
