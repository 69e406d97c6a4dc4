"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in an order that depends on the rows alone.

    A ``row_number() = 1`` filter is planned with a group limit on both sides
    of the shuffle: every task keeps one row per key before rows move, so a
    key with a third of all rows costs its reducer one row per task.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def _content(df: DataFrame, used: Sequence[str]) -> list[Column]:
    """A hash of all other columns, so that equal tie-break values still give one answer."""
    rest = [f.name for f in df.schema.fields if f.name not in used and f.dataType.typeName() not in ("map", "variant")]
    return [F.expr(f"xxhash64({', '.join(f'`{c}`' for c in rest)})")] if rest else []


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """Smallest ``order_by`` wins; among equals the content of the row decides, not its position."""
    order = [F.col(c).asc_nulls_last() for c in order_by]
    return _first_per_key(df, keys, order + _content(df, [*keys, *order_by]))


def keep_last(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Largest ``order_by`` wins."""
    order = [F.col(c).desc_nulls_last() for c in order_by]
    return _first_per_key(df, keys, order + _content(df, [*keys, *order_by]))
