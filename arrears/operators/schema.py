"""Checks and projections that look at the schema only."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from arrears.constants import FORBIDDEN_COLUMNS, LEAKAGE_FRAGMENTS, PII_COLUMNS


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    return sorted(set(required) - set(df.columns))


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def enforce_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the named columns in one projection; what does not parse becomes null.

    Columns that have the type already pass through untouched, which keeps
    plans of stacked projections small.
    """
    require_columns(df, types)
    present = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return df.selectExpr(
        *[
            f"try_cast(`{c}` AS {types[c]}) AS `{c}`" if c in types and types[c] != present[c] else f"`{c}`"
            for c in df.columns
        ]
    )


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return enforce_types(df, {c: "double" for c in columns if c in df.columns})


def select_prefix(df: DataFrame, prefix: str, keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*keep, *[c for c in df.columns if c.startswith(prefix) and c not in keep])


def drop_pii(df: DataFrame, columns: Sequence[str] = tuple(PII_COLUMNS)) -> DataFrame:
    return df.drop(*columns)


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    if not frames:
        raise ValueError("no data frames to union")
    return reduce(DataFrame.unionByName, frames)


@dataclass(frozen=True)
class FeatureRoles:
    numeric: list[str]
    categorical: list[str]
    forbidden: list[str]
    suspicious: list[str]
    other: list[str]

    def rows(self) -> list[tuple[str, str]]:
        return [(c, role) for role, cols in vars(self).items() for c in cols]


def feature_roles(
    df: DataFrame,
    forbidden: Iterable[str] = tuple(FORBIDDEN_COLUMNS),
    fragments: Sequence[str] = tuple(LEAKAGE_FRAGMENTS),
) -> FeatureRoles:
    """Sort columns into model inputs and exclusions by name and type."""
    forbidden = set(forbidden)
    roles = FeatureRoles([], [], [], [], [])
    for field in df.schema.fields:
        if field.name in forbidden:
            roles.forbidden.append(field.name)
        elif any(fragment in field.name.lower() for fragment in fragments):
            roles.suspicious.append(field.name)
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType, T.IntegerType, T.LongType, T.ShortType)):
            roles.numeric.append(field.name)
        elif isinstance(field.dataType, T.StringType):
            roles.categorical.append(field.name)
        else:
            roles.other.append(field.name)
    if not roles.numeric and not roles.categorical:
        raise ValueError("no usable feature columns")
    return roles


def column_profile(df: DataFrame) -> DataFrame:
    """(column_name, data_type, non_null_rows) of a frame, counted in one pass."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = [
        f"named_struct('column_name', '{c}', 'data_type', '{kind}', 'non_null_rows', count(`{c}`))"
        for c, kind in kinds.items()
    ]
    return df.selectExpr(f"array({', '.join(rows)}) AS profile").selectExpr("inline(profile)")


def preview(df: DataFrame, n: int = 20, order_by: Sequence[str] = ()) -> DataFrame:
    return (df.orderBy(*order_by) if order_by else df).limit(n)
