"""SQL expressions for row-wise arithmetic, buckets and bands."""

from __future__ import annotations

from collections.abc import Sequence

from arrears.constants import SCORE_BAND_FLOOR, SCORE_BANDS


def safe_ratio(num: str, den: str) -> str:
    """Quotient; null where the denominator is zero or null."""
    return f"try_divide({num}, {den})"


def ceil_ratio(num: str, den: str) -> str:
    """Quotient rounded up to an integer; zero where it is undefined."""
    return f"coalesce(try_cast(ceil(try_divide({num}, {den})) AS int), 0)"


def row_mean(columns: Sequence[str], skip_nulls: bool = True) -> str:
    """Mean over the present values of a row, or null unless all are present."""
    if not skip_nulls:
        return f"(({' + '.join(columns)}) / {len(columns)}D)"
    total = " + ".join(f"coalesce({c}, 0D)" for c in columns)
    present = " + ".join(f"if({c} IS NULL, 0, 1)" for c in columns)
    return f"try_divide({total}, {present})"


def row_min(columns: Sequence[str]) -> str:
    return f"least({', '.join(columns)})"


def row_max(columns: Sequence[str]) -> str:
    return f"greatest({', '.join(columns)})"


def age_bucket(age: str) -> str:
    """18_24, 25_34, 35_49, 50_plus; null for a missing or non-positive age."""
    return (
        f"CASE WHEN {age} <= 0 THEN NULL WHEN {age} < 25 THEN '18_24' WHEN {age} < 35 THEN '25_34' "
        f"WHEN {age} < 50 THEN '35_49' WHEN {age} >= 50 THEN '50_plus' END"
    )


def score_band(score: str) -> str:
    """Right-closed fifths of the unit interval; null outside it."""
    bands = " ".join(f"WHEN {score} <= {upper!r}D THEN '{name}'" for upper, name in SCORE_BANDS)
    return f"CASE WHEN {score} <= {SCORE_BAND_FLOOR!r}D THEN NULL {bands} END"


def to_class(score: str, threshold: float = 0.5) -> str:
    return f"cast({score} >= {threshold!r}D AS int)"


def gini(auc: str, digits: int | None = None) -> str:
    value = f"({auc} * 2 - 1)"
    return value if digits is None else f"round({value}, {digits})"


def sigmoid(logit: str, clip: float = 30.0) -> str:
    return f"(1D / (1D + exp(-greatest({-clip!r}D, least({clip!r}D, {logit})))))"


def log_odds(rate: str, clip: float = 1e-4) -> str:
    bounded = f"greatest({clip!r}D, least({1 - clip!r}D, {rate}))"
    return f"ln({bounded} / (1D - {bounded}))"
