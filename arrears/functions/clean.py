"""SQL expressions that turn raw text into typed values.

Each function takes a SQL expression, usually a column name, and returns one,
for ``selectExpr`` and ``expr``: a projection of dozens of columns is then one
call. All casts are ``try_cast``, so a value that does not parse becomes null
whether or not ANSI mode is on.
"""

from __future__ import annotations

# Fixed patterns.
NOT_NUMERIC = r"[^0-9.\-]"
YEARS = r"(\d+)\s+Years?"
MONTHS = r"(\d+)\s+Months?"


def quoted(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def numeric(c: str) -> str:
    return f"try_cast({c} AS double)"


def clean_numeric(c: str) -> str:
    return numeric(f"regexp_replace(cast({c} AS string), r'{NOT_NUMERIC}', '')")


def clean_integer(c: str) -> str:
    """Numeric cleaning, then truncation towards zero."""
    return f"try_cast({clean_numeric(c)} AS int)"


def credit_history_months(c: str) -> str:
    """``22 Years and 1 Months`` -> 265; a missing part counts as zero."""

    def part(pattern: str) -> str:
        return f"coalesce(try_cast(regexp_extract(cast({c} AS string), r'{pattern}', 1) AS int), 0)"

    return f"({part(YEARS)} * 12 + {part(MONTHS)})"


def sentinel_to_null(c: str, sentinel: str) -> str:
    return f"nullif({c}, {quoted(sentinel)})"


def non_blank_flag(c: str) -> str:
    return f"CASE WHEN length(trim({c})) > 0 THEN 1 ELSE 0 END"
