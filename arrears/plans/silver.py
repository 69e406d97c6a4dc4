"""Bronze text to typed, de-duplicated silver frames. One projection per source."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame

from arrears.constants import (
    CLICK_COLUMNS,
    CUSTOMER,
    FINANCIAL_DOUBLES,
    FINANCIAL_INTEGERS,
    LEDGER_TYPES,
    SENTINELS,
    SNAPSHOT,
)
from arrears.functions import clean, measures
from arrears.operators.dedup import keep_first
from arrears.operators.schema import enforce_types
from arrears.sources.tables import PART, dealt

KEYS = [CUSTOMER, SNAPSHOT]


def _once_per_snapshot(bronze: DataFrame, columns: dict[str, str], tie_break: Sequence[str], rows: Mapping[str, int] | None = None) -> DataFrame:
    """Clean in one projection, keep one row per customer and snapshot, drop the tie-break columns.

    With ``rows``, the rows of each snapshot, the result is dealt by snapshot:
    equal rows come together in the tasks that can write them. No key may then
    have more rows than a task can sort.

    Cleaning comes first so that the narrow typed values are what is shuffled,
    and so that the window ends the chain of constraints the optimizer infers
    from the cleaning expressions; above it they make planning of the joins
    take minutes.
    """
    columns = {CUSTOMER: f"cast({CUSTOMER} AS string)", SNAPSHOT: f"try_cast({SNAPSHOT} AS date)"} | columns
    extra = [f"{c} AS _tie_{c}" for c in tie_break]
    cleaned = bronze.selectExpr(*[f"{expr} AS {name}" for name, expr in columns.items()], *extra)
    ties = [f"_tie_{c}" for c in tie_break]
    if not rows:
        return keep_first(cleaned, KEYS, ties).drop(*ties)
    return keep_first(dealt(cleaned, rows, SNAPSHOT, [CUSTOMER]), [SNAPSHOT, PART, CUSTOMER], ties).drop(PART, *ties)


def silver_clickstream(bronze: DataFrame, tie_break: Sequence[str] = (), rows: Mapping[str, int] | None = None) -> DataFrame:
    return _once_per_snapshot(bronze, {c: clean.numeric(c) for c in CLICK_COLUMNS}, tie_break, rows)


def silver_attributes(bronze: DataFrame, tie_break: Sequence[str] = (), rows: Mapping[str, int] | None = None) -> DataFrame:
    columns = {
        "Age": clean.clean_integer("Age"),
        "Occupation": clean.sentinel_to_null("Occupation", SENTINELS["Occupation"]),
    }
    return _once_per_snapshot(bronze, columns, tie_break, rows)


def silver_financials(bronze: DataFrame, tie_break: Sequence[str] = (), rows: Mapping[str, int] | None = None) -> DataFrame:
    texts = ["Credit_Mix", "Payment_of_Min_Amount", "Payment_Behaviour"]
    columns = (
        {c: clean.clean_numeric(c) for c in FINANCIAL_DOUBLES}
        | {c: clean.clean_integer(c) for c in FINANCIAL_INTEGERS}
        | {"credit_history_months": clean.credit_history_months("Credit_History_Age")}
        | {c: clean.sentinel_to_null(c, SENTINELS[c]) for c in texts}
        | {"has_type_of_loan": clean.non_blank_flag("Type_of_Loan")}
    )
    return _once_per_snapshot(bronze, columns, tie_break, rows)


def days_past_due(overdue: str, snapshot: str, first_missed: str) -> str:
    """Days since the first missed instalment while anything is overdue, else zero."""
    return f"CASE WHEN {overdue} > 0 THEN coalesce(datediff({snapshot}, {first_missed}), 0) ELSE 0 END"


def silver_lms(bronze: DataFrame) -> DataFrame:
    """Typed ledger with month on book, missed instalments and days past due.

    Missing numbers in the ledger count as zero. Rows are not de-duplicated.
    """
    zero_filled = {c: 0 for c, kind in LEDGER_TYPES.items() if kind in ("int", "double")}
    ledger = enforce_types(bronze.select(*LEDGER_TYPES), LEDGER_TYPES).fillna(zero_filled)
    missed = ledger.selectExpr(
        "*",
        "installment_num AS mob",
        f"{measures.ceil_ratio('overdue_amt', 'due_amt')} AS installments_missed",
    )
    dated = missed.selectExpr(
        "*",
        f"CASE WHEN installments_missed > 0 THEN add_months({SNAPSHOT}, -installments_missed) END AS first_missed_date",
    )
    return dated.selectExpr("*", f"{days_past_due('overdue_amt', SNAPSHOT, 'first_missed_date')} AS dpd")


BUILDERS: dict[str, Callable[..., DataFrame]] = {
    "clickstream": silver_clickstream,
    "attributes": silver_attributes,
    "financials": silver_financials,
    "lms": lambda bronze, tie_break=(): silver_lms(bronze),
}
