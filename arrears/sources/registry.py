"""Raw sources: what they are called, where they lie, which columns they need."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrears.constants import CLICK_COLUMNS, CUSTOMER, FINANCIAL_DOUBLES, FINANCIAL_INTEGERS, LEDGER_TYPES, SNAPSHOT
from arrears.operators.schema import require_columns


@dataclass(frozen=True)
class Source:
    name: str
    file: str
    keys: tuple[str, ...]
    columns: tuple[str, ...] = field(default=())

    def read(self, spark: SparkSession, folder: str) -> DataFrame:
        return read_csv(spark, f"{folder.rstrip('/')}/{self.file}", list(self.columns))


# Fixed names: logical source -> file and the columns later layers rely on.
SOURCES = {
    s.name: s
    for s in (
        Source("clickstream", "feature_clickstream.csv", (CUSTOMER, SNAPSHOT), (CUSTOMER, SNAPSHOT, *CLICK_COLUMNS)),
        Source("attributes", "features_attributes.csv", (CUSTOMER, SNAPSHOT), (CUSTOMER, SNAPSHOT, "Age", "Occupation")),
        Source(
            "financials",
            "features_financials.csv",
            (CUSTOMER, SNAPSHOT),
            (
                CUSTOMER,
                SNAPSHOT,
                *FINANCIAL_DOUBLES,
                *FINANCIAL_INTEGERS,
                "Credit_History_Age",
                "Credit_Mix",
                "Payment_of_Min_Amount",
                "Payment_Behaviour",
                "Type_of_Loan",
            ),
        ),
        Source("lms", "lms_loan_daily.csv", ("loan_id", SNAPSHOT), tuple(LEDGER_TYPES)),
    )
}


def read_csv(spark: SparkSession, path: str, required: list[str] | None = None, multi_line: bool = False) -> DataFrame:
    """CSV with a header; every column is text by an explicit schema, empty cells are null.

    Types are enforced by the silver layer, so a month of clean values cannot
    get another type than a dirty one. The schema has the columns of the first
    header in their order; a file whose header differs is an error when it is
    read, not a silent swap of columns. ``multi_line`` allows quoted line breaks.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    header = reader.csv(path)
    if required:
        require_columns(header, required)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header.columns])
    return reader.schema(schema).option("enforceSchema", False).csv(path)


def read_sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: source.read(spark, folder) for name, source in SOURCES.items()}


def with_snapshot_date(df: DataFrame, column: str = SNAPSHOT) -> DataFrame:
    """Type the snapshot column, the only one bronze needs typed, for partitioning."""
    return df.withColumn(column, F.col(column).try_cast("date"))
