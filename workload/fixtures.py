"""Loan, customer and score inputs derived from the driver's tables (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.constants import CLICK_COLUMNS
from arrears.plans import gold, silver

TIE_BREAK = ["src_seq"]

CUSTOMER_ID = "concat('CUS_', o_custkey)"
MONTH = "trunc(cast(o_orderdate AS date), 'MM')"
KEYS = [f"{CUSTOMER_ID} AS Customer_ID", f"{MONTH} AS snapshot_date", "o_orderkey AS src_seq"]


class Inputs:
    """Lazy frames over one data folder; nothing runs until a query does."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # -- bronze ------------------------------------------------------------

    def lms(self) -> DataFrame:
        joined = self.table("lineitem").join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        return joined.selectExpr(
            "concat('L', l_orderkey) AS loan_id",
            f"{CUSTOMER_ID} AS Customer_ID",
            f"{MONTH} AS loan_start_date",
            "10 AS tenure",
            "l_linenumber AS installment_num",
            "l_extendedprice AS loan_amt",
            "CASE WHEN l_quantity <= 1 THEN 0D ELSE l_extendedprice / 10 END AS due_amt",
            "CASE WHEN l_returnflag = 'R' THEN 0D ELSE l_extendedprice / 10 END AS paid_amt",
            "CASE WHEN l_returnflag = 'R' THEN l_extendedprice * l_discount * 3 ELSE 0D END AS overdue_amt",
            "l_extendedprice * (10 - l_linenumber) / 10 AS balance",
            f"add_months({MONTH}, l_linenumber) AS snapshot_date",
        )

    def clickstream(self) -> DataFrame:
        vectors = self.table("embeddings")
        # Ids run from 0, so a remainder by their number reaches every row at every scale.
        number = vectors.agg(F.count(F.lit(1)).alias("n")).scalar()
        joined = self.table("orders").withColumn("_vec", F.col("o_custkey") % number).join(vectors, F.col("vec_id") == F.col("_vec"))
        clicks = [f"cast(embedding[{i}] AS double) AS {c}" for i, c in enumerate(CLICK_COLUMNS)]
        return joined.selectExpr(*KEYS, *clicks)

    def _orders_with_customer(self) -> DataFrame:
        return self.table("orders").join(self.table("customer"), F.col("c_custkey") == F.col("o_custkey"))

    def attributes(self) -> DataFrame:
        return self._orders_with_customer().selectExpr(
            *KEYS,
            "c_name AS Name",
            "'000-00-0000' AS SSN",
            "concat(18 + o_custkey % 50, if(o_custkey % 7 = 0, '_', '')) AS Age",
            "if(o_custkey % 11 = 0, '_', c_mktsegment) AS Occupation",
        )

    def financials(self) -> DataFrame:
        k = "o_orderkey"
        columns = {
            "Annual_Income": f"concat(o_totalprice, if({k} % 9 = 0, '_', ''))",
            "Monthly_Inhand_Salary": f"if({k} % 23 = 0, '0', cast(o_totalprice / 16 AS string))",
            "Num_Bank_Accounts": f"cast({k} % 10 AS string)",
            "Num_Credit_Card": f"cast({k} % 8 AS string)",
            "Interest_Rate": f"cast({k} % 30 AS string)",
            "Num_of_Loan": f"concat({k} % 6, if({k} % 13 = 0, '_', ''))",
            "Delay_from_due_date": f"cast({k} % 60 - 5 AS string)",
            "Num_of_Delayed_Payment": f"cast({k} % 25 AS string)",
            "Changed_Credit_Limit": f"if({k} % 17 = 0, '_', cast({k} % 20 AS string))",
            "Num_Credit_Inquiries": f"cast({k} % 12 AS string)",
            "Credit_Mix": f"if({k} % 5 = 0, '_', o_orderpriority)",
            "Outstanding_Debt": "cast(c_acctbal AS string)",
            "Credit_Utilization_Ratio": f"cast({k} % 45 AS string)",
            "Credit_History_Age": f"concat(o_custkey % 30, ' Years and ', {k} % 12, ' Months')",
            "Payment_of_Min_Amount": "CASE o_orderstatus WHEN 'P' THEN 'NM' WHEN 'F' THEN 'Yes' ELSE 'No' END",
            "Total_EMI_per_month": f"cast({k} % 300 AS string)",
            "Amount_invested_monthly": f"cast({k} % 400 AS string)",
            "Payment_Behaviour": f"if({k} % 13 = 0, '!@9#%8', concat('B', {k} % 4))",
            "Monthly_Balance": f"cast({k} % 700 AS string)",
            "Type_of_Loan": f"CASE {k} % 4 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE 'Auto Loan' END",
        }
        return self._orders_with_customer().selectExpr(*KEYS, *[f"{e} AS {n}" for n, e in columns.items()])

    def raw(self) -> dict[str, DataFrame]:
        return {
            "clickstream": self.clickstream(),
            "attributes": self.attributes(),
            "financials": self.financials(),
            "lms": self.lms(),
        }

    def scores(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "concat('L', l_orderkey) AS loan_id",
            "trunc(cast(l_shipdate AS date), 'MM') AS label_snapshot_date",
            "cast(l_returnflag = 'R' AS int) AS label",
            "cast((l_partkey * 7 + l_suppkey * 13) % 1000 AS double) / 1000 AS prediction_score",
            "cast(l_shipdate AS date) AS ship_date",
        )

    def predictions(self) -> DataFrame:
        scores = self.scores()
        return scores.withColumn("prediction", (F.col("prediction_score") >= 0.5).cast("int"))

    def reference_scores(self) -> DataFrame:
        early = self.scores().filter(F.col("ship_date") < F.lit("1997-01-01").cast("date"))
        return early.select(F.col("prediction_score").alias("score"), "label", "label_snapshot_date")

    # -- silver and gold ---------------------------------------------------

    def silver_lms(self) -> DataFrame:
        return silver.silver_lms(self.lms())

    def silver_clickstream(self) -> DataFrame:
        return silver.silver_clickstream(self.clickstream(), TIE_BREAK)

    def silver_attributes(self) -> DataFrame:
        return silver.silver_attributes(self.attributes(), TIE_BREAK)

    def silver_financials(self) -> DataFrame:
        return silver.silver_financials(self.financials(), TIE_BREAK)

    def gold_features(self) -> DataFrame:
        return gold.gold_features(self.silver_clickstream(), self.silver_attributes(), self.silver_financials())

    def gold_labels(self) -> DataFrame:
        return gold.gold_labels(self.silver_lms())

    def gold_training(self) -> DataFrame:
        return gold.gold_training(self.gold_labels(), self.gold_features())
