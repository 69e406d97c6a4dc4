"""Sources, sinks, backfill and reports: each writes real tables to the shared folder and reads them back."""

from pyspark.sql import functions as F

from arrears.constants import LABEL_SNAPSHOT
from arrears.operators.schema import feature_roles
from arrears.operators.summaries import leakage_report as report_of
from arrears.operators.upsert import upsert_table, upsert_versioned
from arrears.plans import datamart
from arrears.plans.inference import write_predictions as store_predictions
from arrears.session import scratch_path
from arrears.sources import tables
from arrears.sources.registry import SOURCES, read_csv
from workload.fixtures import TIE_BREAK, Inputs
from workload.reference_sql import CATEGORICAL, NUMERIC
from workload.registry import query

_TABLE_COLUMNS = ["loan_id", "Customer_ID", "installment_num", "loan_amt", "balance", "snapshot_date"]
_TABLE_SQL = "SELECT loan_id, Customer_ID, installment_num, loan_amt, balance, snapshot_date FROM fx_lms"


def _ledger(spark, sf_dir):
    return Inputs(spark, sf_dir).lms().select(*_TABLE_COLUMNS)


@query(
    "scan_csv",
    "SELECT 'clickstream' AS source, count(*) AS row_count, count(fe_1) AS filled, count(DISTINCT Customer_ID) AS customers FROM fx_clickstream "
    "UNION ALL SELECT 'attributes', count(*), count(Occupation), count(DISTINCT Customer_ID) FROM fx_attributes "
    "UNION ALL SELECT 'financials', count(*), count(nullif(Type_of_Loan, '')), count(DISTINCT Customer_ID) FROM fx_financials "
    "UNION ALL SELECT 'lms', count(*), count(balance), count(DISTINCT Customer_ID) FROM fx_lms",
)
def scan_csv(spark, sf_dir):
    folder = scratch_path(spark, "raw")
    probe = {"clickstream": "fe_1", "attributes": "Occupation", "financials": "Type_of_Loan", "lms": "balance"}
    counts = []
    for name, df in Inputs(spark, sf_dir).raw().items():
        # Packed, as plain text would be most of what the query writes; every file is read by one task.
        df.write.option("header", True).option("escape", '"').option("compression", "gzip").csv(f"{folder}/{SOURCES[name].file}")
        read = SOURCES[name].read(spark, folder)
        counts.append(
            read.agg(
                F.count(F.lit(1)).alias("row_count"),
                F.count(probe[name]).alias("filled"),
                F.countDistinct("Customer_ID").alias("customers"),
            ).select(F.lit(name).alias("source"), "*")
        )
    first, *rest = counts
    for other in rest:
        first = first.unionByName(other)
    return first


@query("read_csv_text", "SELECT Customer_ID, cast(snapshot_date AS VARCHAR) AS snapshot_date, Annual_Income, Credit_History_Age, Payment_Behaviour, nullif(Type_of_Loan, '') AS Type_of_Loan FROM fx_financials")
def read_csv_text(spark, sf_dir):
    path = scratch_path(spark, "features_financials.csv")
    columns = ["Customer_ID", "snapshot_date", "Annual_Income", "Credit_History_Age", "Payment_Behaviour", "Type_of_Loan"]
    Inputs(spark, sf_dir).financials().write.option("header", True).option("escape", '"').csv(path)
    return read_csv(spark, path, columns).select(*columns)


@query("bronze_ingest", _TABLE_SQL)
def bronze_ingest(spark, sf_dir):
    text = _ledger(spark, sf_dir).withColumn("snapshot_date", F.col("snapshot_date").cast("string"))
    return tables.ingest_snapshots(text, scratch_path(spark, "bronze_lms")).select(*_TABLE_COLUMNS)


@query("read_snapshot", f"{_TABLE_SQL} WHERE snapshot_date = DATE '1996-06-01'")
def read_snapshot(spark, sf_dir):
    path = tables.overwrite_partitions(_ledger(spark, sf_dir), scratch_path(spark, "ledger"))
    return tables.read_snapshot(spark, path, "1996-06-01").select(*_TABLE_COLUMNS)


@query("read_table", _TABLE_SQL)
def read_table(spark, sf_dir):
    path = tables.overwrite_partitions(_ledger(spark, sf_dir), scratch_path(spark, "ledger"))
    return tables.read_table(spark, path).select(*_TABLE_COLUMNS)


@query(
    "write_partition_overwrite",
    "SELECT loan_id, Customer_ID, installment_num, loan_amt, CASE WHEN snapshot_date >= DATE '1998-01-01' THEN 0.0 ELSE balance END AS balance, snapshot_date FROM fx_lms",
)
def write_partition_overwrite(spark, sf_dir):
    ledger = _ledger(spark, sf_dir)
    path = tables.overwrite_partitions(ledger, scratch_path(spark, "ledger"))
    late = tables.snapshots_between(ledger, "1998-01-01", None).withColumn("balance", F.lit(0.0))
    tables.overwrite_partitions(late, path)
    return tables.read_table(spark, path).select(*_TABLE_COLUMNS)


@query("write_by_date", f"{_TABLE_SQL} WHERE installment_num <> 7")
def write_by_date(spark, sf_dir):
    undated = _ledger(spark, sf_dir).withColumn("snapshot_date", F.when(F.col("installment_num") != 7, F.col("snapshot_date")))
    path = tables.overwrite_partitions(undated, scratch_path(spark, "ledger"))
    return tables.read_table(spark, path).select(*_TABLE_COLUMNS)


@query("rebuild_table", f"{_TABLE_SQL} WHERE snapshot_date >= DATE '1998-01-01'")
def rebuild_table(spark, sf_dir):
    ledger = _ledger(spark, sf_dir)
    path = tables.rebuild_table(ledger, scratch_path(spark, "ledger"))
    tables.rebuild_table(tables.snapshots_between(ledger, "1998-01-01", None), path)
    return tables.read_table(spark, path).select(*_TABLE_COLUMNS)


@query(
    "write_predictions",
    "SELECT loan_id AS Customer_ID, label_snapshot_date AS snapshot_date, concat('credit_model_', cast(label AS VARCHAR)) AS model_name, prediction_score AS model_predictions FROM fx_scores",
)
def write_predictions(spark, sf_dir):
    scored = Inputs(spark, sf_dir).scores().select(
        F.col("loan_id").alias("Customer_ID"),
        F.col("label_snapshot_date").alias("snapshot_date"),
        F.concat(F.lit("credit_model_"), F.col("label").cast("string")).alias("model_name"),
        F.col("prediction_score").alias("model_predictions"),
    )
    path = store_predictions(scored, scratch_path(spark, "model_predictions"))
    return tables.read_table(spark, path).select("Customer_ID", "snapshot_date", "model_name", "model_predictions")


_UPSERT_SQL = """
    SELECT loan_id, label_snapshot_date, label, prediction_score FROM (
        SELECT loan_id, label_snapshot_date, label, prediction_score, 0 AS run FROM fx_scores
        UNION ALL
        SELECT loan_id, label_snapshot_date, label, round(1 - prediction_score, 3), 1 FROM fx_scores WHERE ship_date >= DATE '1999-01-01')
    QUALIFY row_number() OVER (PARTITION BY loan_id, label_snapshot_date ORDER BY run DESC, prediction_score DESC, label DESC) = 1"""


def _upserted_twice(spark, sf_dir, upsert):
    """All scores, then the late ones changed; the table read back."""
    scores = Inputs(spark, sf_dir).scores()
    columns = ["loan_id", LABEL_SNAPSHOT, "label", "prediction_score"]
    path = scratch_path(spark, "predictions")
    order = ["prediction_score", "label"]
    upsert(scores.select(*columns), path, order_by=order)
    late = scores.filter(F.col("ship_date") >= F.lit("1999-01-01").cast("date"))
    upsert(late.withColumn("prediction_score", F.round(1 - F.col("prediction_score"), 3)).select(*columns), path, order_by=order)
    return tables.read_table(spark, path).select(*columns)


@query("upsert_table", _UPSERT_SQL)
def upsert_into_table(spark, sf_dir):
    return _upserted_twice(spark, sf_dir, upsert_table)


@query("upsert_versioned", _UPSERT_SQL)
def upsert_into_versions(spark, sf_dir):
    return _upserted_twice(spark, sf_dir, upsert_versioned)


_COUNTS_SQL = "\nUNION ALL ".join(
    [f"SELECT 'bronze' AS layer, '{s}' AS table_name, count(*) AS row_count FROM fx_{s}" for s in SOURCES]
    + [f"SELECT 'silver', '{s}', count(*) FROM silver_{s}" for s in SOURCES]
    + ["SELECT 'gold', 'feature_store', count(*) FROM gold_features"]
    + ["SELECT 'gold', 'label_store', count(*) FROM gold_labels"]
    + ["SELECT 'gold', 'training_dataset', count(*) FROM gold_training"]
    + ["SELECT 'label_distribution', cast(label AS VARCHAR), count(*) FROM gold_training GROUP BY label"]
)


@query("datamart_summary", _COUNTS_SQL)
def datamart_summary(spark, sf_dir):
    """The summary after a month was built a second time, from the counts stored with the tables."""
    inputs, mart = Inputs(spark, sf_dir), datamart.Datamart(scratch_path(spark, "datamart"))
    raw = inputs.raw()
    datamart.backfill(spark, raw, mart, tie_break=TIE_BREAK)
    datamart.run_month(spark, raw, mart, "1997-06-15", tie_break=TIE_BREAK)
    return datamart.mart_summary(spark, mart)


@query("backfill_counts", _COUNTS_SQL)
def backfill_counts(spark, sf_dir):
    mart = datamart.Datamart(scratch_path(spark, "datamart"))
    datamart.backfill(spark, Inputs(spark, sf_dir).raw(), mart, tie_break=TIE_BREAK)
    return datamart.mart_summary(spark, mart)


def _lit(names):
    return "'" + ", ".join(names) + "'"


_FORBIDDEN = ["Customer_ID", "feature_snapshot_date", "feature_store_def", "label", "label_def", "label_snapshot_date", "loan_id", "loan_start_date"]


@query(
    "leakage_report",
    "SELECT 'rows_loaded' AS check_name, 'PASS' AS status, cast(count(*) AS VARCHAR) AS detail FROM gold_training "
    "UNION ALL SELECT 'temporal_alignment', CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END, cast(count(*) AS VARCHAR) "
    "FROM gold_training WHERE label_snapshot_date <> cast(loan_start_date + INTERVAL 6 MONTH AS DATE) "
    f"UNION ALL SELECT 'forbidden_columns_excluded', 'PASS', {_lit(_FORBIDDEN)} "
    "UNION ALL SELECT 'leakage_patterns_excluded', 'PASS', 'Monthly_Balance' "
    f"UNION ALL SELECT 'numeric_features_used', 'PASS', {_lit([c for c in NUMERIC if c != 'Monthly_Balance'])} "
    f"UNION ALL SELECT 'categorical_features_used', 'PASS', {_lit(CATEGORICAL)}",
)
def leakage_report(spark, sf_dir):
    training = Inputs(spark, sf_dir).gold_training()
    return report_of(training, feature_roles(training))
