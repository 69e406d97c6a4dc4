"""Filters, projections and scalar functions."""

from pyspark.sql import functions as F

from arrears.constants import CLICK_COLUMNS, SENTINELS
from arrears.functions import clean, dates, measures
from arrears.operators import schema
from arrears.operators.features import column_medians, fill_nulls
from arrears.operators.summaries import label_distribution, temporal_mismatches
from arrears.plans.gold import at_month_on_book
from arrears.plans.training import labelled
from arrears.session import scratch_path
from arrears.sources.tables import overwrite_partitions, read_snapshot, snapshots_between
from workload.fixtures import Inputs
from workload.reference_sql import CATEGORICAL, FE, FINANCIAL_DOUBLE, FINANCIAL_INT, NUMERIC, clean_int, clean_num
from workload.registry import query

ROW = ["Customer_ID", "snapshot_date", "src_seq"]
LEDGER = ["loan_id", "Customer_ID", "installment_num", "snapshot_date", "overdue_amt"]


@query("filter_snapshot", "SELECT loan_id, Customer_ID, installment_num, snapshot_date, overdue_amt FROM fx_lms WHERE snapshot_date = DATE '1996-06-01'")
def filter_snapshot(spark, sf_dir):
    path = overwrite_partitions(Inputs(spark, sf_dir).lms(), scratch_path(spark, "ledger"))
    return read_snapshot(spark, path, "1996-06-01").select(*LEDGER)


@query("filter_date_range", "SELECT loan_id, Customer_ID, installment_num, snapshot_date, overdue_amt FROM fx_lms WHERE snapshot_date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'")
def filter_date_range(spark, sf_dir):
    return snapshots_between(Inputs(spark, sf_dir).lms(), "1996-01-01", "1997-12-31").select(*LEDGER)


@query("filter_completed_loans", "SELECT loan_id, Customer_ID, installment_num, snapshot_date, overdue_amt FROM fx_lms WHERE loan_start_date < DATE '2000-01-01'")
def filter_completed_loans(spark, sf_dir):
    return Inputs(spark, sf_dir).lms().filter(dates.before(F.col("loan_start_date"), F.lit("2000-01-01").cast("date"))).select(*LEDGER)


@query("filter_month", "SELECT loan_id, ship_date, label, prediction_score FROM fx_scores WHERE date_trunc('month', ship_date) = DATE '1997-03-01'")
def filter_month(spark, sf_dir):
    day = F.lit("1997-03-17").cast("date")
    return (
        Inputs(spark, sf_dir).scores().filter(dates.in_month(F.col("ship_date"), day))
        .select("loan_id", "ship_date", "label", "prediction_score")
    )


@query("filter_up_to_month", "SELECT loan_id, ship_date, label, prediction_score FROM fx_scores WHERE date_trunc('month', ship_date) <= DATE '1997-03-01'")
def filter_up_to_month(spark, sf_dir):
    day = F.lit("1997-03-17").cast("date")
    return (
        Inputs(spark, sf_dir).scores().filter(dates.up_to_month(F.col("ship_date"), day))
        .select("loan_id", "ship_date", "label", "prediction_score")
    )


@query("filter_mob", "SELECT loan_id, Customer_ID, mob, snapshot_date, dpd FROM silver_lms WHERE mob = 6")
def filter_mob(spark, sf_dir):
    ledger = Inputs(spark, sf_dir).silver_lms()
    return at_month_on_book(ledger, 6).select("loan_id", "Customer_ID", "mob", "snapshot_date", "dpd")


@query("filter_labelled", "SELECT loan_id, label_snapshot_date, nullif(label, CASE WHEN prediction_score < 0.1 THEN label END) AS label FROM fx_scores WHERE prediction_score >= 0.1")
def filter_labelled(spark, sf_dir):
    scores = Inputs(spark, sf_dir).scores()
    partly = scores.withColumn("label", F.when(F.col("prediction_score") >= 0.1, F.col("label")))
    return labelled(partly).select("loan_id", "label_snapshot_date", "label")


@query("select_prefix", f"SELECT Customer_ID, snapshot_date, {', '.join(FE)} FROM silver_clickstream")
def select_prefix(spark, sf_dir):
    return schema.select_prefix(Inputs(spark, sf_dir).silver_clickstream(), "fe_", ["Customer_ID", "snapshot_date"])


_ROLES = (
    [(c, "numeric") for c in NUMERIC if c != "Monthly_Balance"]
    + [(c, "categorical") for c in CATEGORICAL]
    + [(c, "forbidden") for c in ["label", "label_def", "loan_id", "Customer_ID", "loan_start_date", "label_snapshot_date", "feature_snapshot_date", "feature_store_def"]]
    + [("Monthly_Balance", "suspicious")]
)


@query(
    "feature_selection",
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{r}' AS feature_role, count({c}) AS non_null_rows FROM gold_training" for c, r in _ROLES
    ),
)
def feature_selection(spark, sf_dir):
    training = Inputs(spark, sf_dir).gold_training()
    roles = dict(schema.feature_roles(training).rows())
    role_of = ", ".join(f"'{name}', '{role}'" for name, role in roles.items())
    return schema.column_profile(training).selectExpr(
        "column_name", f"map({role_of})[column_name] AS feature_role", "non_null_rows"
    )


@query("drop_pii", "SELECT Customer_ID, snapshot_date AS feature_snapshot_date, Age, Occupation FROM fx_attributes")
def drop_pii(spark, sf_dir):
    kept = schema.drop_pii(Inputs(spark, sf_dir).attributes(), ["Name", "SSN", "Passport"])
    return kept.drop("src_seq").withColumnRenamed("snapshot_date", "feature_snapshot_date")


@query(
    "enforce_schema",
    "SELECT loan_id, Customer_ID, loan_start_date, tenure::INTEGER AS tenure, installment_num::INTEGER AS installment_num, loan_amt, due_amt, snapshot_date, "
    "try_cast(CASE WHEN installment_num = 3 THEN 'n/a' ELSE cast(installment_num AS VARCHAR) END AS INTEGER) AS parsed FROM fx_lms",
)
def enforce_schema(spark, sf_dir):
    text = Inputs(spark, sf_dir).lms().select(
        *[F.col(c).cast("string") for c in ("loan_id", "Customer_ID", "loan_start_date", "tenure", "installment_num", "loan_amt", "due_amt", "snapshot_date")],
        F.when(F.col("installment_num") == 3, "n/a").otherwise(F.col("installment_num").cast("string")).alias("parsed"),
    )
    return schema.enforce_types(
        text,
        {"loan_start_date": "date", "tenure": "int", "installment_num": "int", "loan_amt": "double", "due_amt": "double", "snapshot_date": "date", "parsed": "int"},
    )


_REQUIRED = ["label", "label_snapshot_date", "loan_start_date"]


@query(
    "required_columns",
    "\nUNION ALL ".join(f"SELECT '{c}' AS column_name, count({c}) AS non_null_rows FROM gold_labels" for c in _REQUIRED),
)
def required_columns(spark, sf_dir):
    labels = schema.require_columns(Inputs(spark, sf_dir).gold_labels(), _REQUIRED)
    return schema.column_profile(labels.select(*_REQUIRED)).select("column_name", "non_null_rows")


@query(
    "coerce_numeric",
    "SELECT Customer_ID, snapshot_date, src_seq, try_cast(Annual_Income AS DOUBLE) AS Annual_Income, try_cast(Changed_Credit_Limit AS DOUBLE) AS Changed_Credit_Limit FROM fx_financials",
)
def coerce_numeric(spark, sf_dir):
    raw = Inputs(spark, sf_dir).financials().select("Customer_ID", "snapshot_date", "src_seq", "Annual_Income", "Changed_Credit_Limit")
    return schema.coerce_numeric(raw, ["Annual_Income", "Changed_Credit_Limit", "not_there"])


@query(
    "clean_numeric",
    f"SELECT Customer_ID, snapshot_date, src_seq, {', '.join(f'{clean_num(c)} AS {c}' for c in FINANCIAL_DOUBLE)} FROM fx_financials",
)
def clean_numeric(spark, sf_dir):
    return Inputs(spark, sf_dir).financials().selectExpr(
        *ROW, *[f"{clean.clean_numeric(c)} AS {c}" for c in FINANCIAL_DOUBLE]
    )


@query(
    "clean_integer",
    f"SELECT Customer_ID, snapshot_date, src_seq, {', '.join(f'{clean_int(c)} AS {c}' for c in FINANCIAL_INT)} FROM fx_financials",
)
def clean_integer(spark, sf_dir):
    return Inputs(spark, sf_dir).financials().selectExpr(
        *ROW, *[f"{clean.clean_integer(c)} AS {c}" for c in FINANCIAL_INT]
    )


@query(
    "credit_history_months",
    "SELECT Customer_ID, snapshot_date, src_seq, "
    "cast(string_split(Credit_History_Age, ' ')[1] AS INTEGER) * 12 + cast(string_split(Credit_History_Age, ' ')[4] AS INTEGER) AS credit_history_months "
    "FROM fx_financials",
)
def credit_history_months(spark, sf_dir):
    return Inputs(spark, sf_dir).financials().selectExpr(
        *ROW, f"{clean.credit_history_months('Credit_History_Age')} AS credit_history_months"
    )


@query(
    "sentinel_to_null",
    "SELECT Customer_ID, snapshot_date, src_seq, CASE WHEN Credit_Mix <> '_' THEN Credit_Mix END AS Credit_Mix, "
    "CASE WHEN Payment_of_Min_Amount <> 'NM' THEN Payment_of_Min_Amount END AS Payment_of_Min_Amount, "
    "CASE WHEN Payment_Behaviour <> '!@9#%8' THEN Payment_Behaviour END AS Payment_Behaviour FROM fx_financials",
)
def sentinel_to_null(spark, sf_dir):
    columns = [c for c in SENTINELS if c != "Occupation"]
    return Inputs(spark, sf_dir).financials().selectExpr(
        *ROW, *[f"{clean.sentinel_to_null(c, SENTINELS[c])} AS {c}" for c in columns]
    )


@query(
    "non_blank_flag",
    "SELECT Customer_ID, snapshot_date, src_seq, CASE WHEN coalesce(trim(Type_of_Loan), '') = '' THEN 0 ELSE 1 END AS has_type_of_loan FROM fx_financials",
)
def non_blank_flag(spark, sf_dir):
    return Inputs(spark, sf_dir).financials().selectExpr(
        *ROW, f"{clean.non_blank_flag('Type_of_Loan')} AS has_type_of_loan"
    )


@query(
    "month_label",
    "SELECT loan_id, ship_date, strftime(ship_date, '%Y-%m') AS label_month, strftime(ship_date, '%Y_%m_%d') AS date_token FROM fx_scores",
)
def month_label(spark, sf_dir):
    day = F.col("ship_date")
    return Inputs(spark, sf_dir).scores().select(
        "loan_id", "ship_date", dates.month_label(day).alias("label_month"), dates.date_token(day).alias("date_token")
    )


@query(
    "month_spine",
    "SELECT cast(unnest(generate_series(date_trunc('month', min(ship_date)), max(ship_date), INTERVAL 1 MONTH)) AS DATE) AS month_start FROM fx_scores",
)
def month_spine(spark, sf_dir):
    ends = Inputs(spark, sf_dir).scores().agg(F.min("ship_date").alias("lo"), F.max("ship_date").alias("hi"))
    return ends.select(F.explode(dates.month_sequence(F.col("lo"), F.col("hi"))).alias("month_start"))


@query("first_missed_date", "SELECT loan_id, installment_num, snapshot_date, installments_missed, first_missed_date FROM silver_lms")
def first_missed_date(spark, sf_dir):
    return Inputs(spark, sf_dir).silver_lms().select(
        "loan_id", "installment_num", "snapshot_date", "installments_missed", "first_missed_date"
    )


@query(
    "temporal_mismatch",
    "SELECT installment_num, count(*) AS mismatch_rows FROM fx_lms WHERE snapshot_date <> cast(loan_start_date + INTERVAL 6 MONTH AS DATE) GROUP BY 1",
)
def temporal_mismatch(spark, sf_dir):
    wrong = temporal_mismatches(Inputs(spark, sf_dir).lms(), 6, "snapshot_date")
    return wrong.groupBy("installment_num").agg(F.count(F.lit(1)).alias("mismatch_rows"))


@query(
    "model_windows",
    "WITH d AS (SELECT max(label_snapshot_date) AS train_date FROM gold_labels) "
    "SELECT train_date, cast(train_date - INTERVAL 14 MONTH AS DATE) AS train_test_start_date, "
    "cast(train_date - INTERVAL 2 MONTH - INTERVAL 1 DAY AS DATE) AS train_test_end_date, "
    "cast(train_date - INTERVAL 2 MONTH AS DATE) AS oot_start_date, cast(train_date - INTERVAL 1 DAY AS DATE) AS oot_end_date FROM d",
)
def model_windows(spark, sf_dir):
    last = Inputs(spark, sf_dir).gold_labels().agg(F.max("label_snapshot_date").alias("train_date"))
    w = dates.ModelWindows.before(F.col("train_date"))
    return last.select(
        "train_date",
        w.train_test_start.alias("train_test_start_date"),
        w.train_test_end.alias("train_test_end_date"),
        w.oot_start.alias("oot_start_date"),
        w.oot_end.alias("oot_end_date"),
    )


@query("safe_ratio", "SELECT loan_id, installment_num, snapshot_date, round(overdue_amt / nullif(due_amt, 0), 6) AS ratio FROM fx_lms")
def safe_ratio(spark, sf_dir):
    return Inputs(spark, sf_dir).lms().selectExpr(
        "loan_id", "installment_num", "snapshot_date", f"round({measures.safe_ratio('overdue_amt', 'due_amt')}, 6) AS ratio"
    )


def _gappy(spark, sf_dir):
    """Every fifth customer-month lacks fe_1, to tell the two null rules apart."""
    clicks = Inputs(spark, sf_dir).clickstream()
    return clicks.withColumn("fe_1", F.when(F.col("src_seq") % 5 != 0, F.col("fe_1")))


_GAPPY_SQL = [f"CASE WHEN src_seq % 5 <> 0 THEN fe_1 END", *FE[1:]]


@query(
    "row_mean",
    f"SELECT Customer_ID, snapshot_date, src_seq, round(list_avg([{', '.join(_GAPPY_SQL)}]), 6) AS mean_present, "
    f"round(({' + '.join(_GAPPY_SQL)}) / 20, 6) AS mean_complete FROM fx_clickstream",
)
def row_mean(spark, sf_dir):
    return _gappy(spark, sf_dir).selectExpr(
        *ROW,
        f"round({measures.row_mean(CLICK_COLUMNS)}, 6) AS mean_present",
        f"round({measures.row_mean(CLICK_COLUMNS, skip_nulls=False)}, 6) AS mean_complete",
    )


@query(
    "row_min_max",
    f"SELECT Customer_ID, snapshot_date, src_seq, list_min([{', '.join(_GAPPY_SQL)}]) AS row_min, list_max([{', '.join(_GAPPY_SQL)}]) AS row_max FROM fx_clickstream",
)
def row_min_max(spark, sf_dir):
    return _gappy(spark, sf_dir).selectExpr(
        *ROW, f"{measures.row_min(CLICK_COLUMNS)} AS row_min", f"{measures.row_max(CLICK_COLUMNS)} AS row_max"
    )


@query(
    "age_bucket",
    f"SELECT Customer_ID, snapshot_date, src_seq, CASE WHEN a BETWEEN 1 AND 24 THEN '18_24' WHEN a BETWEEN 25 AND 34 THEN '25_34' "
    f"WHEN a BETWEEN 35 AND 49 THEN '35_49' WHEN a >= 50 THEN '50_plus' END AS age_bucket "
    f"FROM (SELECT *, {clean_int('Age')} AS a FROM fx_attributes)",
)
def age_bucket(spark, sf_dir):
    aged = Inputs(spark, sf_dir).attributes().selectExpr(*ROW, f"{clean.clean_integer('Age')} AS Age")
    return aged.selectExpr(*ROW, f"{measures.age_bucket('Age')} AS age_bucket")


@query(
    "score_band",
    "SELECT loan_id, ship_date, prediction_score, CASE WHEN prediction_score <= 0.2 THEN '00-20' WHEN prediction_score <= 0.4 THEN '20-40' "
    "WHEN prediction_score <= 0.6 THEN '40-60' WHEN prediction_score <= 0.8 THEN '60-80' ELSE '80-100' END AS score_band FROM fx_scores",
)
def score_band(spark, sf_dir):
    return Inputs(spark, sf_dir).scores().selectExpr(
        "loan_id", "ship_date", "prediction_score", f"{measures.score_band('prediction_score')} AS score_band"
    )


@query(
    "null_fill",
    "SELECT Customer_ID, snapshot_date, coalesce(Changed_Credit_Limit, 0) AS zero_filled, coalesce(Credit_Mix, 'missing') AS Credit_Mix, "
    "coalesce(Changed_Credit_Limit, (SELECT quantile_cont(Changed_Credit_Limit, 0.5) FROM silver_financials)) AS median_filled FROM silver_financials",
)
def null_fill(spark, sf_dir):
    financials = Inputs(spark, sf_dir).silver_financials()
    median = column_medians(financials, ["Changed_Credit_Limit"]).select("median").scalar()
    filled = financials.select(
        "Customer_ID", "snapshot_date", F.col("Changed_Credit_Limit").alias("zero_filled"), "Credit_Mix",
        F.coalesce("Changed_Credit_Limit", median).alias("median_filled"),
    )
    return fill_nulls(filled, {"zero_filled": 0, "Credit_Mix": "missing"})


@query(
    "sigmoid",
    "SELECT loan_id, ship_date, round(1 / (1 + exp(-least(30, greatest(-30, prediction_score * 80 - 40)))), 6) AS probability, "
    "round(ln(least(0.9999, greatest(0.0001, prediction_score)) / (1 - least(0.9999, greatest(0.0001, prediction_score)))), 6) AS log_odds FROM fx_scores",
)
def sigmoid(spark, sf_dir):
    return Inputs(spark, sf_dir).scores().selectExpr(
        "loan_id",
        "ship_date",
        f"round({measures.sigmoid('prediction_score * 80 - 40')}, 6) AS probability",
        f"round({measures.log_odds('prediction_score')}, 6) AS log_odds",
    )


@query(
    "table_preview",
    "SELECT loan_id, Customer_ID, snapshot_date, mob, overdue_amt, dpd FROM silver_lms ORDER BY loan_id, snapshot_date, overdue_amt, dpd, Customer_ID, mob LIMIT 20",
)
def table_preview(spark, sf_dir):
    ledger = Inputs(spark, sf_dir).silver_lms().select("loan_id", "Customer_ID", "snapshot_date", "mob", "overdue_amt", "dpd")
    return schema.preview(ledger, 20, ["loan_id", "snapshot_date", "overdue_amt", "dpd", "Customer_ID", "mob"])


_LABEL_TYPES = [("loan_id", "string"), ("Customer_ID", "string"), ("loan_start_date", "date"), ("label", "int"), ("label_def", "string"), ("label_snapshot_date", "date")]


@query(
    "table_schema",
    "\nUNION ALL ".join(f"SELECT '{c}' AS column_name, '{t}' AS data_type, count({c}) AS non_null_rows FROM gold_labels" for c, t in _LABEL_TYPES),
)
def table_schema(spark, sf_dir):
    return schema.column_profile(Inputs(spark, sf_dir).gold_labels())


@query("union_by_name", "SELECT label, cast(count(*) * 2 AS BIGINT) AS row_count FROM fx_scores GROUP BY label")
def union_by_name(spark, sf_dir):
    scores = Inputs(spark, sf_dir).scores().select("loan_id", "label", "prediction_score")
    turned = scores.select("prediction_score", "loan_id", "label")
    return label_distribution(schema.union_by_name([scores, turned]))
