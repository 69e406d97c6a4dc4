"""Names and thresholds shared by the whole library."""

# ---------------------------------------------------------------------------
# Fixed values. They define the data contract and must stay as they are for
# results to be comparable between runs and installations.
# ---------------------------------------------------------------------------

CUSTOMER = "Customer_ID"
LOAN = "loan_id"
SNAPSHOT = "snapshot_date"
LABEL_SNAPSHOT = "label_snapshot_date"
FEATURE_SNAPSHOT = "feature_snapshot_date"

LABEL_DPD = 30
LABEL_MOB = 6
TRAIN_CUTOFF = "2024-12-01"
SPLIT_SEED = 42
FEATURE_STORE_VERSION = "application_snapshot_v1"

AUC_FLOOR = 0.70
PSI_CEILING = 0.20
DEFAULT_RATE_MOVE = 0.25
PSI_BINS = 10
PSI_SHARE_FLOOR = 1e-6
MIN_LEVEL_SHARE = 0.01

CLICK_COLUMNS = [f"fe_{i}" for i in range(1, 21)]

FINANCIAL_DOUBLES = [
    "Annual_Income",
    "Monthly_Inhand_Salary",
    "Changed_Credit_Limit",
    "Num_Credit_Inquiries",
    "Outstanding_Debt",
    "Credit_Utilization_Ratio",
    "Total_EMI_per_month",
    "Amount_invested_monthly",
    "Monthly_Balance",
]
FINANCIAL_INTEGERS = [
    "Num_Bank_Accounts",
    "Num_Credit_Card",
    "Interest_Rate",
    "Num_of_Loan",
    "Delay_from_due_date",
    "Num_of_Delayed_Payment",
]
SENTINELS = {
    "Occupation": "_",
    "Credit_Mix": "_",
    "Payment_of_Min_Amount": "NM",
    "Payment_Behaviour": "!@9#%8",
}

LEDGER_TYPES = {
    "loan_id": "string",
    "Customer_ID": "string",
    "loan_start_date": "date",
    "tenure": "int",
    "installment_num": "int",
    "loan_amt": "double",
    "due_amt": "double",
    "paid_amt": "double",
    "overdue_amt": "double",
    "balance": "double",
    "snapshot_date": "date",
}

NUMERIC_FEATURES = [
    "Age",
    "Annual_Income",
    "Monthly_Inhand_Salary",
    "Num_Bank_Accounts",
    "Num_Credit_Card",
    "Interest_Rate",
    "Num_of_Loan",
    "Delay_from_due_date",
    "Num_of_Delayed_Payment",
    "Changed_Credit_Limit",
    "Num_Credit_Inquiries",
    "Outstanding_Debt",
    "Credit_Utilization_Ratio",
    "credit_history_months",
    "Total_EMI_per_month",
    "Amount_invested_monthly",
    "Monthly_Balance",
    "has_type_of_loan",
    "debt_to_income_ratio",
    "emi_to_salary_ratio",
    "available_cash_after_emi",
    "clickstream_mean",
    "clickstream_min",
    "clickstream_max",
] + CLICK_COLUMNS
CATEGORICAL_FEATURES = [
    "age_bucket",
    "Occupation",
    "Credit_Mix",
    "Payment_of_Min_Amount",
    "Payment_Behaviour",
]
MODEL_FEATURES = NUMERIC_FEATURES + CATEGORICAL_FEATURES

FEATURE_STORE_COLUMNS = [
    "Customer_ID",
    "snapshot_date",
    "feature_store_def",
    "Age",
    "age_bucket",
    "Occupation",
    "Annual_Income",
    "Monthly_Inhand_Salary",
    "Num_Bank_Accounts",
    "Num_Credit_Card",
    "Interest_Rate",
    "Num_of_Loan",
    "Delay_from_due_date",
    "Num_of_Delayed_Payment",
    "Changed_Credit_Limit",
    "Num_Credit_Inquiries",
    "Credit_Mix",
    "Outstanding_Debt",
    "Credit_Utilization_Ratio",
    "credit_history_months",
    "Payment_of_Min_Amount",
    "Total_EMI_per_month",
    "Amount_invested_monthly",
    "Payment_Behaviour",
    "Monthly_Balance",
    "has_type_of_loan",
    "debt_to_income_ratio",
    "emi_to_salary_ratio",
    "available_cash_after_emi",
    "clickstream_mean",
    "clickstream_min",
    "clickstream_max",
] + CLICK_COLUMNS

# Columns that may never become model inputs, and lower-case name fragments
# that betray information from after the application.
FORBIDDEN_COLUMNS = [
    "label",
    "label_def",
    "loan_id",
    "Customer_ID",
    "snapshot_date",
    "loan_start_date",
    "feature_store_def",
    "label_snapshot_date",
    "feature_snapshot_date",
]
LEAKAGE_FRAGMENTS = [
    "dpd",
    "mob",
    "overdue",
    "paid_amt",
    "due_amt",
    "balance",
    "installment",
    "missed",
    "first_missed",
]
PII_COLUMNS = ["Name", "SSN"]

SCORE_BANDS = [(0.2, "00-20"), (0.4, "20-40"), (0.6, "40-60"), (0.8, "60-80"), (1.001, "80-100")]
SCORE_BAND_FLOOR = -0.001

# Fixed: settings of the validation model.
VALIDATION_MAX_ITER = 30
VALIDATION_REG_PARAM = 0.05
