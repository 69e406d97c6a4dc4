"""The same inputs and layers in plain SQL, written independently of the Spark code."""

from __future__ import annotations

import re

# The column names of the sources and of the feature store.
FE = [f"fe_{i}" for i in range(1, 21)]

FINANCIAL_DOUBLE = [
    "Annual_Income", "Monthly_Inhand_Salary", "Changed_Credit_Limit", "Num_Credit_Inquiries", "Outstanding_Debt",
    "Credit_Utilization_Ratio", "Total_EMI_per_month", "Amount_invested_monthly", "Monthly_Balance",
]
FINANCIAL_INT = [
    "Num_Bank_Accounts", "Num_Credit_Card", "Interest_Rate", "Num_of_Loan", "Delay_from_due_date",
    "Num_of_Delayed_Payment",
]

NUMERIC = [
    "Age", "Annual_Income", "Monthly_Inhand_Salary", "Num_Bank_Accounts", "Num_Credit_Card", "Interest_Rate",
    "Num_of_Loan", "Delay_from_due_date", "Num_of_Delayed_Payment", "Changed_Credit_Limit", "Num_Credit_Inquiries",
    "Outstanding_Debt", "Credit_Utilization_Ratio", "credit_history_months", "Total_EMI_per_month",
    "Amount_invested_monthly", "Monthly_Balance", "has_type_of_loan", "debt_to_income_ratio", "emi_to_salary_ratio",
    "available_cash_after_emi", "clickstream_mean", "clickstream_min", "clickstream_max", *FE,
]
CATEGORICAL = ["age_bucket", "Occupation", "Credit_Mix", "Payment_of_Min_Amount", "Payment_Behaviour"]


def clean_num(c: str) -> str:
    return f"try_cast(regexp_replace({c}, '[^0-9.\\-]', '', 'g') AS DOUBLE)"


def clean_int(c: str) -> str:
    return f"try_cast(trunc({clean_num(c)}) AS INTEGER)"


MONTH = "cast(date_trunc('month', o_orderdate) AS DATE)"
CID = "concat('CUS_', cast(o_custkey AS VARCHAR))"
KEYS = f"{CID} AS Customer_ID, {MONTH} AS snapshot_date, o_orderkey AS src_seq"
ONE_ROW = "QUALIFY row_number() OVER (PARTITION BY Customer_ID, snapshot_date ORDER BY src_seq) = 1"

VIEWS: dict[str, str] = {
    "fx_lms": f"""
        SELECT concat('L', cast(l_orderkey AS VARCHAR)) AS loan_id, {CID} AS Customer_ID, {MONTH} AS loan_start_date,
               10 AS tenure, l_linenumber AS installment_num, l_extendedprice AS loan_amt,
               CASE WHEN l_quantity <= 1 THEN 0.0::DOUBLE ELSE l_extendedprice / 10 END AS due_amt,
               CASE WHEN l_returnflag = 'R' THEN 0.0::DOUBLE ELSE l_extendedprice / 10 END AS paid_amt,
               CASE WHEN l_returnflag = 'R' THEN l_extendedprice * l_discount * 3 ELSE 0.0::DOUBLE END AS overdue_amt,
               l_extendedprice * (10 - l_linenumber) / 10 AS balance,
               cast({MONTH} + to_months(l_linenumber) AS DATE) AS snapshot_date
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "fx_clickstream": f"""
        SELECT {KEYS}, {", ".join(f"cast(embedding[{i}] AS DOUBLE) AS fe_{i}" for i in range(1, 21))}
        FROM (SELECT *, o_custkey % (SELECT count(*) FROM embeddings) AS _vec FROM orders) JOIN embeddings ON vec_id = _vec""",
    "fx_attributes": f"""
        SELECT {KEYS}, c_name AS Name, '000-00-0000' AS SSN,
               concat(cast(18 + o_custkey % 50 AS VARCHAR), CASE WHEN o_custkey % 7 = 0 THEN '_' ELSE '' END) AS Age,
               CASE WHEN o_custkey % 11 = 0 THEN '_' ELSE c_mktsegment END AS Occupation
        FROM orders JOIN customer ON c_custkey = o_custkey""",
    "fx_financials": f"""
        SELECT {KEYS},
               concat(cast(o_totalprice AS VARCHAR), CASE WHEN o_orderkey % 9 = 0 THEN '_' ELSE '' END) AS Annual_Income,
               CASE WHEN o_orderkey % 23 = 0 THEN '0' ELSE cast(o_totalprice / 16 AS VARCHAR) END AS Monthly_Inhand_Salary,
               cast(o_orderkey % 10 AS VARCHAR) AS Num_Bank_Accounts,
               cast(o_orderkey % 8 AS VARCHAR) AS Num_Credit_Card,
               cast(o_orderkey % 30 AS VARCHAR) AS Interest_Rate,
               concat(cast(o_orderkey % 6 AS VARCHAR), CASE WHEN o_orderkey % 13 = 0 THEN '_' ELSE '' END) AS Num_of_Loan,
               cast(o_orderkey % 60 - 5 AS VARCHAR) AS Delay_from_due_date,
               cast(o_orderkey % 25 AS VARCHAR) AS Num_of_Delayed_Payment,
               CASE WHEN o_orderkey % 17 = 0 THEN '_' ELSE cast(o_orderkey % 20 AS VARCHAR) END AS Changed_Credit_Limit,
               cast(o_orderkey % 12 AS VARCHAR) AS Num_Credit_Inquiries,
               CASE WHEN o_orderkey % 5 = 0 THEN '_' ELSE o_orderpriority END AS Credit_Mix,
               cast(c_acctbal AS VARCHAR) AS Outstanding_Debt,
               cast(o_orderkey % 45 AS VARCHAR) AS Credit_Utilization_Ratio,
               concat(cast(o_custkey % 30 AS VARCHAR), ' Years and ', cast(o_orderkey % 12 AS VARCHAR), ' Months') AS Credit_History_Age,
               CASE o_orderstatus WHEN 'P' THEN 'NM' WHEN 'F' THEN 'Yes' ELSE 'No' END AS Payment_of_Min_Amount,
               cast(o_orderkey % 300 AS VARCHAR) AS Total_EMI_per_month,
               cast(o_orderkey % 400 AS VARCHAR) AS Amount_invested_monthly,
               CASE WHEN o_orderkey % 13 = 0 THEN '!@9#%8' ELSE concat('B', cast(o_orderkey % 4 AS VARCHAR)) END AS Payment_Behaviour,
               cast(o_orderkey % 700 AS VARCHAR) AS Monthly_Balance,
               CASE WHEN o_orderkey % 4 = 0 THEN '' WHEN o_orderkey % 4 = 1 THEN NULL ELSE 'Auto Loan' END AS Type_of_Loan
        FROM orders JOIN customer ON c_custkey = o_custkey""",
    "fx_scores": """
        SELECT concat('L', cast(l_orderkey AS VARCHAR)) AS loan_id,
               cast(date_trunc('month', l_shipdate) AS DATE) AS label_snapshot_date,
               cast(l_returnflag = 'R' AS INTEGER) AS label,
               cast((l_partkey * 7 + l_suppkey * 13) % 1000 AS DOUBLE) / 1000 AS prediction_score,
               cast(l_shipdate AS DATE) AS ship_date,
               cast(cast((l_partkey * 7 + l_suppkey * 13) % 1000 AS DOUBLE) / 1000 >= 0.5 AS INTEGER) AS prediction,
               strftime(l_shipdate, '%Y-%m') AS label_month
        FROM lineitem""",
    "ledger": """
        SELECT *, installment_num AS mob,
               coalesce(cast(ceil(overdue_amt / nullif(due_amt, 0)) AS INTEGER), 0) AS installments_missed
        FROM fx_lms""",
    "silver_lms": """
        SELECT *,
               CASE WHEN overdue_amt > 0 THEN coalesce(date_diff('day', first_missed_date, snapshot_date), 0) ELSE 0 END::INTEGER AS dpd
        FROM (SELECT *, CASE WHEN installments_missed > 0
                             THEN cast(snapshot_date - to_months(installments_missed) AS DATE) END AS first_missed_date
              FROM ledger)""",
    "silver_clickstream": f"SELECT Customer_ID, snapshot_date, {', '.join(FE)} FROM fx_clickstream {ONE_ROW}",
    "silver_attributes": f"""
        SELECT Customer_ID, snapshot_date, {clean_int('Age')} AS Age, nullif(Occupation, '_') AS Occupation
        FROM fx_attributes {ONE_ROW}""",
    "silver_financials": f"""
        SELECT Customer_ID, snapshot_date,
               {", ".join(f"{clean_num(c)} AS {c}" for c in FINANCIAL_DOUBLE)},
               {", ".join(f"{clean_int(c)} AS {c}" for c in FINANCIAL_INT)},
               cast(coalesce(try_cast(regexp_extract(Credit_History_Age, '(\\d+)\\s+Years?', 1) AS INTEGER), 0) * 12
                    + coalesce(try_cast(regexp_extract(Credit_History_Age, '(\\d+)\\s+Months?', 1) AS INTEGER), 0)
                    AS INTEGER) AS credit_history_months,
               nullif(Credit_Mix, '_') AS Credit_Mix, nullif(Payment_of_Min_Amount, 'NM') AS Payment_of_Min_Amount,
               nullif(Payment_Behaviour, '!@9#%8') AS Payment_Behaviour,
               CASE WHEN length(trim(Type_of_Loan)) > 0 THEN 1 ELSE 0 END AS has_type_of_loan
        FROM fx_financials {ONE_ROW}""",
    "gold_features": f"""
        SELECT c.Customer_ID, c.snapshot_date, 'application_snapshot_v1' AS feature_store_def, a.Age,
               CASE WHEN Age <= 0 THEN NULL WHEN Age <= 24 THEN '18_24' WHEN Age <= 34 THEN '25_34'
                    WHEN Age <= 49 THEN '35_49' WHEN Age > 49 THEN '50_plus' END AS age_bucket,
               a.Occupation, f.* EXCLUDE (Customer_ID, snapshot_date),
               Outstanding_Debt / nullif(Annual_Income, 0) AS debt_to_income_ratio,
               Total_EMI_per_month / nullif(Monthly_Inhand_Salary, 0) AS emi_to_salary_ratio,
               Monthly_Inhand_Salary - Total_EMI_per_month AS available_cash_after_emi,
               list_avg([{', '.join(FE)}]) AS clickstream_mean,
               least({', '.join(FE)}) AS clickstream_min, greatest({', '.join(FE)}) AS clickstream_max,
               {', '.join(FE)}
        FROM silver_clickstream c JOIN silver_attributes a USING (Customer_ID, snapshot_date)
        JOIN silver_financials f USING (Customer_ID, snapshot_date)""",
    "gold_labels": """
        SELECT loan_id, Customer_ID, loan_start_date, cast(dpd >= 30 AS INTEGER) AS label,
               '30dpd_6mob' AS label_def, snapshot_date AS label_snapshot_date
        FROM silver_lms WHERE mob = 6""",
    "gold_training": """
        SELECT l.*, f.snapshot_date AS feature_snapshot_date, f.* EXCLUDE (Customer_ID, snapshot_date)
        FROM gold_labels l JOIN gold_features f ON l.Customer_ID = f.Customer_ID AND l.loan_start_date = f.snapshot_date""",
    "month_auc": """
        SELECT label_month, count(*) AS n_rows, cast(sum(label) AS BIGINT) AS n_positive,
               (sum(label * mid_rank) - sum(label) * (sum(label) + 1) / 2.0)
                 / nullif(sum(label) * (count(*) - sum(label)), 0) AS auc
        FROM (SELECT label_month, label,
                     rank() OVER (PARTITION BY label_month ORDER BY prediction_score)
                       + (count(*) OVER (PARTITION BY label_month, prediction_score) - 1) / 2.0 AS mid_rank
              FROM fx_scores)
        GROUP BY label_month""",
    "psi_cuts": """
        SELECT list_sort(list_distinct(quantile_cont(prediction_score,
                 [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS cuts
        FROM fx_scores WHERE ship_date < DATE '1997-01-01'""",
    "binned_scores": """
        SELECT label_month, ship_date, prediction_score,
               CASE WHEN prediction_score BETWEEN cuts[1] AND cuts[-1]
                    THEN least(len(list_filter(cuts, lambda x: x <= prediction_score)), len(cuts) - 1) END AS bin
        FROM fx_scores, psi_cuts""",
    "month_psi": """
        SELECT label_month, sum((a - e) * ln(a / e)) AS score_psi
        FROM (SELECT m.label_month,
                     greatest(coalesce(h.n, 0) / m.n_inside, 1e-6) AS a,
                     greatest(coalesce(r.n, 0) / t.n, 1e-6) AS e
              FROM (SELECT label_month, greatest(count(bin), 1)::DOUBLE AS n_inside FROM binned_scores GROUP BY 1) m
              CROSS JOIN (SELECT unnest(range(1, len(cuts))) AS bin FROM psi_cuts) b
              CROSS JOIN (SELECT count(bin)::DOUBLE AS n FROM binned_scores WHERE ship_date < DATE '1997-01-01') t
              LEFT JOIN (SELECT label_month, bin, count(*) AS n FROM binned_scores GROUP BY 1, 2) h
                ON h.label_month = m.label_month AND h.bin = b.bin
              LEFT JOIN (SELECT bin, count(*) AS n FROM binned_scores WHERE ship_date < DATE '1997-01-01' GROUP BY 1) r
                ON r.bin = b.bin)
        GROUP BY label_month""",
    "monitoring": """
        SELECT r.*, a.auc, p.score_psi
        FROM (SELECT label_month, count(*) AS row_count, avg(label) AS observed_default_rate,
                     avg(prediction) AS predicted_default_rate, avg(prediction_score) AS average_score,
                     avg(cast(label = prediction AS INTEGER)) AS accuracy
              FROM fx_scores GROUP BY label_month) r
        LEFT JOIN month_auc a USING (label_month) LEFT JOIN month_psi p USING (label_month)""",
}


def _needed(text: str, found: list[str]) -> list[str]:
    for name, body in VIEWS.items():
        if name not in found and re.search(rf"\b{name}\b", text):
            _needed(body, found)
            if name not in found:
                found.append(name)
    return found


def with_views(sql: str) -> str:
    """Prefix a query with the views it uses."""
    names = _needed(sql, [])
    if not names:
        return sql.strip()
    views = ",\n".join(f"{n} AS ({VIEWS[n].strip()})" for n in names)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {views},\n{body[5:]}"
    return f"WITH {views}\n{body}"
