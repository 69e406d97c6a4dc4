"""Joins, aggregates, windows, rankings, silver and gold layers."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from arrears.constants import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from arrears.functions import measures
from arrears.functions.clean import quoted
from arrears.operators import discrimination, features, joins, splits, stability, summaries
from arrears.operators.dedup import keep_first
from arrears.operators.upsert import merge_keep_last
from arrears.plans import monitoring
from arrears.plans.training import champion
from arrears.session import materialise
from workload.fixtures import Inputs
from workload.reference_sql import CATEGORICAL, FE, NUMERIC
from workload.registry import query


def _rounded(df, *columns, digits=6):
    return df.selectExpr(*[f"round(`{c}`, {digits}) AS `{c}`" if c in columns else f"`{c}`" for c in df.columns])


# -- silver and gold -------------------------------------------------------


@query("silver_lms", "SELECT loan_id, Customer_ID, loan_start_date, tenure, installment_num, loan_amt, due_amt, paid_amt, overdue_amt, balance, snapshot_date, mob, installments_missed, first_missed_date, dpd FROM silver_lms")
def silver_lms(spark, sf_dir):
    return Inputs(spark, sf_dir).silver_lms()


@query("dpd", "SELECT dpd, count(*) AS row_count FROM silver_lms GROUP BY dpd")
def dpd(spark, sf_dir):
    return Inputs(spark, sf_dir).silver_lms().groupBy("dpd").agg(F.count(F.lit(1)).alias("row_count"))


@query("silver_clickstream", "SELECT * FROM silver_clickstream")
def silver_clickstream(spark, sf_dir):
    return Inputs(spark, sf_dir).silver_clickstream()


@query("silver_attributes", "SELECT * FROM silver_attributes")
def silver_attributes(spark, sf_dir):
    return Inputs(spark, sf_dir).silver_attributes()


@query("silver_financials", "SELECT * FROM silver_financials")
def silver_financials(spark, sf_dir):
    return Inputs(spark, sf_dir).silver_financials()


@query("dedup_snapshot", "SELECT Customer_ID, snapshot_date, min(src_seq) AS src_seq FROM fx_attributes GROUP BY 1, 2")
def dedup_snapshot(spark, sf_dir):
    rows = Inputs(spark, sf_dir).attributes().select("Customer_ID", "snapshot_date", "src_seq")
    return keep_first(rows, ["Customer_ID", "snapshot_date"], ["src_seq"])


_RATIOS = ["debt_to_income_ratio", "emi_to_salary_ratio", "available_cash_after_emi", "clickstream_mean"]
_RATIO_SQL = f"* REPLACE ({', '.join(f'round({c}, 6) AS {c}' for c in _RATIOS)})"


@query("gold_features", f"SELECT {_RATIO_SQL} FROM gold_features")
def gold_features(spark, sf_dir):
    return _rounded(Inputs(spark, sf_dir).gold_features(), *_RATIOS)


@query("gold_labels", "SELECT * FROM gold_labels")
def gold_labels(spark, sf_dir):
    return Inputs(spark, sf_dir).gold_labels()


@query(
    "gold_training",
    f"SELECT {_RATIO_SQL.replace('REPLACE (', 'REPLACE (' + ', '.join(f'cast({c} AS DOUBLE) AS {c}' for c in ['Age', 'Num_Bank_Accounts', 'Num_Credit_Card', 'Interest_Rate', 'Num_of_Loan', 'Delay_from_due_date', 'Num_of_Delayed_Payment', 'credit_history_months', 'has_type_of_loan']) + ', ')} FROM gold_training",
)
def gold_training(spark, sf_dir):
    return _rounded(Inputs(spark, sf_dir).gold_training(), *_RATIOS)


# -- joins -----------------------------------------------------------------


@query(
    "join_features",
    "SELECT Customer_ID, snapshot_date, fe_1, fe_20, Age, Occupation, Annual_Income, Credit_Mix "
    "FROM silver_clickstream JOIN silver_attributes USING (Customer_ID, snapshot_date) JOIN silver_financials USING (Customer_ID, snapshot_date)",
)
def join_features(spark, sf_dir):
    inputs = Inputs(spark, sf_dir)
    joined = joins.join_snapshots([inputs.silver_clickstream(), inputs.silver_attributes(), inputs.silver_financials()])
    return joined.select("Customer_ID", "snapshot_date", "fe_1", "fe_20", "Age", "Occupation", "Annual_Income", "Credit_Mix")


@query(
    "join_point_in_time",
    "SELECT l.loan_id, l.Customer_ID, l.label, l.label_snapshot_date, a.snapshot_date AS feature_snapshot_date, a.Age, a.Occupation "
    "FROM gold_labels l JOIN silver_attributes a ON a.Customer_ID = l.Customer_ID AND a.snapshot_date = l.loan_start_date",
)
def join_point_in_time(spark, sf_dir):
    inputs = Inputs(spark, sf_dir)
    joined = joins.join_point_in_time(inputs.gold_labels(), inputs.silver_attributes())
    return joined.select("loan_id", "Customer_ID", "label", "label_snapshot_date", "feature_snapshot_date", "Age", "Occupation")


@query(
    "join_labels_left",
    "SELECT l.loan_id, l.Customer_ID, l.label, l.label_snapshot_date, c.fe_1, c.fe_20 "
    "FROM gold_labels l LEFT JOIN silver_clickstream c ON c.Customer_ID = l.Customer_ID AND c.snapshot_date = l.label_snapshot_date",
)
def join_labels_left(spark, sf_dir):
    inputs = Inputs(spark, sf_dir)
    joined = joins.join_label_month(inputs.gold_labels(), inputs.silver_clickstream())
    return joined.select("loan_id", "Customer_ID", "label", "label_snapshot_date", "fe_1", "fe_20")


_BUCKET = "('0x' || substr(md5({key} || '|42'), 1, 8))::BIGINT % {n}"
_ORDER_BUCKET = _BUCKET.format(key="cast(o_orderkey AS VARCHAR)", n=100)
_ORDER_NUMBER = "('0x' || substr(md5(cast(o_orderkey AS VARCHAR) || '|42'), 1, 15))::BIGINT"


@query("split_complement", f"SELECT o_orderkey, o_custkey FROM orders WHERE {_ORDER_BUCKET} >= 80")
def split_complement(spark, sf_dir):
    orders = Inputs(spark, sf_dir).table("orders").select("o_orderkey", "o_custkey")
    sample = orders.filter(splits.hash_bucket(["o_orderkey"]) < 80)
    return splits.complement(orders, sample, ["o_orderkey"])


# -- splits ----------------------------------------------------------------


@query("split_hash", f"SELECT o_orderkey, CASE WHEN {_ORDER_NUMBER} < {int(0.8 * 2**60)} THEN 'train' ELSE 'test' END AS split FROM orders")
def split_hash(spark, sf_dir):
    orders = Inputs(spark, sf_dir).table("orders").select("o_orderkey")
    return splits.random_split(orders, ["o_orderkey"])


_HASH60 = "('0x' || substr(md5(loan_id || '|' || cast({date} AS VARCHAR) || '|{seed}'), 1, 15))::BIGINT"


def _stratified_sql(source: str, seed: int, where: str = "true") -> str:
    h = _HASH60.format(date="label_snapshot_date", seed=seed)
    return (
        f"hashed AS (SELECT *, {h} AS h FROM {source}), "
        f"cuts AS (SELECT label, min(h) AS cut FROM (SELECT label, h, "
        f"count(*) OVER (PARTITION BY label ORDER BY h) AS reached, count(*) OVER (PARTITION BY label) AS n FROM hashed WHERE {where}) "
        f"WHERE reached >= round(0.8 * n) GROUP BY label)"
    )


@query(
    "split_stratified",
    f"WITH {_stratified_sql('gold_labels', 42)} "
    "SELECT loan_id, label_snapshot_date, hashed.label, CASE WHEN h <= cut THEN 'train' ELSE 'test' END AS split FROM hashed JOIN cuts USING (label)",
)
def split_stratified(spark, sf_dir):
    labels = Inputs(spark, sf_dir).gold_labels().select("loan_id", "label_snapshot_date", "label")
    return splits.stratified_split(labels, ["loan_id", "label_snapshot_date"])


@query(
    "split_temporal",
    "SELECT CASE WHEN label_snapshot_date <= DATE '1999-12-01' THEN 'train' ELSE 'test' END AS split, label, count(*) AS row_count FROM gold_labels GROUP BY 1, 2",
)
def split_temporal(spark, sf_dir):
    marked = splits.temporal_split(Inputs(spark, sf_dir).gold_labels(), "1999-12-01")
    return marked.groupBy("split", "label").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "split_reused_row",
    "SELECT 'train' AS split, count(DISTINCT label) AS row_count, true AS from_train FROM gold_labels WHERE label IS NOT NULL "
    "UNION ALL SELECT 'test', 1, true FROM gold_labels WHERE label IS NOT NULL HAVING count(DISTINCT label) = 2",
)
def split_reused_row(spark, sf_dir):
    """The last fallback: of the first loan of each class both are needed for training, so one of them is tested again."""
    labels = Inputs(spark, sf_dir).gold_labels().where("label IS NOT NULL")
    firsts = labels.groupBy("label").agg(F.min(F.struct("label_snapshot_date", "loan_id")).alias("first")).select("label", "first.*")
    marked = splits.temporal_split(materialise(firsts, "first_loans"), "1980-01-01")
    keys = F.collect_set(F.when(F.col("split") == "train", F.col("loan_id"))).over(Window.partitionBy())
    held = marked.withColumn("known", F.array_contains(keys, F.col("loan_id")))
    return held.groupBy("split").agg(F.count(F.lit(1)).alias("row_count"), F.bool_and("known").alias("from_train"))


_OOT_SQL = (
    "recent AS (SELECT * FROM gold_labels WHERE label_snapshot_date >= DATE '1999-02-01' AND label_snapshot_date <= DATE '2000-03-31'), "
    + _stratified_sql("recent", 88, "label_snapshot_date < DATE '2000-02-01'")
    + ", marked AS (SELECT loan_id, label_snapshot_date, hashed.label, CASE WHEN label_snapshot_date >= DATE '2000-02-01' THEN 'oot' "
    "WHEN h <= cut THEN 'train' ELSE 'test' END AS split FROM hashed LEFT JOIN cuts USING (label))"
)


def _oot_split(spark, sf_dir):
    labels = Inputs(spark, sf_dir).gold_labels().select("loan_id", "label_snapshot_date", "label")
    return splits.window_split(labels, F.lit("2000-04-01").cast("date"), ["loan_id", "label_snapshot_date"], seed=88)


@query("split_oot", f"WITH {_OOT_SQL} SELECT * FROM marked")
def split_oot(spark, sf_dir):
    return _oot_split(spark, sf_dir)


@query("split_stats", f"WITH {_OOT_SQL} SELECT split, count(*) AS row_count, round(avg(label), 2) AS label_rate FROM marked GROUP BY split")
def split_stats(spark, sf_dir):
    return splits.split_stats(_oot_split(spark, sf_dir))


# -- aggregates ------------------------------------------------------------


@query("label_distribution", "SELECT label, count(*) AS row_count FROM gold_labels GROUP BY label")
def label_distribution(spark, sf_dir):
    return summaries.label_distribution(Inputs(spark, sf_dir).gold_labels())


@query("class_guard", "SELECT count(*) AS row_count, count(DISTINCT label) AS class_count, count(DISTINCT label) >= 2 AS is_usable FROM gold_labels")
def class_guard(spark, sf_dir):
    return summaries.class_guard(Inputs(spark, sf_dir).gold_labels())


@query("bad_rate_by_mob", "SELECT mob, round(avg(CASE WHEN dpd >= 30 THEN 1 ELSE 0 END), 6) AS bad_rate FROM silver_lms GROUP BY mob")
def bad_rate_by_mob(spark, sf_dir):
    return _rounded(summaries.bad_rate_by_mob(Inputs(spark, sf_dir).silver_lms()), "bad_rate")


@query(
    "prediction_summary",
    "SELECT count(*) AS row_count, count(DISTINCT label_snapshot_date) AS prediction_months, round(avg(prediction_score), 6) AS average_score, "
    "round(avg(prediction), 6) AS predicted_default_rate FROM fx_scores",
)
def prediction_summary(spark, sf_dir):
    return _rounded(summaries.prediction_summary(Inputs(spark, sf_dir).predictions()), "average_score", "predicted_default_rate")


_RATES = ["observed_default_rate", "predicted_default_rate", "average_score", "accuracy"]


@query(
    "monitor_monthly",
    f"SELECT label_month, row_count, {', '.join(f'round({c}, 6) AS {c}' for c in _RATES)} FROM monitoring",
)
def monitor_monthly(spark, sf_dir):
    return _rounded(summaries.monthly_rates(Inputs(spark, sf_dir).predictions()), *_RATES)


@query(
    "column_medians",
    "\nUNION ALL ".join(f"SELECT '{c}' AS column_name, round(quantile_cont(cast({c} AS DOUBLE), 0.5), 6) AS median FROM gold_training" for c in NUMERIC),
)
def column_medians(spark, sf_dir):
    training = materialise(Inputs(spark, sf_dir).gold_training().select(*NUMERIC_FEATURES), "training_numbers")
    return _rounded(features.column_medians(training, NUMERIC_FEATURES), "median")


@query(
    "column_moments",
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, round(avg({c}), 4) AS mean, round(coalesce(nullif(stddev_samp({c}), 0), 1), 4) AS std FROM gold_training" for c in NUMERIC
    ),
)
def column_moments(spark, sf_dir):
    return _rounded(features.column_moments(Inputs(spark, sf_dir).gold_training(), NUMERIC_FEATURES), "mean", "std", digits=4)


_LEVELS_SQL = "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, coalesce({c}, 'missing') AS level, count(*) AS row_count, "
    f"round(count(*) / (SELECT count(*) FROM gold_training), 6) AS share FROM gold_training GROUP BY 2 "
    f"HAVING count(*) / (SELECT count(*) FROM gold_training) >= 0.01"
    for c in CATEGORICAL
)


@query("category_levels", _LEVELS_SQL)
def category_levels(spark, sf_dir):
    return _rounded(features.category_levels(Inputs(spark, sf_dir).gold_training(), CATEGORICAL_FEATURES), "share")


@query("frequent_one_hot", f"SELECT column_name, level, cast(row_count AS DOUBLE) AS ones FROM ({_LEVELS_SQL})")
def frequent_one_hot(spark, sf_dir):
    training = materialise(Inputs(spark, sf_dir).gold_training().select(*CATEGORICAL_FEATURES), "training_categories")
    levels = features.collect_levels(features.category_levels(training, CATEGORICAL_FEATURES))
    encoded = features.frequent_one_hot(training, levels)
    named = [(features.one_hot_name(c, i), c, level) for c, names in levels.items() for i, level in enumerate(names)]
    sums = encoded.selectExpr(*[f"sum(`{n}`) AS `{n}`" for n, _, _ in named])
    rows = [f"named_struct('column_name', '{c}', 'level', {quoted(level)}, 'ones', `{n}`)" for n, c, level in named]
    return sums.selectExpr(f"inline(array({', '.join(rows)}))")


@query(
    "standardise",
    f"SELECT Customer_ID, snapshot_date, {', '.join(f'round(({c} - (SELECT avg({c}) FROM silver_clickstream)) / (SELECT coalesce(nullif(stddev_pop({c}), 0), 1) FROM silver_clickstream), 6) AS {c}' for c in FE)} FROM silver_clickstream",
)
def standardise(spark, sf_dir):
    scaled = features.standardise(Inputs(spark, sf_dir).silver_clickstream(), FE)
    return _rounded(scaled, *FE)


# -- rankings and stability ------------------------------------------------


@query("rank_auc_by_month", "SELECT label_month, n_rows, n_positive, round(auc, 6) AS auc FROM month_auc")
def rank_auc_by_month(spark, sf_dir):
    scores = Inputs(spark, sf_dir).scores().withColumn("label_month", F.date_format("label_snapshot_date", "yyyy-MM"))
    return _rounded(discrimination.auc(scores, ["label_month"]), "auc")


@query("gini", "SELECT label_month, round(2 * auc - 1, 3) AS gini FROM month_auc")
def gini(spark, sf_dir):
    scores = Inputs(spark, sf_dir).scores().withColumn("label_month", F.date_format("label_snapshot_date", "yyyy-MM"))
    return discrimination.auc(scores, ["label_month"]).selectExpr("label_month", f"{measures.gini('auc', 3)} AS gini")


_AP_SQL = """
    SELECT {g} coalesce(sum(pos * hits / taken) / nullif(sum(pos), 0), 0) AS average_precision
    FROM (SELECT {g} prediction_score, sum(label) AS pos,
                 sum(sum(label)) OVER ({p} ORDER BY prediction_score DESC) AS hits,
                 sum(count(*)) OVER ({p} ORDER BY prediction_score DESC) AS taken
          FROM fx_scores GROUP BY {g} prediction_score) {by}"""


@query(
    "average_precision",
    f"SELECT label_month, round(average_precision, 6) AS average_precision FROM ({_AP_SQL.format(g='label_month,', p='PARTITION BY label_month', by='GROUP BY label_month')})",
)
def average_precision(spark, sf_dir):
    scores = Inputs(spark, sf_dir).scores().withColumn("label_month", F.date_format("label_snapshot_date", "yyyy-MM"))
    ranked = discrimination.ranking_metrics(scores, ["label_month"]).select("label_month", "average_precision")
    return _rounded(ranked, "average_precision")


_AUC_SQL = """
    SELECT count(*) AS n_rows, cast(sum(label) AS BIGINT) AS n_positive,
           (sum(label * mid_rank) - sum(label) * (sum(label) + 1) / 2.0) / (sum(label) * (count(*) - sum(label))) AS auc
    FROM (SELECT label, rank() OVER (ORDER BY prediction_score) + (count(*) OVER (PARTITION BY prediction_score) - 1) / 2.0 AS mid_rank FROM fx_scores)"""


@query("auc", f"SELECT n_rows, n_positive, round(auc, 6) AS auc FROM ({_AUC_SQL})")
def auc(spark, sf_dir):
    return _rounded(discrimination.auc(Inputs(spark, sf_dir).scores()), "auc")


@query(
    "classification_metrics",
    f"SELECT n_rows, n_positive, round(auc, 6) AS auc, round(2 * auc - 1, 6) AS gini, round(average_precision, 6) AS average_precision, "
    f"(SELECT round(avg(cast(prediction = label AS INTEGER)), 6) FROM fx_scores) AS accuracy "
    f"FROM ({_AUC_SQL}), ({_AP_SQL.format(g='', p='', by='')})",
)
def classification_metrics(spark, sf_dir):
    metrics = discrimination.classification_metrics(Inputs(spark, sf_dir).scores())
    return _rounded(metrics, "auc", "gini", "average_precision", "accuracy")


@query("quantile_cuts", "SELECT generate_subscripts(cuts, 1)::INTEGER AS cut_no, round(unnest(cuts), 6) AS cut FROM psi_cuts")
def quantile_cuts(spark, sf_dir):
    cuts = stability.quantile_cuts(Inputs(spark, sf_dir).reference_scores(), "score")
    return cuts.select(F.posexplode("cuts").alias("pos", "cut")).select((F.col("pos") + 1).alias("cut_no"), F.round("cut", 6).alias("cut"))


@query("score_histogram", "SELECT label_month, bin::INTEGER AS bin, count(*) AS n FROM binned_scores GROUP BY 1, 2")
def score_histogram(spark, sf_dir):
    inputs = Inputs(spark, sf_dir)
    cuts = stability.fit_reference(inputs.reference_scores()).cuts
    scores = inputs.scores().withColumn("label_month", F.date_format("label_snapshot_date", "yyyy-MM"))
    return stability.histogram(scores, cuts, "prediction_score", ["label_month"])


@query(
    "score_psi",
    "SELECT label_month, round(score_psi, 6) AS score_psi, n_out_of_range FROM month_psi JOIN "
    "(SELECT label_month, count(*) - count(bin) AS n_out_of_range FROM binned_scores GROUP BY 1) USING (label_month)",
)
def score_psi(spark, sf_dir):
    inputs = Inputs(spark, sf_dir)
    scores = inputs.scores().withColumn("label_month", F.date_format("label_snapshot_date", "yyyy-MM"))
    reference = stability.fit_reference(inputs.reference_scores())
    psi = stability.population_stability(scores, reference, "prediction_score", ["label_month"])
    return _rounded(psi, "score_psi")


_MONITOR = [*_RATES, "auc", "score_psi"]
_MONITOR_SQL = f"SELECT label_month, row_count, {', '.join(f'round({c}, 6) AS {c}' for c in _MONITOR)} FROM monitoring"


def _monitoring(spark, sf_dir):
    inputs = Inputs(spark, sf_dir)
    return monitoring.monitoring_table(inputs.predictions(), inputs.reference_scores())


@query("monitoring_table", _MONITOR_SQL)
def monitoring_table(spark, sf_dir):
    return _rounded(_monitoring(spark, sf_dir), *_MONITOR)


@query("latest_month", f"{_MONITOR_SQL} ORDER BY label_month DESC LIMIT 1")
def latest_month(spark, sf_dir):
    return _rounded(monitoring.latest_month(_monitoring(spark, sf_dir)), *_MONITOR)


@query(
    "guardrail_breaches",
    "SELECT label_month, 'auc_below_floor' AS guardrail, round(auc, 6) AS observed FROM monitoring WHERE auc < 0.7 "
    "UNION ALL SELECT label_month, 'score_psi_above_ceiling', round(score_psi, 6) FROM monitoring WHERE score_psi > 0.2",
)
def guardrail_breaches(spark, sf_dir):
    return _rounded(monitoring.guardrail_breaches(_monitoring(spark, sf_dir)), "observed")


@query(
    "retrain_triggers",
    "SELECT label_month, round(auc, 6) AS auc, round(score_psi, 6) AS score_psi, round(observed_default_rate, 6) AS observed_default_rate, "
    "round((observed_default_rate - rate) / nullif(rate, 0), 6) AS default_rate_move, "
    "concat_ws(',', CASE WHEN auc < 0.7 THEN 'auc_below_floor' END, CASE WHEN score_psi > 0.2 THEN 'score_psi_above_ceiling' END, "
    "CASE WHEN abs(observed_default_rate - rate) > 0.25 * rate THEN 'default_rate_moved' END) AS reasons "
    "FROM monitoring, (SELECT avg(label) AS rate FROM fx_scores WHERE ship_date < DATE '1997-01-01') WHERE reasons <> ''",
)
def retrain_triggers(spark, sf_dir):
    rate = monitoring.default_rate(Inputs(spark, sf_dir).reference_scores())
    found = monitoring.retrain_triggers(_monitoring(spark, sf_dir), rate)
    return _rounded(found, "auc", "score_psi", "observed_default_rate", "default_rate_move")


@query(
    "monitoring_summary",
    "SELECT count(*) AS months_monitored, max(label_month) AS latest_month, round(arg_max(auc, label_month), 6) AS latest_auc, "
    "round(arg_max(score_psi, label_month), 6) AS latest_score_psi, round(max(score_psi), 6) AS max_score_psi, round(min(auc), 6) AS min_auc, "
    "count(CASE WHEN auc < 0.7 THEN 1 END)::INTEGER AS months_below_floor, count(CASE WHEN score_psi > 0.2 THEN 1 END)::INTEGER AS months_above_ceiling FROM monitoring",
)
def monitoring_summary(spark, sf_dir):
    found = monitoring.monitoring_summary(_monitoring(spark, sf_dir))
    counted = found.withColumns(
        {"months_below_floor": F.size("auc_below_floor"), "months_above_ceiling": F.size("score_psi_above_ceiling")}
    ).drop("auc_below_floor", "score_psi_above_ceiling")
    return _rounded(counted, "latest_auc", "latest_score_psi", "max_score_psi", "min_auc")


@query(
    "leaderboard_top1",
    "SELECT label_month AS model_name, round(auc, 6) AS auc FROM month_auc ORDER BY month_auc.auc DESC NULLS LAST, label_month LIMIT 1",
)
def leaderboard_top1(spark, sf_dir):
    scores = Inputs(spark, sf_dir).scores().withColumn("label_month", F.date_format("label_snapshot_date", "yyyy-MM"))
    board = discrimination.auc(scores, ["label_month"]).select(
        F.col("label_month").alias("model_name"), "auc", F.col("label_month").alias("candidate_no")
    )
    return _rounded(champion(board), "auc")


@query(
    "upsert_keep_last",
    """
    SELECT loan_id, label_snapshot_date, label, prediction_score FROM (
        SELECT loan_id, label_snapshot_date, label, prediction_score, 0 AS run FROM fx_scores
        UNION ALL
        SELECT loan_id, label_snapshot_date, label, round(1 - prediction_score, 3), 1 FROM fx_scores WHERE label = 1)
    QUALIFY row_number() OVER (PARTITION BY loan_id, label_snapshot_date ORDER BY run DESC, prediction_score DESC, label DESC) = 1""",
)
def upsert_keep_last(spark, sf_dir):
    existing = Inputs(spark, sf_dir).scores().select("loan_id", "label_snapshot_date", "label", "prediction_score")
    rescored = existing.filter(F.col("label") == 1).withColumn("prediction_score", F.round(1 - F.col("prediction_score"), 3))
    return merge_keep_last(existing, rescored, order_by=["prediction_score", "label"])


@query(
    "leakage_check",
    "SELECT count(*) AS row_count, count(CASE WHEN label_snapshot_date <> cast(loan_start_date + INTERVAL 6 MONTH AS DATE) THEN 1 END) AS mismatch_rows FROM gold_training",
)
def leakage_check(spark, sf_dir):
    return summaries.leakage_counts(Inputs(spark, sf_dir).gold_training())
