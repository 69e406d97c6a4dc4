"""Monthly monitoring of a scored portfolio and its guardrails."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.constants import AUC_FLOOR, DEFAULT_RATE_MOVE, LABEL_SNAPSHOT, PSI_CEILING
from arrears.functions.dates import month_label, up_to_month
from arrears.operators.discrimination import metrics_of_totals
from arrears.operators.ordered import ROWS_PER_RANGE, totals_of_counts, value_counts
from arrears.operators.stability import ScoreReference, fit_reference, population_stability
from arrears.session import materialise
from arrears.sources.tables import overwrite_partitions, read_table, rebuild_table, write_small


#: Sums of the rows of one month and score; sums over months or runs add up.
STATE_SUMS = {
    "n": "1",
    "n_labelled": "int(label IS NOT NULL)",
    "positives": "coalesce(cast(label AS bigint), 0)",
    "n_predicted": "int(prediction IS NOT NULL)",
    "predicted": "coalesce(cast(prediction AS bigint), 0)",
    "n_judged": "int(label IS NOT NULL AND prediction IS NOT NULL)",
    "hits": "coalesce(int(cast(label AS int) = cast(prediction AS int)), 0)",
}


def score_state(predictions: DataFrame, score: str = "prediction_score") -> DataFrame:
    """Everything monitoring needs of the predictions: one row for each label month and distinct score, with its sums."""
    rows = predictions.withColumn("label_month", month_label(F.col(LABEL_SNAPSHOT)))
    return value_counts(rows, ["label_month"], score, {name: F.expr(each) for name, each in STATE_SUMS.items()}).withColumnRenamed(score, "score")


def table_of_state(state: DataFrame, reference: ScoreReference, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """One row per label month of a stored state: rates, average score, AUC, accuracy, PSI against the reference."""
    scored = F.when(F.col("score").isNotNull(), F.col("n"))
    rates = state.groupBy("label_month").agg(
        F.sum("n").alias("row_count"),
        F.try_divide(F.sum("positives"), F.sum("n_labelled")).alias("observed_default_rate"),
        F.try_divide(F.sum("predicted"), F.sum("n_predicted")).alias("predicted_default_rate"),
        F.try_divide(F.sum(F.col("score") * F.col("n")), F.sum(scored)).alias("average_score"),
        F.try_divide(F.sum("hits"), F.sum("n_judged")).alias("accuracy"),
    )
    ranked = state.where("label_month IS NOT NULL AND score IS NOT NULL AND n_labelled > 0").select("label_month", "score", F.col("n_labelled").alias("n"), F.col("positives").alias("pos"))
    area = metrics_of_totals(totals_of_counts(ranked, ["label_month"], "score", ["n", "pos"], rows_per_range), ["label_month"]).select("label_month", "auc")
    drift = population_stability(state, reference, "score", ["label_month"], "n").select("label_month", "score_psi")
    return (
        rates.join(area, "label_month", "left")
        .join(drift, "label_month", "left")
        .select("label_month", "row_count", "observed_default_rate", "predicted_default_rate", "average_score", "auc", "accuracy", "score_psi")
    )


def monitoring_table(
    predictions: DataFrame,
    reference: DataFrame | ScoreReference,
    score: str = "prediction_score",
    reference_score: str = "score",
    execution_date: str | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """One row per label month: rates, average score, AUC, accuracy, PSI against the reference.

    The predictions are read once, into a stored state; the three grouped
    aggregates over it have one row per month each and are joined by month.
    ``reference`` is a frame of scores, or what ``fit_reference`` made of one.
    """
    if isinstance(reference, DataFrame):
        reference = fit_reference(reference, reference_score, rows_per_range=rows_per_range)
    rows = predictions
    if execution_date is not None:
        rows = rows.filter(up_to_month(F.col(LABEL_SNAPSHOT), F.lit(execution_date).cast("date")))
    return table_of_state(materialise(score_state(rows, score), "score_state"), reference, rows_per_range)


def guardrail_breaches(monitoring: DataFrame, auc_floor: float = AUC_FLOOR, psi_ceiling: float = PSI_CEILING) -> DataFrame:
    """(label_month, guardrail, observed) for every month out of bounds; an undefined AUC passes."""
    low_auc = F.when(F.col("auc") < auc_floor, F.struct(F.lit("auc_below_floor").alias("guardrail"), F.col("auc").alias("observed")))
    high_psi = F.when(
        F.col("score_psi") > psi_ceiling,
        F.struct(F.lit("score_psi_above_ceiling").alias("guardrail"), F.col("score_psi").alias("observed")),
    )
    return monitoring.select("label_month", F.inline(F.array_compact(F.array(low_auc, high_psi))))


def default_rate(labelled: DataFrame, label: str = "label") -> float | None:
    """Share of defaults among the rows with a label; None without any. One number comes to the driver."""
    return labelled.agg(F.try_divide(F.sum(F.col(label).cast("bigint")), F.count(label))).first()[0]


def retrain_triggers(
    monitoring: DataFrame,
    reference_rate: float | None,
    auc_floor: float = AUC_FLOOR,
    psi_ceiling: float = PSI_CEILING,
    rate_move: float = DEFAULT_RATE_MOVE,
) -> DataFrame:
    """One row for each month that calls for a new model before the next is due, with all its reasons.

    Besides the guardrails, the observed default rate may have moved by more
    than ``rate_move`` of ``reference_rate`` (that of the reference scores); with
    a reference rate of zero any default is a move. What is undefined, or
    compared with nothing, is no reason.
    """
    known = F.lit(reference_rate).cast("double")
    moved = F.col("observed_default_rate") - known
    reasons = {
        "auc_below_floor": F.col("auc") < auc_floor,
        "score_psi_above_ceiling": F.col("score_psi") > psi_ceiling,
        "default_rate_moved": F.abs(moved) > rate_move * known,
    }
    told = F.array_compact(F.array(*[F.when(holds, F.lit(name)) for name, holds in reasons.items()]))
    return monitoring.select(
        "label_month", "auc", "score_psi", "observed_default_rate", F.try_divide(moved, known).alias("default_rate_move"), F.array_join(told, ",").alias("reasons")
    ).where("reasons <> ''")


def monitoring_summary(monitoring: DataFrame, auc_floor: float = AUC_FLOOR, psi_ceiling: float = PSI_CEILING) -> DataFrame:
    """One row: months watched, the latest month and its values, extremes, breaches."""
    months_low = F.collect_list(F.when(F.col("auc") < auc_floor, F.col("label_month")))
    months_drift = F.collect_list(F.when(F.col("score_psi") > psi_ceiling, F.col("label_month")))
    return monitoring.agg(
        F.count(F.lit(1)).alias("months_monitored"),
        F.max("label_month").alias("latest_month"),
        F.max_by("auc", "label_month").alias("latest_auc"),
        F.max_by("score_psi", "label_month").alias("latest_score_psi"),
        F.max("score_psi").alias("max_score_psi"),
        F.min("auc").alias("min_auc"),
        F.array_sort(months_low).alias("auc_below_floor"),
        F.array_sort(months_drift).alias("score_psi_above_ceiling"),
    )


def latest_month(monitoring: DataFrame) -> DataFrame:
    """The row of the last month."""
    rest = [c for c in monitoring.columns if c != "label_month"]
    last = monitoring.agg(
        F.max("label_month").alias("label_month"), F.max_by(F.struct(*rest), "label_month").alias("last")
    )
    return last.select("label_month", "last.*")


def run_monitoring(
    spark: SparkSession,
    predictions_path: str,
    reference_path: str,
    output_path: str,
    execution_date: str | None = None,
) -> DataFrame:
    """Build and store the monitoring table from stored predictions; returns its summary.

    State and monthly rows are kept by month, so that ``add_month`` can go on from there.
    """
    predictions = read_table(spark, predictions_path)
    if execution_date is not None:
        predictions = predictions.filter(up_to_month(F.col(LABEL_SNAPSHOT), F.lit(execution_date).cast("date")))
    root = output_path.rstrip("/")
    rebuild_table(score_state(predictions), f"{root}/state", ["label_month"])
    return _watched(spark, root, reference_path, rebuild_table, None)


def add_month(spark: SparkSession, predictions_path: str, reference_path: str, output_path: str, execution_date: str) -> DataFrame:
    """Take the month of ``execution_date`` into a stored monitoring table, or take it anew; returns the summary of all months.

    Only the partitions of that month are read and written, in the predictions,
    the state and the monthly rows; other months stay as they are.
    """
    root = output_path.rstrip("/")
    rows = month_of_predictions(spark, predictions_path, execution_date)
    overwrite_partitions(score_state(rows), f"{root}/state", ["label_month"])
    return _watched(spark, root, reference_path, overwrite_partitions, execution_date[:7])


def month_of_predictions(spark: SparkSession, predictions_path: str, execution_date: str) -> DataFrame:
    """Predictions of one label month; the bounds are dates, so other partitions are not even listed."""
    first = F.trunc(F.lit(execution_date).cast("date"), "month")
    return read_table(spark, predictions_path).filter(F.col(LABEL_SNAPSHOT).between(first, F.last_day(first)))


def _watched(spark: SparkSession, root: str, reference_path: str, write, month: str | None) -> DataFrame:
    """Monthly rows of the stored state, of one month or all, into the monthly table; summary of the whole of it.

    Months that call for a new model are stored too, where the reference scores have labels.
    """
    scores = read_table(spark, reference_path)
    reference = fit_reference(scores)
    # Months are text, which partition folders would turn into dates.
    state = read_table(spark, f"{root}/state").withColumn("label_month", F.date_format(F.col("label_month").cast("date"), "yyyy-MM"))
    table = table_of_state(state if month is None else state.filter(F.col("label_month") == month), reference)
    write(table, f"{root}/monthly", ["label_month"])
    stored = stored_months(spark, root)
    write_small(monitoring_summary(stored), f"{root}/summary", "json")
    if "label" in scores.columns:
        write_small(retrain_triggers(stored, default_rate(scores)), f"{root}/retrain_triggers", "json")
    return monitoring_summary(stored)


def stored_months(spark: SparkSession, output_path: str) -> DataFrame:
    """The monthly rows that ``run_monitoring`` and ``add_month`` keep."""
    stored = read_table(spark, f"{output_path.rstrip('/')}/monthly")
    return stored.withColumn("label_month", F.date_format(F.col("label_month").cast("date"), "yyyy-MM"))
