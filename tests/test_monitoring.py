"""Monitoring kept month by month."""

import random

import pytest
from pyspark.sql import functions as F

from arrears.plans import monitoring
from arrears.session import scratch_path
from arrears.sources.tables import overwrite_partitions


@pytest.fixture(scope="module")
def predictions(spark):
    rng = random.Random(9)
    rows = []
    for i in range(900):
        score = rng.choice([0.25, None, rng.random(), rng.random()])
        label = rng.choice([None, 0, 0, 1])
        rows.append((f"L{i}", i % 3, i % 28, score, label, None if score is None else int(score >= 0.5)))
    df = spark.createDataFrame(rows, "loan_id string, m int, d int, prediction_score double, label int, prediction int")
    return df.selectExpr("loan_id", "date_add(add_months(date'2024-01-01', m), d) AS label_snapshot_date", "prediction_score", "label", "prediction")


def rows_of(df):
    return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()), key=repr)


def brute(rows):
    """Rates of one month by plain loops."""
    labels = [r.label for r in rows if r.label is not None]
    scores = [r.prediction_score for r in rows if r.prediction_score is not None]
    made = [r.prediction for r in rows if r.prediction is not None]
    judged = [r.label == r.prediction for r in rows if r.label is not None and r.prediction is not None]
    pos, neg = ([r.prediction_score for r in rows if r.label == y and r.prediction_score is not None] for y in (1, 0))
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    return [len(rows), sum(labels) / len(labels), sum(made) / len(made), sum(scores) / len(scores), auc, sum(judged) / len(judged)]


@pytest.fixture(scope="module")
def stored(spark, predictions):
    path, reference = scratch_path(spark, "predictions"), scratch_path(spark, "reference")
    overwrite_partitions(predictions, path, ["label_snapshot_date"])
    predictions.where("prediction_score IS NOT NULL").selectExpr("prediction_score AS score").write.parquet(reference)
    return path, reference


def test_table_of_state_equals_plain_loops(spark, predictions, stored):
    table = monitoring.monitoring_table(predictions, spark.read.parquet(stored[1])).orderBy("label_month").collect()
    for r in table:
        month = predictions.where(F.date_format("label_snapshot_date", "yyyy-MM") == r["label_month"]).collect()
        assert list(r)[1:7] == pytest.approx(brute(month))
    assert [r["label_month"] for r in table] == ["2024-01", "2024-02", "2024-03"]


def test_increments_equal_the_whole(spark, stored):
    whole, monthly = scratch_path(spark, "whole"), scratch_path(spark, "monthly")
    all_at_once = monitoring.run_monitoring(spark, *stored, whole)
    for day in ("2024-02-15", "2024-01-01", "2024-03-31", "2024-02-01"):
        summary = monitoring.add_month(spark, *stored, monthly, day)
    assert rows_of(monitoring.stored_months(spark, monthly)) == rows_of(monitoring.stored_months(spark, whole))
    assert rows_of(summary) == rows_of(all_at_once)


def test_an_increment_reads_its_month_alone(spark, stored):
    rows = monitoring.month_of_predictions(spark, stored[0], "2024-02-10")
    assert {f.split("label_snapshot_date=")[1][:7] for f in rows.inputFiles()} >= {"2024-02"}
    plan = rows._jdf.queryExecution().executedPlan()
    days = rows.select("label_snapshot_date").distinct().count()
    assert "PartitionFilters: [isnotnull(label_snapshot_date" in plan.toString() and 0 < days <= 29
    # Nothing of an older month is written: a month taken out of the predictions stays as it was watched.
    out, fewer = scratch_path(spark, "kept"), scratch_path(spark, "fewer")
    monitoring.run_monitoring(spark, *stored, out)
    before = {r["label_month"]: r["row_count"] for r in monitoring.stored_months(spark, out).collect()}
    overwrite_partitions(spark.read.parquet(stored[0]).where("label_snapshot_date >= '2024-03-01' AND loan_id LIKE '%1'"), fewer, ["label_snapshot_date"])
    monitoring.add_month(spark, fewer, stored[1], out, "2024-03-05")
    after = {r["label_month"]: r["row_count"] for r in monitoring.stored_months(spark, out).collect()}
    assert all(before[m] == after[m] for m in ("2024-01", "2024-02")) and before["2024-03"] > after["2024-03"] > 0


def test_states_add_up(spark, predictions, stored):
    """Two runs over parts of a month give the state of the month."""
    parts = [monitoring.score_state(predictions.where(f"loan_id {like} '%3'")) for like in ("LIKE", "NOT LIKE")]
    merged = parts[0].unionByName(parts[1]).groupBy("label_month", "score").agg(*[F.sum(c).alias(c) for c in monitoring.STATE_SUMS])
    assert rows_of(merged) == rows_of(monitoring.score_state(predictions).select(*merged.columns))
