"""Training, comparison, scoring and monitoring on small synthetic loans."""

import inspect
import random

import pytest
from pyspark.sql import functions as F

from arrears.functions.clean import numeric
from arrears.operators import discrimination, features, splits
from arrears.operators.scoring import score_batch
from arrears.plans import inference, monitoring, search, training
from arrears.session import materialise, scratch_path
from arrears.sources.tables import read_table
from workload import model_queries


@pytest.fixture(scope="module")
def loans(spark):
    rng = random.Random(5)
    rows = []
    for i in range(600):
        income, mix = rng.gauss(50, 10), rng.choice(["Good", "Bad", None])
        risk = (income < 48) + (mix == "Bad")
        rows.append((f"L{i}", f"C{i}", int(rng.random() < 0.1 + 0.35 * risk), i % 4, income if i % 9 else None, mix))
    df = spark.createDataFrame(rows, "loan_id string, Customer_ID string, label int, m int, Annual_Income double, Credit_Mix string")
    return df.selectExpr(
        "loan_id", "Customer_ID", "label", "Annual_Income", "Credit_Mix",
        "add_months(date'2024-01-01', m) AS loan_start_date", "add_months(date'2024-01-01', m) AS feature_snapshot_date",
        "add_months(date'2024-07-01', m) AS label_snapshot_date",
    ).cache()


@pytest.fixture(scope="module")
def run(loans):
    return training.train_candidates(loans, "2024-09-01", numeric=["Annual_Income"], categorical=["Credit_Mix"])


def test_candidates_rank_and_register(spark, run):
    board = run.metrics.collect()
    assert {r["model_name"] for r in board} == set(training.CANDIDATES)
    assert board[0]["auc"] >= board[1]["auc"] > 0.6
    bank = scratch_path(spark, "bank")
    with pytest.raises(FileNotFoundError):
        training.load_model(spark, f"{bank}/best_model")
    training.save_model_bank(run, bank)
    metadata = spark.read.json(f"{bank}/model_metadata").first()
    assert metadata["best_model"] == board[0]["model_name"]
    assert (metadata["train_rows"], metadata["test_rows"]) == (450, 150)
    assert metadata["model_path"] == f"{bank}/best_model"
    assert [r["model_name"] for r in metadata["leaderboard"]] == [r["model_name"] for r in board]
    assert read_table(spark, f"{bank}/reference_scores").count() == 450


def test_missing_feature_is_an_error(loans):
    with pytest.raises(ValueError, match="Annual_Income"):
        training.train_candidates(loans.drop("Annual_Income"), numeric=["Annual_Income"], categorical=[])


def test_scoring_is_idempotent_and_monitored(spark, loans, run):
    scored = score_batch(run.model, loans)
    assert scored.filter("prediction <> cast(prediction_score >= 0.5 AS int) OR score_band IS NULL").count() == 0
    path = scratch_path(spark, "predictions")
    first = inference.run_batch_inference(run.model, loans, path).first()
    record = scratch_path(spark, "summary")
    again = inference.run_batch_inference(run.model, loans, path, "2024-08-20", record).first()
    assert spark.read.json(record).first()["row_count"] == 600
    assert (first["row_count"], first["prediction_months"]) == (again["row_count"], again["prediction_months"]) == (600, 4)

    reference = scratch_path(spark, "reference")
    run.extras["reference_scores"].write.parquet(reference)
    out = scratch_path(spark, "monitoring")
    summary = monitoring.run_monitoring(spark, path, reference, out, "2024-09-15").first()
    assert (summary["months_monitored"], summary["latest_month"]) == (3, "2024-09")
    assert summary["max_score_psi"] < 0.2 and summary["min_auc"] > 0.5
    rate = monitoring.default_rate(run.extras["reference_scores"])
    stored = {r["label_month"] for r in spark.read.schema("label_month string").json(f"{out}/retrain_triggers").collect()}
    want = monitoring.retrain_triggers(monitoring.stored_months(spark, out), rate).collect()
    assert stored == {r["label_month"] for r in want}


def test_guardrails(spark):
    table = spark.createDataFrame([("2024-01", 0.65, 0.1), ("2024-02", None, 0.3), ("2024-03", 0.8, 0.2)], "label_month string, auc double, score_psi double")
    found = {(r["label_month"], r["guardrail"]) for r in monitoring.guardrail_breaches(table).collect()}
    assert found == {("2024-01", "auc_below_floor"), ("2024-02", "score_psi_above_ceiling")}
    assert monitoring.latest_month(table).first()["label_month"] == "2024-03"


def test_retrain_triggers(spark):
    rows = [("2024-01", 0.65, 0.1, 0.2), ("2024-02", None, 0.3, 0.26), ("2024-03", 0.8, 0.2, 0.25), ("2024-04", 0.6, 0.4, 0.14), ("2024-05", 0.9, 0.1, None)]
    table = spark.createDataFrame(rows, "label_month string, auc double, score_psi double, observed_default_rate double")

    def found(rate):
        return {r["label_month"]: r["reasons"] for r in monitoring.retrain_triggers(table, rate).collect()}

    guardrails = {"2024-01": "auc_below_floor", "2024-02": "score_psi_above_ceiling", "2024-04": "auc_below_floor,score_psi_above_ceiling"}
    assert found(None) == guardrails
    moved = {"2024-02": "score_psi_above_ceiling,default_rate_moved", "2024-04": "auc_below_floor,score_psi_above_ceiling,default_rate_moved"}
    # A move of exactly a quarter (0.25 from 0.2) is none.
    assert found(0.2) == guardrails | moved
    assert found(0.0)["2024-03"] == "default_rate_moved" and "2024-05" not in found(0.0)
    labels = spark.createDataFrame([(1,), (0,), (0,), (None,), (0,)], "label int")
    assert monitoring.default_rate(labels) == 0.25 and monitoring.default_rate(labels.limit(0)) is None


def test_leaderboard_puts_undefined_auc_last(spark):
    board = spark.createDataFrame([(0, "a", None), (1, "b", 0.7), (2, "c", 0.7)], "candidate_no int, model_name string, auc double")
    assert [r["model_name"] for r in training.rank_leaderboard(board).collect()] == ["b", "c", "a"]


def test_validation_model(spark, loans):
    found = training.train_validation_model(loans.drop("feature_snapshot_date"), "2024-09-01")
    metrics = found.metrics.first()
    assert metrics["auc"] > 0.6 and (metrics["train_rows"], metrics["test_rows"]) == (450, 150)
    assert metrics["numeric_features"] == ["Annual_Income"] and metrics["categorical_features"] == ["Credit_Mix"]
    assert found.extras["leakage_report"].where("status <> 'PASS'").count() == 0
    folder = scratch_path(spark, "validation")
    training.save_validation_run(found, folder)
    assert spark.read.json(f"{folder}/metrics").first()["test_rows"] == 150
    other = loans.drop("feature_snapshot_date").withColumnRenamed("label_snapshot_date", "seen_on")
    assert training.train_validation_model(other, "2024-09-01", date_column="seen_on").metrics.first()["train_rows"] == 450


def test_a_column_with_too_many_levels_is_refused(spark):
    df = spark.range(30).selectExpr("concat('v', id % 12) AS c", "concat('w', id % 2) AS d")
    model = training.category_index(df, ["c", "d"], 12)
    assert [len(stage.labels) for stage in model.stages] == [12, 2] and model.stages[0].labels[0] == "v0"
    numbered = model.transform(df)
    assert training.one_hot(["c", "d"])[0].fit(numbered).transform(numbered).count() == 30
    with pytest.raises(ValueError, match="levels"):
        training.category_index(df, ["c"], 11)


def test_behaviour_model_is_stored_and_scores_again(spark):
    rng = random.Random(2)
    rows = [(f"L{i}", i % 14, rng.gauss(0, 1)) for i in range(400)]
    df = spark.createDataFrame(rows, "loan_id string, m int, fe_1 double").selectExpr("loan_id", "add_months(date'2024-01-01', m) AS label_snapshot_date", "int(fe_1 + rand(3) > 0.5) AS label", "fe_1")
    df = materialise(df)
    day = F.lit("2025-03-01").cast("date")
    run = search.train_behaviour_model(df, day, feature_columns=["fe_1"], draws=1, space={"maxIter": [3], "maxDepth": [2]})
    root = search.save_search_run(run, scratch_path(spark, "behaviour_bank"))
    marked = splits.window_split(training.labelled(df), day, ("loan_id",), seed=search.SPLIT_AND_MODEL_SEED)
    checked = search.reload_and_check(marked, root).collect()
    assert {r.split for r in checked} == {"train", "test", "oot"} and all(r.agrees for r in checked)


def test_search_grid_is_seeded_and_distinct():
    space = {"maxIter": [25, 50], "maxDepth": [2, 3]}

    class Named:
        def getParam(self, name):
            return name

    one, two = (search.sample_grid(Named(), space, 3) for _ in range(2))
    assert one == two and len({tuple(p.items()) for p in one}) == 3
    assert len(search.sample_grid(Named(), space, 100)) == 4


def test_registered_searches_are_whole(spark, smoke_dir, monkeypatch):
    whole, asked = search.random_search, []

    def small(*args, **given):
        call = inspect.signature(whole).bind(*args, **given)
        call.apply_defaults()
        asked.append((call.arguments["draws"], call.arguments["folds"], call.arguments["space"]))
        call.arguments |= {"draws": 1, "folds": 2, "space": {"maxIter": [2], "maxDepth": [2]}}
        return whole(*call.args, **call.kwargs)

    monkeypatch.setattr(search, "random_search", small)
    recorded = []
    record_of = search.behaviour_record
    monkeypatch.setattr(search, "behaviour_record", lambda *args: recorded.append(record_of(*args)) or recorded[-1])
    assert model_queries.random_search_cv(spark, smoke_dir).count() == 3
    record = recorded[0].collect()
    assert record and all(r["hp_params"] == {"maxIter": "2", "maxDepth": "2"} for r in record)
    assert model_queries.score_snapshots(spark, smoke_dir).count() > 0
    assert asked == [(100, 3, search.SEARCH_SPACE)] * 2


def test_numeric_expression_reads_plain_numbers(spark):
    assert spark.sql(f"SELECT {numeric(chr(39) + '1e3' + chr(39))} AS x").first()["x"] == 1000.0


def test_training_holds_no_wide_copy_and_compiles_its_stages(spark, loans, monkeypatch):
    """Of the training rows only the blocks of the descent are held, and wide stages are written without code too long to compile."""
    kind, held, limits = "spark.sql.codegen.hugeMethodLimit", [], {}
    for module in (training, features):
        whole = module.held
        monkeypatch.setattr(module, "held", lambda df, whole=whole: held.append(df.columns) or whole(df))
    store = training.materialise
    monkeypatch.setattr(training, "materialise", lambda df, name: limits.update({name: int(spark.conf.get(kind))}) or store(df, name))
    before = spark.conf.get(kind)
    spark.conf.set(kind, "65535")
    try:
        training.train_candidates(loans, "2024-09-01", numeric=["Annual_Income"], categorical=["Credit_Mix"])
        training.train_validation_model(loans.drop("feature_snapshot_date"), "2024-09-01")
        assert spark.conf.get(kind) == "65535"
    finally:
        spark.conf.set(kind, before)
    assert held == [["rows", "x", "y"]]
    assert limits["prepared"] == limits["leakage_report"] == 8000


def test_classification_metrics_come_from_one_reading(spark, monkeypatch):
    """Accuracy comes with the counts of the scores; rows without label, score or group have no part in it."""
    monkeypatch.setattr(discrimination, "accuracy", lambda *a: pytest.fail("the rows are read a second time"))
    rows = [("a", 0.9, 1), ("a", 0.9, 0), ("a", 0.5, 1), ("a", 0.1, 0), ("a", None, 1), ("a", 0.2, None), ("b", 0.4, 1), (None, 0.3, 0), ("c", 0.3, None)]
    df = spark.createDataFrame(rows, "g string, prediction_score double, label int")
    found = {r["g"]: (r["n_rows"], r["accuracy"]) for r in discrimination.classification_metrics(df, ["g"]).collect()}
    assert found == {"a": (4, 0.75), "b": (1, 0.0)}
    assert discrimination.classification_metrics(df).first()["accuracy"] == pytest.approx(4 / 6)
    none = discrimination.classification_metrics(df.limit(0)).first()
    assert none["accuracy"] is None
