"""Joins, de-duplication, tables, upserts and the datamart."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from arrears.constants import CLICK_COLUMNS, FORBIDDEN_COLUMNS, LEAKAGE_FRAGMENTS
from arrears.operators import joins, summaries
from arrears.operators.dedup import keep_first, keep_last
from arrears.operators.schema import FeatureRoles
from arrears.operators import upsert as upserts
from arrears.operators.upsert import upsert_table, upsert_versioned
from arrears.plans import datamart, gold, graph, silver
from arrears.session import refuse_own_disk, scratch_path, session_dir
from arrears.sources import registry, tables, versions
from workload.fixtures import TIE_BREAK, Inputs


def rows_of(df):
    return sorted(tuple(str(x) for x in r) for r in df.select(*sorted(df.columns)).collect())


def plan_of(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


def test_a_key_with_a_third_of_the_rows_joins_like_any_other(spark):
    labels = spark.range(3000).selectExpr("concat('L', id) AS loan_id", "if(id % 3 = 0, 'hot', concat('C', id % 700)) AS Customer_ID", "date'2024-01-01' AS loan_start_date", "date'2024-07-01' AS label_snapshot_date")
    features = spark.createDataFrame([("hot", -1), *((f"C{i}", i) for i in range(0, 700, 2))], "Customer_ID string, v int").withColumn("snapshot_date", F.lit("2024-01-01").cast("date"))
    joined = joins.join_point_in_time(labels, features)
    assert joined.count() == labels.where("Customer_ID = 'hot' OR cast(substr(Customer_ID, 2) AS int) % 2 = 0").count()
    assert joined.where("Customer_ID = 'hot' AND v <> -1").count() == 0
    assert joins.join_label_month(labels, features).count() == 3000


def test_training_set_reads_each_input_once(spark, smoke_dir):
    plan = plan_of(Inputs(spark, smoke_dir).gold_training())
    # Counting the vectors reads no column and is not an input of the set.
    assert plan.count("ReadSchema: struct<") - plan.count("ReadSchema: struct<>") <= 8


def test_every_vector_is_reached(spark):
    big = "/root/testdata/sf0.1"
    inputs = Inputs(spark, big)
    vectors = inputs.table("embeddings").count()
    customers = inputs.table("orders").select((F.col("o_custkey") % vectors).alias("v")).distinct().count()
    first = inputs.clickstream().select(CLICK_COLUMNS[0], CLICK_COLUMNS[1], CLICK_COLUMNS[2]).distinct().count()
    assert vectors == 2000 and first == customers > 500


def test_files_with_another_header_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Customer_ID,Age\nC1,30\n")
    (tmp_path / "b.csv").write_text("Age,Customer_ID\n40,C2\n")
    with pytest.raises(Exception, match="(?i)header"):
        registry.read_csv(spark, str(tmp_path)).collect()
    (tmp_path / "b.csv").write_text('Customer_ID,Age\nC2,"4\n0"\n')
    rows = registry.read_csv(spark, str(tmp_path), ["Age"], multi_line=True).collect()
    assert sorted(r.Age for r in rows) == ["30", "4\n0"]


def test_a_sorted_report_stays_sorted(spark, tmp_path):
    path = str(tmp_path / "report")
    tables.write_small(spark.range(2000).repartition(7).orderBy(F.desc("id")), path)
    assert [r.id for r in spark.read.parquet(path).collect()] == list(range(1999, -1, -1))


def test_upsert_works_out_new_rows_once_and_leaves_no_stage(spark, tmp_path):
    path, counted = str(tmp_path / "t"), spark.sparkContext.accumulator(0)
    first = spark.createDataFrame([("L1", "2024-01-01", 1)], "loan_id string, d string, v int").selectExpr("loan_id", "date(d) AS label_snapshot_date", "v")
    upsert_table(first, path)

    def seen(rows):
        for batch in rows:
            counted.add(batch.num_rows)
            yield batch

    upsert_table(first.withColumn("v", F.lit(2)).mapInArrow(seen, first.schema), path)
    assert [r.v for r in spark.read.parquet(path).collect()] == [2] and counted.value == 1
    left = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(session_dir(spark))
    files = left.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(left, True)
    names = []
    while files.hasNext():
        names.append(files.next().getPath().toString())
    assert not [n for n in names if "upsert" in n]


def test_report_statuses_follow_the_data(spark):
    rows = spark.createDataFrame([("L1", 1, 5.0, "2024-07-01")], "loan_id string, label int, dpd double, d string")
    rows = rows.selectExpr("loan_id", "label", "dpd", "5.0D AS income", "date(d) AS label_snapshot_date", "date'2024-01-01' AS loan_start_date")
    good = FeatureRoles(["income"], [], [], [], [])
    status = {r.check_name: r.status for r in summaries.leakage_report(rows, good).collect()}
    assert status["rows_loaded"] == status["temporal_alignment"] == status["numeric_features_used"] == "PASS"
    bad = FeatureRoles([FORBIDDEN_COLUMNS[0], f"x_{LEAKAGE_FRAGMENTS[0]}"], [], [], [], [])
    status = {r.check_name: r.status for r in summaries.leakage_report(rows.limit(0), bad).collect()}
    assert status["rows_loaded"] == status["forbidden_columns_excluded"] == status["leakage_patterns_excluded"] == "FAIL"


def test_dedup_is_stable_and_limits_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 10 AS k", "id % 3 AS seq", "id AS v")
    assert rows_of(keep_first(df.repartition(5), ["k"], ["seq"])) == rows_of(keep_first(df.repartition(2), ["k"], ["seq"]))
    assert {r["seq"] for r in keep_last(df, ["k"], ["seq"]).collect()} == {2}
    plan = plan_of(keep_first(df, ["k"], ["seq"]))
    assert "row_number(), 1, Partial" in plan and "Python" not in plan


def ledger(spark, rows):
    names = "loan_id string, Customer_ID string, loan_start_date string, tenure string, installment_num string, loan_amt string, due_amt string, paid_amt string, overdue_amt string, balance string, snapshot_date string"
    return spark.createDataFrame(rows, names)


def test_silver_ledger_edge_cases(spark):
    base = ["C1", "2023-01-01", "10"]
    rows = [
        ("ok", *base, "6", "1000", "100", "100", "0", "400", "2023-07-01"),
        ("two_missed", *base, "6", "1000", "100", "0", "150", "400", "2023-07-01"),
        ("february", *base, "2", "1000", "100", "0", "100", "400", "2023-03-01"),
        ("no_due", *base, "6", "1000", "0", "0", "100", "400", "2023-07-01"),
        ("dirty", *base, None, "x", None, None, None, None, "2023-07-01"),
        ("month_end", *base, "6", "1000", "100", "0", "100", "400", "2023-03-31"),
    ]
    found = {r["loan_id"]: r for r in silver.silver_lms(ledger(spark, rows)).collect()}
    assert (found["ok"]["dpd"], found["ok"]["first_missed_date"]) == (0, None)
    assert (found["two_missed"]["installments_missed"], found["two_missed"]["dpd"]) == (2, 61)
    assert found["february"]["dpd"] == 28
    assert (found["no_due"]["installments_missed"], found["no_due"]["dpd"]) == (0, 0)
    assert (found["dirty"]["mob"], found["dirty"]["loan_amt"], found["dirty"]["dpd"]) == (0, 0.0, 0)
    assert found["month_end"]["first_missed_date"] == dt.date(2023, 2, 28)
    labels = {r["loan_id"]: r["label"] for r in gold.gold_labels(silver.silver_lms(ledger(spark, rows))).collect()}
    assert labels == {"ok": 0, "two_missed": 1, "no_due": 0, "month_end": 1}
    assert gold.gold_labels(silver.silver_lms(ledger(spark, rows)), 60, 2).first()["label_def"] == "60dpd_2mob"


def test_leakage_check(spark):
    df = spark.createDataFrame([("2023-01-01", "2023-07-01", 1), ("2023-01-01", "2023-08-01", 0)], "s string, e string, label int")
    df = df.selectExpr("cast(s AS date) AS loan_start_date", "cast(e AS date) AS label_snapshot_date", "label")
    with pytest.raises(ValueError, match="1 labels"):
        summaries.check_leakage(df)
    assert summaries.check_leakage(df.filter("label = 1")) == 1
    with pytest.raises(ValueError, match="loan_start_date"):
        summaries.check_leakage(df.drop("loan_start_date"))


def test_partition_overwrite_and_pruning(spark):
    path = scratch_path(spark, "t")
    df = spark.range(60).selectExpr("id", "add_months(date'2024-01-01', cast(id % 3 AS int)) AS snapshot_date")
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, path)
    with pytest.raises(TypeError):
        tables.read_table(spark, {"path": path})
    tables.overwrite_partitions(df.union(spark.sql("SELECT 99L, cast(null AS date)")), path)
    assert tables.read_table(spark, path).count() == 60
    march = df.filter("snapshot_date = '2024-03-01'").limit(5)
    for _ in range(2):
        tables.overwrite_partitions(march, path)
        assert tables.read_table(spark, path).count() == 45
    snapshot = tables.read_snapshot(spark, path, "2024-02-01")
    assert snapshot.count() == 20
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan_of(snapshot)
    tables.rebuild_table(march, path)
    assert tables.read_table(spark, path).count() == 5


def test_upsert_twice_is_once_and_leaves_other_months(spark):
    path = scratch_path(spark, "p")
    first = spark.range(40).selectExpr("concat('L', id % 10) AS loan_id", "add_months(date'2024-01-01', cast(id % 4 AS int)) AS label_snapshot_date", "cast(id AS double) AS prediction_score")
    upsert_table(first, path, order_by=["prediction_score"])
    before = rows_of(tables.read_table(spark, path))
    assert len(before) == 20
    new = spark.sql("SELECT 'L0' AS loan_id, date'2024-01-01' AS label_snapshot_date, -1D AS prediction_score UNION ALL SELECT 'L77', date'2024-02-01', -2D")
    for _ in range(2):
        upsert_table(new, path, order_by=["prediction_score"])
        table = tables.read_table(spark, path)
        assert table.count() == 21
        assert table.filter("loan_id = 'L0' AND label_snapshot_date = '2024-01-01'").first()["prediction_score"] == -1.0
    with pytest.raises(ValueError):
        upsert_table(new, path, keys=["loan_id"])


def loans(spark, *rows):
    schema = "loan_id string, d string, v int"
    return spark.createDataFrame(list(rows), schema).selectExpr("loan_id", "v", "date(d) AS label_snapshot_date")


def test_readers_see_all_of_a_versioned_upsert_or_none(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    upsert_versioned(loans(spark, ("L1", "2024-01-01", 1), ("L2", "2024-02-01", 1), ("L3", "2024-03-01", 1)), path)
    old = tables.read_table(spark, path)
    change = loans(spark, ("L1", "2024-01-01", 2), ("L2", "2024-02-01", 2), ("L4", "2024-04-01", 2))

    # A task that fails after the first month is written.
    def failing(batches):
        for batch in batches:
            if dt.date(2024, 2, 1) in batch.column("label_snapshot_date").to_pylist():
                raise OSError("lost")
            yield batch

    rebuild = tables.rebuild_table
    half = lambda df, folder, by: rebuild(df.repartition(4, *by).mapInArrow(failing, df.schema), folder, by)
    monkeypatch.setattr(upserts, "rebuild_table", half)
    with pytest.raises(Exception, match="lost"):
        upsert_versioned(change, path)
    monkeypatch.undo()
    assert rows_of(tables.read_table(spark, path)) == rows_of(old)

    # A driver that fails when every month is written but nothing is committed.
    seen = []

    def dies(*_):
        seen.extend(rows_of(tables.read_table(spark, path)))
        raise OSError("driver gone")

    monkeypatch.setattr(upserts, "commit_version", dies)
    with pytest.raises(OSError, match="driver gone"):
        upsert_versioned(change, path)
    monkeypatch.undo()
    assert seen == rows_of(old) == rows_of(tables.read_table(spark, path))
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("_version=")]) == 1

    upsert_versioned(change, path)
    want = [("2024-01-01", "L1", "2"), ("2024-02-01", "L2", "2"), ("2024-03-01", "L3", "1"), ("2024-04-01", "L4", "2")]
    assert rows_of(tables.read_table(spark, path)) == want
    # Who began to read before still reads the table of then.
    assert [r[2] for r in rows_of(old)] == ["1", "1", "1"]


def test_of_two_writers_the_second_is_told(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    upsert_versioned(loans(spark, ("L1", "2024-01-01", 1)), path)
    commit = upserts.commit_version

    def late(*args):
        monkeypatch.undo()
        upsert_versioned(loans(spark, ("L2", "2024-01-01", 5)), path)
        return commit(*args)

    monkeypatch.setattr(upserts, "commit_version", late)
    with pytest.raises(versions.CommitConflict):
        upsert_versioned(loans(spark, ("L1", "2024-01-01", 9)), path)
    assert rows_of(tables.read_table(spark, path)) == [("2024-01-01", "L1", "1"), ("2024-01-01", "L2", "5")]
    upsert_versioned(loans(spark, ("L1", "2024-01-01", 9)), path)
    assert rows_of(tables.read_table(spark, path)) == [("2024-01-01", "L1", "9"), ("2024-01-01", "L2", "5")]


def test_a_plain_table_takes_versions_and_old_ones_can_go(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert_table(loans(spark, ("L1", "2024-01-01", 1), ("L2", "2024-02-01", 1)), path)
    for v in (2, 3):
        upsert_versioned(loans(spark, ("L1", "2024-01-01", v)), path)
    # A table with versions keeps them, whichever upsert is called; a plain overwrite would be overlooked.
    upsert_table(loans(spark, ("L1", "2024-01-01", 4)), path)
    with pytest.raises(ValueError):
        tables.overwrite_partitions(loans(spark, ("L1", "2024-01-01", 5)), path, ["label_snapshot_date"])
    want = [("2024-01-01", "L1", "4"), ("2024-02-01", "L2", "1")]
    assert rows_of(tables.read_table(spark, path)) == want
    one = tables.read_snapshot(spark, path, "2024-01-01", "label_snapshot_date")
    assert rows_of(one) == want[:1]
    assert plan_of(one).count("PartitionFilters: [isnotnull(label_snapshot_date") == 2, "plain and versioned folders are both pruned"
    assert versions.drop_old_versions(spark, path, keep=1) == 2
    assert rows_of(tables.read_table(spark, path)) == want
    assert versions.drop_old_versions(spark, path, keep=1) == 0
    tables.rebuild_table(loans(spark, ("L9", "2024-05-01", 9)), path, ["label_snapshot_date"])
    assert rows_of(tables.read_table(spark, path)) == [("2024-05-01", "L9", "9")]


def test_versions_of_empty_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert_versioned(loans(spark, ("L1", "2024-01-01", 1)).limit(0), path)
    assert not tables.table_exists(spark, path)
    upsert_versioned(loans(spark, ("L1", "2024-01-01", 1), ("L1", "2024-01-01", 2), ("L1", None, 3)), path, order_by=["v"])
    upsert_versioned(loans(spark, ("L1", "2024-01-01", 1)).limit(0), path)
    assert rows_of(tables.read_table(spark, path)) == [("2024-01-01", "L1", "2")]


def test_csv_source_reads_text_by_header(spark, tmp_path):
    (tmp_path / "features_attributes.csv").write_text('Occupation,Customer_ID,snapshot_date,Age\n"Sales, ""EU""",C1,2024-01-01,23_\n')
    source = registry.SOURCES["attributes"]
    row = source.read(spark, str(tmp_path)).first()
    assert (row["Occupation"], row["Age"]) == ('Sales, "EU"', "23_")
    (tmp_path / "lms_loan_daily.csv").write_text("loan_id\nL1\n")
    with pytest.raises(ValueError, match="Customer_ID"):
        registry.SOURCES["lms"].read(spark, str(tmp_path))


def test_backfill_by_month_equals_backfill_of_the_range(spark, smoke_dir):
    raw = Inputs(spark, smoke_dir).raw()
    whole, monthly = (datamart.Datamart(scratch_path(spark, n)) for n in ("whole", "monthly"))
    datamart.backfill(spark, raw, whole, "1997-01-01", "1997-02-28", TIE_BREAK)
    for day in ("1997-01-15", "1997-02-01", "1997-02-01"):
        datamart.run_month(spark, raw, monthly, day, tie_break=TIE_BREAK)
    for layer, name in whole.tables():
        assert rows_of(whole.read(spark, layer, name)) == rows_of(monthly.read(spark, layer, name)), (layer, name)
    features = whole.read(spark, "gold", "feature_store")
    months = {r[0].isoformat() for r in features.select("snapshot_date").distinct().collect()}
    assert months == {"1996-07-01", "1996-08-01"}
    assert whole.read(spark, "gold", "training_dataset").count() > 0


def test_counts_at_write_time_equal_a_scan(spark, smoke_dir):
    raw, mart = Inputs(spark, smoke_dir).raw(), datamart.Datamart(scratch_path(spark, "counted"))
    datamart.backfill(spark, raw, mart, "1997-01-01", "1997-04-30", TIE_BREAK)
    # One month again with fewer rows, one month more.
    fewer = raw | {"lms": raw["lms"].where("loan_id LIKE '%1'")}
    datamart.run_month(spark, fewer, mart, "1997-02-10", tie_break=TIE_BREAK)
    datamart.run_month(spark, raw, mart, "1997-05-01", tie_break=TIE_BREAK)
    tables_now = {t: mart.read(spark, *t) for t in mart.tables()}
    want = datamart.summary(tables_now, tables_now["gold", "training_dataset"])
    assert rows_of(datamart.mart_summary(spark, mart)) == rows_of(want)
    plan = datamart.mart_summary(spark, mart)._jdf.queryExecution().toString()
    assert "FileScan parquet" not in plan and plan.split("== Physical Plan ==")[1].count("FileScan json") <= 2 * 12
    # A table written without counts is counted.
    path = mart.path("silver", "lms")
    tables.rebuild_table(raw["lms"].where("loan_id LIKE '%3'"), path)
    found = {(r["layer"], r["table_name"]): r["row_count"] for r in datamart.mart_summary(spark, mart).collect()}
    assert found["silver", "lms"] == raw["lms"].where("loan_id LIKE '%3'").count()


def test_a_failing_source_leaves_other_branches_intact(spark, smoke_dir):
    raw, mart = Inputs(spark, smoke_dir).raw(), datamart.Datamart(scratch_path(spark, "failing"))
    broken = raw["clickstream"].withColumn("fe_1", F.raise_error(F.lit("no clicks today")).cast("double"))
    with pytest.raises(graph.StepsFailed, match="bronze.clickstream") as failure:
        datamart.backfill(spark, raw | {"clickstream": broken}, mart, "1997-01-01", "1997-01-31", TIE_BREAK)
    assert set(failure.value.failed) == {"bronze.clickstream"}
    assert set(failure.value.left_out) == {"silver.clickstream", "gold.feature_store", "gold.training_dataset"}
    assert mart.read(spark, "gold", "label_store").count() > 0 and mart.read(spark, "silver", "financials").count() > 0
    with pytest.raises(FileNotFoundError):
        mart.read(spark, "gold", "training_dataset")


def test_steps_run_together_and_in_order(spark):
    running, most, order = [], [], []

    def work(name):
        running.append(name)
        most.append(len(running))
        spark.range(100_000).selectExpr("sum(id)").collect()
        time.sleep(0.3)
        running.remove(name)
        order.append(name)

    needs = {"c": ["a", "b"], "a": [], "b": [], "d": ["c"], "e": ["a"]}
    graph.run_steps(spark, {n: graph.Step(d, lambda n=n: work(n)) for n, d in needs.items()})
    assert max(most) >= 2 and sorted(order) == list("abcde")
    assert all(order.index(d) < order.index(n) for n, of in needs.items() for d in of)
    with pytest.raises(ValueError, match="x"):
        graph.run_steps(spark, {"x": graph.Step(["nothing"], lambda: None)})


def test_month_ranges():
    month = datamart.DateRange.month("2024-08-15")
    assert (month.start, month.end) == ("2024-08-01", "2024-08-31")
    shifted = month.shift_months(-6)
    assert (shifted.start, shifted.end) == ("2024-02-01", "2024-02-29")


def test_scratch_on_one_machine_is_refused_on_a_cluster():
    refuse_own_disk("/warehouse/_scratch", "file", "local[4]")
    refuse_own_disk("hdfs:///warehouse/_scratch", "hdfs", "yarn")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        refuse_own_disk("/warehouse/_scratch", "file", "yarn")
