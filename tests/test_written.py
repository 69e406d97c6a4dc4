"""What queries and plans write and move on the way, on a few made rows."""

import datetime
import glob

import pytest
from pyspark.sql import functions as F

from arrears.plans import datamart
from arrears.sources import tables as stored_tables
from workload import table_queries
from workload.fixtures import Inputs


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Forty orders of ten customers, with six instalments each."""
    folder = tmp_path_factory.mktemp("tables")
    day = datetime.date(1996, 1, 15)
    made = {
        "customer": ([(i, f"c{i}", 1.5 * i, "BUILDING") for i in range(10)], "c_custkey long, c_name string, c_acctbal double, c_mktsegment string"),
        "orders": ([(i, i % 10, "F", 100.0 + i, day + datetime.timedelta(31 * (i % 6)), "1-URGENT") for i in range(40)], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate date, o_orderpriority string"),
        "lineitem": ([(i, n, 5.0, 10.0 * n, 0.1, "R" if i % 3 else "N") for i in range(40) for n in range(1, 7)], "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_returnflag string"),
        "embeddings": ([(i, [0.1 * i] * 32) for i in range(4)], "vec_id long, embedding array<float>"),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_csv_sources_are_packed(spark, tables, monkeypatch, tmp_path):
    monkeypatch.setattr(table_queries, "scratch_path", lambda spark, name: str(tmp_path / name))
    found = {r["source"]: (r["row_count"], r["customers"]) for r in table_queries.scan_csv(spark, tables).collect()}
    assert found == {"clickstream": (40, 10), "attributes": (40, 10), "financials": (40, 10), "lms": (240, 10)}
    files = glob.glob(f"{tmp_path}/raw/*/part-*")
    assert files and all(f.endswith(".csv.gz") for f in files)


def test_tables_of_the_same_months_are_written_in_place(spark, tables, monkeypatch, tmp_path):
    """The ledger and the labels are written without a shuffle, and hold every row."""
    moved = []
    write = datamart.write_counted

    def watched(writer, df, path, *args):
        def told(rows, target, by):
            gathered = getattr(writer, "keywords", {}).get("gathered", False)
            moved.append((path.split("/")[-2:], gathered))
            return writer(rows, target, by)

        return write(told, df, path, *args)

    monkeypatch.setattr(datamart, "write_counted", watched)
    mart = datamart.Datamart(str(tmp_path / "mart"))
    datamart.backfill(spark, Inputs(spark, tables).raw(), mart, tie_break=["src_seq"])
    assert {tuple(t) for t, gathered in moved if gathered} == {("silver", "lms"), ("gold", "label_store")}
    counts = {(r["layer"], r["table_name"]): r["row_count"] for r in datamart.mart_summary(spark, mart).collect()}
    assert counts["bronze", "lms"] == counts["silver", "lms"] == 240
    assert counts["gold", "label_store"] == counts["gold", "training_dataset"] == 40


def _mart(spark, tables, path):
    mart = datamart.Datamart(str(path))
    datamart.backfill(spark, Inputs(spark, tables).raw(), mart, tie_break=["src_seq"])
    return mart


def _shuffle_files(spark):
    folder = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {name for name in folder.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in name}


def test_shuffle_files_go_with_the_table_they_were_for(spark, tables, tmp_path):
    before = _shuffle_files(spark)
    _mart(spark, tables, tmp_path / "mart")
    assert _shuffle_files(spark) <= before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def _rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_dealt_rows_are_written_where_they_are(spark, tables, monkeypatch, tmp_path):
    """Customer sources, features and training rows move once, and are the rows that came of two moves."""
    written = {}
    write = datamart.write_counted

    def watched(writer, df, path, *args):
        plan = df._jdf.queryExecution().executedPlan().toString()
        written[tuple(path.split("/")[-2:])] = (getattr(writer, "keywords", {}).get("is_dealt", False), plan.count("Exchange"))
        return write(writer, df, path, *args)

    monkeypatch.setattr(datamart, "write_counted", watched)
    monkeypatch.setattr(datamart, "MOST_ROWS", 0)
    monkeypatch.setattr(stored_tables, "ROWS_A_TASK", 20)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        mart = _mart(spark, tables, tmp_path / "mart")
        assert {t for t, (is_dealt, _) in written.items() if is_dealt} == {*(("silver", s) for s in datamart.FEATURE_SOURCES), ("gold", "feature_store"), ("gold", "training_dataset")}
        assert [written["silver", s][1] for s in datamart.FEATURE_SOURCES] == [1, 1, 1]
        assert (written["gold", "feature_store"][1], written["gold", "training_dataset"][1]) == (3, 2)
        made = {t: _rows(mart.read(spark, *t)) for t in mart.tables()}
        written.clear()
        monkeypatch.setattr(datamart, "MOST_ROWS", 1 << 60)
        monkeypatch.setattr(datamart, "deals_evenly", lambda *args: False)
        plain = _mart(spark, tables, tmp_path / "plain")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {t for t, (is_dealt, _) in written.items() if is_dealt} == {("gold", "feature_store")}
    assert made == {t: _rows(plain.read(spark, *t)) for t in plain.tables()}


def test_rows_are_dealt_by_partition_and_key(spark, monkeypatch):
    monkeypatch.setattr(stored_tables, "ROWS_A_TASK", 100)
    days = {f"2024-0{m}-01": 50 * m for m in range(1, 5)}
    made = [(f"c{i % 40}" if i % 7 else None, datetime.date.fromisoformat(day)) for day, n in days.items() for i in range(n)]
    df = spark.createDataFrame([*made, ("c1", datetime.date(2030, 1, 1)), ("c2", None)], "customer string, day date")
    dealt = stored_tables.dealt(df, days, "day", ["customer"])
    found = dealt.groupBy("_part", "day", "customer").count().collect()
    assert sum(r["count"] for r in found) == 502
    # A key lies in one task, and a task has neighbouring days.
    assert len({(r["day"], r["customer"]) for r in found}) == len(found)
    assert {r["_part"] for r in found} <= set(range(5)) and dealt.rdd.getNumPartitions() == 5
    order = [max(r["_part"] for r in found if str(r["day"]) == day) for day in days]
    assert order == sorted(order) and max(r["_part"] for r in found if str(r["day"]) == "2024-01-01") == 0
    assert dealt.select((F.spark_partition_id() == F.col("_part")).alias("there")).distinct().collect() == [(True,)]


def test_a_frequent_key_is_not_dealt_to_one_task(spark, monkeypatch):
    monkeypatch.setattr(stored_tables, "MOST_ROWS", 100)
    monkeypatch.setattr(stored_tables, "ROWS_A_TASK", 50)
    day = datetime.date(2024, 1, 1)
    spread = spark.createDataFrame([(f"c{i}", day) for i in range(400)], "customer string, day date")
    hot = spark.createDataFrame([("c1" if i % 2 else f"c{i}", day) for i in range(400)], "customer string, day date")
    assert stored_tables.deals_evenly(spread, {"2024-01-01": 400}, "day", ["customer"])
    assert not stored_tables.deals_evenly(hot, {"2024-01-01": 400}, "day", ["customer"])
    assert not stored_tables.deals_evenly(hot.limit(0), {}, "day", ["customer"])
