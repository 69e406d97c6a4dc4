import pytest
from pyspark.sql import functions as F

from arrears.llm.pivotal_mix import copies, mix, mixed, targets
from arrears.llm.queries import op3_pivotal_mix


def shares(sizes, weights=(5, 2, 1), most=3):
    """Targets by sharing again until none is above; ``sizes`` in order of the sources."""
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    capped = set()
    while True:
        rest = sum(sizes) - sum(most * sizes[i] for i in capped)
        open_weight = sum(w for i, w in enumerate(weight) if i not in capped)
        out = [most * s if i in capped else rest * w / open_weight for i, (s, w) in enumerate(zip(sizes, weight))]
        above = {i for i in range(len(sizes)) if i not in capped and out[i] > most * sizes[i]}
        if not above:
            return out
        capped |= above


@pytest.mark.parametrize("sizes", [[10, 20, 30], [1000, 1, 1, 1], [1, 1, 1000], [0, 5, 5], [7], [3, 900, 2, 1, 1, 50, 60], [100] * 9])
def test_targets_equal_sharing_again(spark, sizes):
    names = [f"s{i:02d}" for i in range(len(sizes) - 1)] + [None]
    rows = targets(spark.createDataFrame(list(zip(names, sizes)), "source string, source_size long")).collect()
    got = {r.source: r.target for r in rows}
    assert [got[n] for n in names] == pytest.approx(shares(sizes))


def test_query_meets_targets(spark, smoke_dir):
    rows = op3_pivotal_mix(spark, smoke_dir)
    assert rows.where("taken > 3 * size OR taken % greatest(size, 1) <> 0").count() == 0
    docs = spark.read.parquet(f"{smoke_dir}/documents.parquet").select("doc_id", "source")
    sums = rows.join(docs, "doc_id").groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("size").alias("most"), F.first("source_size").alias("size"))
    for r in sums.collect():
        assert abs(r.taken - r.target) <= r.most / 2 + 1e-6
    want = shares([r["size"] for r in sums.orderBy("source").collect()])
    assert [r.target for r in sums.orderBy("source").collect()] == pytest.approx(want)


def test_tree_of_many_levels_keeps_sums_and_expectations(spark):
    units = spark.range(6000).selectExpr("if(id % 3 = 0, 'a', null) AS source", "id AS doc_id", "id * 7 AS text_key", "1 + id % 50 AS size", "0.1 + (id % 8) / 10.0D AS p")
    got = copies(units, fan_in=8)
    assert got.count() == 6000 and got.where("p NOT IN (0, 1)").count() == 0
    after = {r.source: (r.w, r.n) for r in got.groupBy("source").agg(F.sum(F.col("p") * F.col("size")).alias("w"), F.count("*").alias("n")).collect()}
    before = {r.source: r.w for r in units.groupBy("source").agg(F.sum(F.col("p") * F.col("size")).alias("w")).collect()}
    assert all(abs(after[s][0] - w) <= 25.01 for s, w in before.items())
    rates = got.join(units.select("doc_id", F.col("p").alias("want")), "doc_id").groupBy("want").agg(F.avg("p").alias("rate"), F.count("*").alias("n")).collect()
    assert all(abs(r.rate - r.want) < 4 * (r.want * (1 - r.want) / r.n) ** 0.5 for r in rates)


def test_equal_results_however_partitioned(spark, smoke_dir):
    docs = spark.read.parquet(f"{smoke_dir}/documents.parquet")
    a, b = (sorted(map(tuple, mix(d).select("doc_id", "copies").collect())) for d in (docs, docs.repartition(7, "text")))
    assert a == b


def test_odd_rows(spark, odd_docs):
    docs = odd_docs.selectExpr("*", "9 AS copies", "'x' AS size", "0 AS p", "'y' AS __key", "1 AS __s", "2 AS __copies", "3 AS whole", "4 AS at", "5 AS rows")
    rows = mix(docs).collect()
    assert len(rows) == 9 and all(0 <= r.copies <= 3 for r in rows)
    equal = [r.copies for r in rows if r.doc_id == 5]
    assert len(equal) == 2 and max(equal) - min(equal) <= 1
    taken = mixed(docs)
    assert taken.columns == docs.columns and taken.count() == sum(r.copies for r in rows)
    assert mix(docs.limit(0)).count() == 0 and mixed(docs.limit(0)).count() == 0


@pytest.mark.parametrize("copied", [1, 2, 7, 1000])
def test_repeated_rows_meet_the_target(spark, copied):
    """One source is nothing but copies of one row; the other has different documents."""
    same = spark.range(copied).selectExpr("5L AS doc_id", "'b' AS source", "'one two three four five six seven eight nine ten' AS text")
    other = spark.range(copied).selectExpr("id + 10 AS doc_id", "'a' AS source", "concat('w', id, ' x y z') AS text")
    docs = same.union(other).repartition(5)
    rows = mix(docs).groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target"), F.count("*").alias("n"), F.max("size").alias("most"))
    for r in rows.collect():
        assert r.n == copied and abs(r.taken - r.target) <= r.most / 2 + 1e-6
    taken = mixed(docs)
    assert {(r.source, r["count"]) for r in taken.groupBy("source").count().collect()} == {(r.source, r.taken // r.most) for r in rows.collect() if r.taken}
