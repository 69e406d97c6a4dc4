"""Order statistics, AUC, average precision and PSI against brute force, with and without splitting."""

import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from arrears.operators import discrimination, features, ordered, splits, stability


def brute_auc(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    if not pos or not neg:
        return None
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


def brute_ap(pairs):
    total = sum(y for _, y in pairs)
    if not total:
        return 0.0
    ap = 0.0
    for s in {s for s, _ in pairs}:
        above = [y for t, y in pairs if t >= s]
        ap += sum(y for t, y in pairs if t == s) * sum(above) / len(above)
    return ap / total


def plan_of(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


@pytest.fixture(scope="module")
def scored():
    """Ties, a score held by a third of all rows, one group without positives, one tiny group."""
    rng = random.Random(7)
    rows = []
    for g in ("a", "b"):
        for _ in range(900):
            s = 0.25 if rng.random() < 0.33 else (rng.random() ** 4 if g == "a" else round(rng.random(), 2))
            rows.append((g, s, int(rng.random() < 0.2 + 0.5 * s)))
    rows += [("c", rng.random(), 0) for _ in range(40)] + [("d", 0.5, 1)]
    return rows


@pytest.mark.parametrize("rows_per_range", [1_000_000, 20])
def test_ranking_metrics_match_brute_force(spark, scored, rows_per_range):
    df = spark.createDataFrame(scored, "g string, prediction_score double, label int").repartition(7)
    found = {r["g"]: r for r in discrimination.ranking_metrics(df, ["g"], rows_per_range=rows_per_range).collect()}
    for g in "abcd":
        pairs = [(s, y) for h, s, y in scored if h == g]
        expected = brute_auc(pairs)
        assert found[g]["n_rows"] == len(pairs)
        assert found[g]["auc"] is None if expected is None else found[g]["auc"] == pytest.approx(expected)
        assert found[g]["average_precision"] == pytest.approx(brute_ap(pairs))
    everything = discrimination.classification_metrics(df).first()
    assert everything["auc"] == pytest.approx(brute_auc([(s, y) for _, s, y in scored]))
    assert everything["accuracy"] == pytest.approx(np.mean([(s >= 0.5) == y for _, s, y in scored]))


@pytest.mark.parametrize("rows_per_range", [1_000_000, 20])
def test_exact_quantiles_match_numpy(spark, scored, rows_per_range):
    df = spark.createDataFrame(scored, "g string, s double, y int")
    probabilities = [0.0, 0.1, 0.5, 0.77, 1.0]
    found = {r["g"]: r["quantiles"] for r in ordered.exact_quantiles(df, ["g"], "s", probabilities, rows_per_range).collect()}
    for g in "abcd":
        assert found[g] == pytest.approx(np.quantile([s for h, s, _ in scored if h == g], probabilities))


def test_bits_are_those_of_the_number(spark):
    rng = random.Random(11)
    numbers = [0.0, -0.0, 1.0, 2.0, 0.5, math.nextafter(1.0, 0.0), math.nextafter(1.0, 2.0), 5e-324, 2.2250738585072014e-308, math.nextafter(2.2250738585072014e-308, 0.0), 1.7976931348623157e308, float("inf")]
    numbers += [math.ldexp(1 + rng.choice([0, 2**-52, rng.random()]), rng.randint(-1022, 1023)) for _ in range(2000)]
    numbers += [math.nextafter(2.0**e, 0.0) for e in range(-300, 300)]
    numbers += [-x for x in numbers]
    found = spark.createDataFrame([(x,) for x in numbers], "x double").selectExpr("x", f"{ordered.order_bits('x')} AS b").collect()
    for r in found:
        bits = struct.unpack("<q", struct.pack("<d", abs(r.x)))[0]
        assert r.b == (-bits if r.x < 0 else bits), r.x
    assert spark.sql(f"SELECT {ordered.order_bits('double(chr(78)||chr(97)||chr(78))')} > {ordered.order_bits('double(1e308)')} AS b").first().b


def test_heavy_ranges_are_divided(spark):
    """Half of the values lie in one range of leading bits, a third of the rows on one value."""
    rng = random.Random(3)
    near = [0.5 + rng.random() * 2**-20 for _ in range(400)]
    rows = [("a", x, rng.randint(0, 1)) for x in near + [rng.random() - 0.5 for _ in range(300)] + [near[7]] * 350]
    df = spark.createDataFrame(rows, "g string, prediction_score double, label int")
    counts = ordered.value_counts(df, ["g"], "prediction_score", {"n": F.lit(1)}).withColumn("_bits", F.expr(ordered.order_bits("prediction_score")))
    for per, most in ((1_000_000, 400), (20, 20)):
        ranged = ordered.with_ranges(counts, ["g"], per).groupBy("_range").agg(F.count("*").alias("n"), F.min("_bits").alias("lo"), F.max("_bits").alias("hi")).orderBy("_range").collect()
        assert max(r.n for r in ranged) <= most
        assert all(a.hi < b.lo for a, b in zip(ranged, ranged[1:]))
        found = discrimination.ranking_metrics(df, ["g"], rows_per_range=per).first()
        assert found["auc"] == pytest.approx(brute_auc([r[1:] for r in rows]))


@pytest.mark.parametrize("listed", [5000, 3])
@pytest.mark.parametrize("accuracy", [2000, 10])
def test_medians_are_exact_on_ties_and_any_order(spark, listed, accuracy):
    rng = random.Random(8)
    columns = {
        "sorted_up": [float(i) for i in range(999)],
        "sorted_down": [float(-i) for i in range(999)],
        "saw": [float(i % 2 * 1000 + i // 2) for i in range(999)],
        "two_halves": [1.0] * 500 + [2.0] * 499,
        "heavy": [rng.choice([0.25, rng.random()]) for _ in range(999)],
        "with_nulls": [None if i % 3 else rng.gauss(0, 1e9) for i in range(999)],
        "empty": [None] * 999,
        "one": [None] * 998 + [7.0],
    }
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} double" for c in columns)).repartition(5)
    found = ordered.exact_medians(df, list(columns), accuracy, listed)
    for c, values in columns.items():
        present = [x for x in values if x is not None]
        assert found[c] == (pytest.approx(np.median(present), rel=1e-15) if present else None), c
    even = ordered.exact_medians(df.where("two_halves = 2 OR sorted_up < 499"), ["two_halves", "sorted_up"], accuracy, listed)
    assert even["two_halves"] == 1.5


def test_no_cell_is_exploded_for_medians(spark, monkeypatch):
    plans = []
    agg = type(spark.range(1)).agg
    monkeypatch.setattr(type(spark.range(1)), "agg", lambda self, *a: plans.append(agg(self, *a)) or plans[-1])
    features.column_medians(spark.range(3000).selectExpr("double(id % 97) AS x", "rand(1) AS y"), ["x", "y"], accuracy=100, listed=10)
    assert len(plans) >= 3 and not any("Generate" in plan_of(p) or "Expand" in plan_of(p) or "Sort" in plan_of(p).replace("SortAggregate", "") for p in plans)


@pytest.mark.parametrize("listed", [5000, 1])
def test_cut_of_a_share_by_radix_selection(spark, listed):
    rng = random.Random(6)
    rows = [(y, rng.randrange(2**60)) for y in (0, 1) for _ in range(300)] + [(1, 5)] * 250 + [(2, 7), (None, 3), (0, None)]
    df = spark.createDataFrame(rows, "y int, h long")
    for share in (0.0, 0.2, 0.5, 0.8, 1.0):
        found = ordered.share_cuts(df, "y", "h", share, listed=listed)
        for y in (0, 1, 2):
            values = sorted(h for z, h in rows if z == y and h is not None)
            rank = math.floor(share * len(values) + 0.5)
            assert found[y] == (values[rank - 1] if rank else None)


def test_splits_move_no_rows(spark):
    df = spark.range(3000).selectExpr("id", "int(id % 3 = 0) AS label", "add_months(date'2024-01-01', int(id % 14)) AS label_snapshot_date")
    day = F.lit("2025-03-01").cast("date")
    for split in (splits.stratified_split(df, ["id"]), splits.window_split(df, day, ["id"])):
        assert "Exchange" not in plan_of(split)


def test_no_plain_row_meets_all_others_in_one_task(spark):
    df = spark.range(5000).selectExpr("cast(id * 37 % 5000 AS double) AS s")
    plan = plan_of(ordered.exact_quantiles(df, [], "s", [0.5]))
    ordered_by_value = [line for line in plan.splitlines() if "Window" in line and "s#" in line.split("windowspecdefinition")[-1]]
    assert all("_range" in line for line in ordered_by_value)


def psi(spark, reference, actual, bins):
    fitted = stability.fit_reference(spark.createDataFrame([(x,) for x in reference], "score double"), bins=bins)
    return stability.population_stability(spark.createDataFrame([(x,) for x in actual], "prediction_score double"), fitted).first()


def test_psi_by_hand(spark):
    # Edges 0, 0.5, 1 with half of the reference each; 1.0 lies in the last bin, two scores lie outside.
    found = psi(spark, [0.0, 0.2, 0.8, 1.0], [0.1, 0.5, 1.0, 1.2, -0.1], 2)
    assert found["score_psi"] == pytest.approx(0.115524530, abs=1e-8) and found["n_out_of_range"] == 2
    # An empty bin counts with the floor of one millionth.
    assert psi(spark, [0.0, 0.2, 0.8, 1.0], [0.1, 0.2], 2)["score_psi"] == pytest.approx(6.90774216, abs=1e-6)
    # A constant reference has equal steps on [0, 1]; all mass moves from one bin to another.
    assert psi(spark, [0.3] * 5, [0.95, 0.99], 10)["score_psi"] == pytest.approx(27.6309935, abs=1e-5)
    # Ties: quantiles 0, 0, 1 leave two edges, so equal steps again; same shares, no shift.
    assert psi(spark, [0.0, 0.0, 0.0, 1.0], [0.0, 0.01, 0.02, 1.0], 2)["score_psi"] == pytest.approx(0.0, abs=1e-12)


def test_psi_of_itself_is_zero(spark, scored):
    df = spark.createDataFrame(scored, "g string, prediction_score double, y int")
    fitted = stability.fit_reference(df, "prediction_score")
    assert stability.population_stability(df, fitted).first()["score_psi"] == pytest.approx(0.0, abs=1e-12)


def test_medians_and_moments(spark):
    rows = [(1.0, 5.0, "a"), (2.0, 5.0, "a"), (3.0, 5.0, None), (10.0, None, "b")]
    df = spark.createDataFrame(rows, "x double, y double, c string")
    assert {r[0]: r[1] for r in features.column_medians(df, ["x", "y"]).collect()} == {"x": 2.5, "y": 5.0}
    moments = {r["column_name"]: r for r in features.column_moments(df, ["x", "y"]).collect()}
    assert moments["x"]["mean"] == 4.0 and moments["x"]["std"] == pytest.approx(np.std([1, 2, 3, 10], ddof=1))
    assert moments["y"]["std"] == 1.0
    levels = features.category_levels(df, ["c"], 0.3).collect()
    assert [(r["level"], r["row_count"]) for r in levels] == [("a", 2)]


def test_preprocessing_fills_scales_and_encodes(spark):
    rows = [(1.0, "a'b"), (2.0, None), (3.0, "a'b"), (None, "c")]
    df = spark.createDataFrame(rows, "x double, c string")
    prepared = features.fit_preprocessing(df, ["x"], ["c"])
    out = prepared.transformer.transform(df).collect()
    x = np.array([1.0, 2.0, 3.0, 2.0])
    assert [r["std_x"] for r in out] == pytest.approx(list((x - x.mean()) / x.std(ddof=1)))
    assert prepared.levels == {"c": ["a'b", "c", "missing"]}
    assert [r["oh_c_0"] for r in out] == [1.0, 0.0, 1.0, 0.0] and [r["oh_c_2"] for r in out] == [0.0, 1.0, 0.0, 0.0]


def test_splits_do_not_depend_on_partitioning(spark):
    df = spark.range(2000).selectExpr("id", "cast(id % 5 = 0 AS int) AS label")
    for split in (
        lambda d: splits.random_split(d, ["id"]),
        lambda d: splits.stratified_split(d, ["id"]),
        lambda d: splits.stratified_split(d, ["id"], rows_per_range=50),
    ):
        a = {tuple(r) for r in split(df.repartition(3)).select("id", "split").collect()}
        b = {tuple(r) for r in split(df.repartition(11)).select("id", "split").collect()}
        assert a == b
    sizes = splits.stratified_split(df, ["id"]).groupBy("label", "split").count().collect()
    assert {(r["label"], r["split"]): r["count"] for r in sizes} == {(0, "train"): 1280, (0, "test"): 320, (1, "train"): 320, (1, "test"): 80}


def test_temporal_split_falls_back(spark):
    rows = [(f"L{i}", i % 2, "2024-01-01") for i in range(200)]
    df = spark.createDataFrame(rows, "loan_id string, label int, d string").select("loan_id", "label", F.col("d").cast("date").alias("label_snapshot_date"))
    by_date = splits.temporal_split(df.withColumn("label_snapshot_date", F.expr("if(label = 1 OR loan_id < 'L5', date'2023-01-01', label_snapshot_date)")), "2023-06-01")
    assert splits.split_sizes(by_date)["test"]["classes"] == 1
    at_random = splits.temporal_split(df, "2020-01-01")
    assert splits.split_sizes(at_random)["train"]["classes"] == 2
    with pytest.raises(ValueError):
        splits.temporal_split(df.filter("label = 0"), "2020-01-01")


def test_stratified_fallback_and_reused_row(spark):
    def frame(labels):
        return spark.createDataFrame([(f"L{i}", y) for i, y in enumerate(labels)], "loan_id string, label int").withColumn("label_snapshot_date", F.lit("2024-01-01").cast("date"))

    # One positive among few rows: the random split leaves a side without it for some sizes.
    seen = set()
    for n in range(2, 14):
        marked = splits.temporal_split(frame([1, 1] + [0] * n), "2020-01-01", min_test_classes=2) if n > 8 else splits.temporal_split(frame([1] + [0] * n), "2020-01-01")
        sizes = splits.split_sizes(marked)
        assert sizes["train"]["classes"] == 2 and sizes["test"]["rows"] >= 1
        seen.add(marked.count() - (n + (2 if n > 8 else 1)))
    assert seen <= {0, 1}
    # Two rows, one of each class: all are needed for training, so one is tested again.
    both = splits.temporal_split(frame([1, 0]), "2020-01-01")
    assert both.groupBy("split").count().orderBy("split").collect()[0]["count"] == 1 and both.count() == 3


def test_share_of_a_random_split_is_not_rounded(spark):
    df = spark.range(200_000)
    share = splits.random_split(df, ["id"], 0.805).where("split = 'train'").count() / 200_000
    assert abs(share - 0.805) < 0.003


def test_complement(spark):
    df = spark.range(10)
    assert sorted(r[0] for r in splits.complement(df, df.filter("id < 7"), ["id"]).collect()) == [7, 8, 9]
