"""Full-batch descent against its steps one by one, and first-order conditions."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from arrears.operators import descent
from arrears.operators.optimality import descent_left
from arrears.operators.scoring import logistic


def steps(x, y, l2, rate, epochs):
    w, rate_of_ones = np.zeros(x.shape[1]), min(max(y.mean(), 1e-4), 1 - 1e-4)
    b = np.log(rate_of_ones / (1 - rate_of_ones))
    for _ in range(epochs):
        error = 1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30))) - y
        w, b = w - rate * (x.T @ error / len(y) + l2 * w), b - rate * error.mean()
    return w, b


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(700, 9))
    x[:, 3] = 0.95 * x[:, 2] + 0.05 * x[:, 3]
    x[:, 6:] = x[:, 6:] > 0.8
    y = (rng.random(700) < 1 / (1 + np.exp(1.5 - 2 * x[:, 0] - x[:, 1] + 2 * x[:, 7]))).astype(float)
    names = [f"c{i}" for i in range(9)]
    return x, y, names, spark.createDataFrame(pd.DataFrame(np.column_stack([x, y]), columns=[*names, "label"])).repartition(3)


def test_descent_equals_its_steps(data, monkeypatch):
    x, y, names, df = data
    blocks, passes = descent.blocks_of(df, names, "label", 64).cache(), []
    whole = descent.derivatives
    monkeypatch.setattr(descent, "derivatives", lambda *a: passes.append(len(a[1])) or whole(*a))
    penalties = {"light": 0.01, "heavy": 0.1, "none": 0.0}
    found = descent.descend(blocks, penalties, 9, 0.08, 900)
    assert len(passes) < 60 and passes[2] == 3
    for name, l2 in penalties.items():
        w, b = steps(x, y, l2, 0.08, 900)
        assert np.abs(found[name][0] - w).max() < 1e-4 and abs(found[name][1] - b) < 1e-4
    for epochs in (0, 1, 7):
        (w, b), want = descent.descend(blocks, {"a": 0.05}, 9, 0.08, epochs)["a"], steps(x, y, 0.05, 0.08, epochs)
        assert np.abs(w - want[0]).max() < 1e-4 and abs(b - want[1]) < 1e-4


def test_one_class_and_no_rows(data):
    x, _, names, df = data
    ones = descent.blocks_of(df.withColumn("label", F.lit(1.0)), names, "label")
    w, b = descent.descend(ones, {"a": 0.1}, 9, 0.08, 20)["a"]
    want = steps(x, np.ones(len(x)), 0.1, 0.08, 20)
    assert np.abs(w - want[0]).max() < 1e-6 and b == pytest.approx(want[1], abs=1e-6)
    w, b = descent.descend(descent.blocks_of(df.limit(0), names, "label"), {"a": 0.1}, 9, 0.08, 5)["a"]
    assert not w.any() and b == 0.0


def test_first_order_condition_tells_fitted_from_perturbed(data):
    x, y, names, df = data
    w, b = steps(x, y, 0.1, 0.5, 4000)
    inputs = F.array(*[F.col(c) for c in names]).alias("inputs")

    def left(weights, intercept):
        scored = df.select("label", inputs, F.expr(logistic(descent.margin_sql(weights, intercept, names))).alias("prediction_score"))
        return descent_left(scored, weights, 0.1).first()["left"]

    assert left(w, b) < 1e-4
    assert left(w + 0.1, b) > 0.1 and left(w, b + 0.5) > 0.1
    rate = y.mean()
    assert left(np.zeros(9), np.log(rate / (1 - rate))) == pytest.approx(1.0)


def test_a_worker_gets_few_blocks_at_once(spark, monkeypatch):
    """However many blocks a partition holds, the bytes handed to Python at once are bounded, and the sums are whole."""
    seen = []
    whole = descent._sums

    def sums(weights):
        add = whole(weights)

        def watched(batches):
            sizes = []

            def counted():
                for batch in batches:
                    sizes.append(batch.nbytes)
                    yield batch

            yield from add(counted())
            assert max(sizes) < 2 * descent.BATCH_BYTES and len(sizes) > 2

        seen.append(1)
        return watched

    monkeypatch.setattr(descent, "_sums", sums)
    names = [f"c{i}" for i in range(40)]
    df = spark.range(0, 60_000, 1, 1).select(*[(F.col("id") % (i + 2)).cast("double").alias(n) for i, n in enumerate(names)], (F.col("id") % 2).cast("double").alias("label"))
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    n, positive, _, _ = descent.derivatives(descent.blocks_of(df, names, "label").cache(), [np.zeros(41)])[0]
    assert (n, positive) == (60_000, 30_000) and seen
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before
