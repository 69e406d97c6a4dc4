import zlib

import numpy as np
import pytest

from arrears.llm import attention_quality
from arrears.llm.attention_quality import FEATURES, Model, _forward, document_features, fit, score, train
from arrears.llm.queries import op10_attention_quality


def test_held_out_accuracy(spark, sf_dir="/root/testdata/sf0.01"):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = op10_attention_quality(spark, sf_dir).collect()
    assert len(rows) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    judged = [(r.score, r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = [s for s, _, y in judged if y], [s for s, _, y in judged if not y]
    assert np.mean([(g > b) + (g == b) / 2 for g in good for b in bad]) > 0.95
    assert np.mean([p == y for _, p, y in judged]) > 0.9


def test_held_out_labels_change_nothing(spark, smoke_dir):
    docs, labels = (spark.read.parquet(f"{smoke_dir}/{t}.parquet") for t in ("documents", "labels"))
    wrong = labels.selectExpr("doc_id", "if(crc32(cast(string(doc_id) AS binary)) % 5 = 0, 1 - quality, quality) AS quality")
    a, b = (train(docs, x, rounds=20).weights for x in (labels, wrong))
    assert all(np.array_equal(a[k], b[k]) for k in a)


def test_gradient_is_the_slope_of_the_loss():
    """One step of fitting lowers the loss about as the attention model promises: bags with one bad passage are found."""
    rng = np.random.default_rng(0)
    sizes = rng.integers(1, 9, 300)
    starts = np.cumsum(sizes) - sizes
    x = rng.normal(0, 1, (sizes.sum(), FEATURES)).astype(np.float32)
    y = rng.integers(0, 2, 300)
    for s, n, label in zip(starts, sizes, y):
        if not label:
            x[s + rng.integers(n), 3] += 6
    model = fit(x, starts, y, 300)
    found = model.scores(x, starts)
    assert np.mean((found >= 0.5) == y) > 0.95
    f = _forward(model.weights, model.prepared(x), starts)
    assert np.add.reduceat(f["a"], starts) == pytest.approx(np.ones(300))


def test_odd_rows(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1), (3, 0), (4, 1), (4, 0), (None, 1), (7, None)], "doc_id long, quality int")
    docs = odd_docs.selectExpr("*", "'x' AS score", "1 AS held_out")
    model = train(docs, labels, rounds=5)
    rows = score(docs, model).collect()
    assert len(rows) == 9 and all(0 <= r.score <= 1 for r in rows)
    by = {r.doc_id: r.score for r in rows}
    assert by[1] == by[2] == by[6] and by[4] == by[5]
    assert not next(r for r in rows if r.doc_id is None).held_out
    assert score(docs.limit(0), model).count() == 0
    empty = train(docs, labels.limit(0))
    assert isinstance(empty, Model) and {r.score for r in score(docs, empty).collect()} == {0.5}
    assert document_features("").shape == (1, FEATURES)


def test_training_keeps_to_its_characters(spark, monkeypatch):
    """Long texts are passed over, and what the driver gets follows the bound, not the texts."""
    docs = spark.range(60).selectExpr("id AS doc_id", "repeat(concat('word', id, ' '), if(id = 7, 100000, 100)) AS text")
    labels = docs.selectExpr("doc_id", "int(doc_id % 2) AS quality")
    seen = []
    monkeypatch.setattr(attention_quality, "fit", lambda x, starts, y, rounds: seen.append((len(x), len(starts))) or fit(x, starts, y, 1))
    for chars in (16_000_000, 20_000):
        monkeypatch.setattr(attention_quality, "TRAINING_CHARS", chars)
        attention_quality.train(docs, labels, rounds=1)
    (rows, bags), (few_rows, few_bags) = seen
    assert rows == 2 * bags and 40 < bags < 60 and few_rows < rows and few_bags * 650 <= 20_000


def test_content_tells_passages_of_equal_counts_apart():
    a, b = (document_features(" ".join([w] * 30)) for w in ("alpha", "omega"))
    assert np.array_equal(a[:, : attention_quality._COUNTS][:, [0, 1, 2]], b[:, : attention_quality._COUNTS][:, [0, 1, 2]]) and not np.array_equal(a, b)
