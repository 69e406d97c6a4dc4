import math
import random
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from arrears.llm import uniform_threshold
from arrears.llm.queries import op2_uniform_threshold
from arrears.llm.uniform_threshold import top_k


def brute(rows, every, k):
    """All (query_id, rank, vec_id, score); every row is a candidate of every other row."""
    v = [(i, [math.floor(1024 * Fraction(x)) for x in e]) for i, e in rows if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for n, (q, x) in enumerate(v):
        if q % every == 0:
            products = ((sum(a * b for a, b in zip(x, y)), c) for m, (c, y) in enumerate(v) if m != n and len(x) == len(y))
            scores = sorted((-min(max(s, -(2**63)), 2**63 - 1), c) for s, c in products)
            out += [(q, r, c, -s) for r, (s, c) in enumerate(scores[:k], 1)]
    return sorted(out)


def test_query_equals_all_pairs(spark, smoke_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{smoke_dir}/embeddings.parquet").collect()]
    assert sorted(map(tuple, op2_uniform_threshold(spark, smoke_dir).collect())) == brute(rows, 100, 10)


@pytest.mark.parametrize("lists", [1, 2, 3, 5])
def test_ties_copies_and_small_blocks(spark, monkeypatch, lists):
    for name, value in (("GROUP", 3), ("BLOCK", 11), ("CHUNK", 4)):
        monkeypatch.setattr(uniform_threshold, name, value)
    rng = random.Random(lists)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, 1.0]) for _ in range(rng.choice([0, 4, 4, 4, 7]))]) for i in range(90)]
    rows += [(i, [1.0, 1.0, 1.0, 1.0]) for i in range(100, 130)] + [(-5, [-1.0] * 4)]
    got = top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), 5, 4, lists)
    assert sorted(map(tuple, got.collect())) == brute(rows, 5, 4)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 0.0]), (None, [9.0, 9.0]), (5, [0.5, -1.0]), (10, [3e9, 3e5]), (15, []), (20, [0.1])]
    frame = spark.createDataFrame([(i, e, "x") for i, e in rows], "vec_id long, embedding array<double>, rank string")
    assert sorted(map(tuple, top_k(frame, 10, 3).collect())) == brute(rows, 10, 3)
    assert sorted(map(tuple, top_k(frame.union(frame), 10, 3).collect())) == brute(rows + rows, 10, 3)
    assert top_k(frame.limit(0)).count() == 0


def test_repeated_ids_are_rows_of_their_own(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(12), [rng.choice([-1.0, 0.5, 2.0]) for _ in range(3)]) for _ in range(60)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    assert sorted(map(tuple, top_k(frame, 3, 4).collect())) == brute(rows, 3, 4)


@pytest.mark.parametrize("size", [1e4, 9.1e15, 1e10, 1e200, 1.7e308])
def test_large_components_are_exact_and_scores_end_with_the_longs(spark, size):
    rng = random.Random(int(size) % 997)
    rows = [(i, [rng.choice([-1, 1]) * size / rng.randint(1, 9) * (i % 4 > 0) + rng.random(), rng.random()]) for i in range(40)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, top_k(frame, 5, 6).collect())) == brute(rows, 5, 6)


def test_low_scores_of_queries_without_a_cutoff(spark):
    rows = [(0, [1e6, 1e6]), (1, [-1e4, -1e4]), (2, [-1e6, -1e6]), (3, [1.0, 0.0]), (10, [5.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, top_k(frame, 10, 10).collect()))
    assert got == brute(rows, 10, 10) and [r[2] for r in got] == [3, 1, 2]


class Shared:
    def __init__(self, value):
        self.value = value


def test_the_cutoff_saves_products_and_entries():
    """Of all pairs the two phases resolve few, and phase two sends on little more than the result."""
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(4_000, 16)) * rng.gamma(2, 1, size=(4_000, 1))
    schema = pa.schema([("row", pa.int64()), ("vec_id", pa.int64()), ("dim", pa.int32()), ("v", pa.binary())])
    table = pa.Table.from_pylist([{"row": i, "vec_id": i, "dim": 16, "v": x.astype("<f8").tobytes()} for i, x in enumerate(vectors)], schema)
    group = uniform_threshold.Queries(table.slice(0, 40))
    parts, resolved = [table.slice(i, 500).to_batches() for i in range(0, 4_000, 500)], {1: 0, 2: 0}
    sent = {}
    for phase in (1, 2):
        count = lambda n, p=phase: resolved.__setitem__(p, resolved[p] + n)
        out = [b for part in parts for b in uniform_threshold.search(Shared(group), 10, 2, phase, count)(iter(part))]
        sent[phase] = pa.Table.from_batches(out)
        if phase == 1:
            scores = {}
            for q, s in zip(sent[1].column("query").to_pylist(), sent[1].column("score").to_pylist()):
                scores.setdefault(q, []).append(s)
            group.cutoffs = {q: sorted(s)[-10] for q, s in scores.items()}
    assert resolved[1] < 40 * 4_000 * 0.06 and resolved[2] < 40 * 4_000 * 0.06
    assert sent[2].num_rows < 40 * 12 < sent[1].num_rows
    integers = group.by_dim[16][2]
    bound = np.array([group.cutoffs[i] for i in range(40)])
    near = uniform_threshold.within_reach(integers, np.floor(1024 * vectors), bound, np.ones(40, bool), 2)
    assert near.mean() < 0.9
