import hashlib
import random

import numpy as np
import pytest

from arrears.llm import deep_shallow
from arrears.llm.deep_shallow import remove_repeats, repeats_of
from arrears.llm.queries import op4_deep_shallow


def brute(rows, length=100):
    """(doc_id, n_bytes, n_removed, n_spans, sha) of rows in order of doc_id, by a set of all strings seen."""
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            window = data[i : i + length]
            if window in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(window)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def ordered(df):
    return sorted((tuple(r)[:5] for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[2]))


def test_query_equals_brute_force(spark, smoke_dir):
    rows = [(d.doc_id, d.text) for d in spark.read.parquet(f"{smoke_dir}/documents.parquet").collect()]
    got = ordered(op4_deep_shallow(spark, smoke_dir))
    assert got == brute(rows) and sum(r[2] for r in got) > 0


@pytest.mark.parametrize("hot", [1, 5, 2000])
@pytest.mark.parametrize("length", [24, 40, 100])
def test_periodic_and_shared_texts(spark, monkeypatch, hot, length):
    monkeypatch.setattr(deep_shallow, "HOT", hot)
    rng = random.Random(hot + length)
    passages = ["".join(rng.choice("abcde ") for _ in range(rng.randint(20, 400))) for _ in range(6)]
    rows = []
    for d in range(60):
        parts = [rng.choice(passages)[rng.randint(0, 9) :] if rng.random() < 0.5 else "".join(rng.choice("abé ") for _ in range(rng.randint(0, 120))) for _ in range(rng.randint(0, 6))]
        rows.append((d, "".join(parts) + rng.choice(["", "a" * 300, "abc" * 90, "xy" * 70])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert ordered(remove_repeats(docs, length)) == ordered_rows(brute(rows, length))


def ordered_rows(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2]))


def test_small_batches_give_the_same(spark, smoke_dir, monkeypatch):
    rows = [(d.doc_id, d.text) for d in spark.read.parquet(f"{smoke_dir}/documents.parquet").where("doc_id < 120").collect()]
    for name, value in (("HASHED_BYTES", 1000), ("COMBINED_BYTES", 5000), ("SORTED_PLACES", 3), ("HOT", 3)):
        monkeypatch.setattr(deep_shallow, name, value)
    assert ordered(remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))) == brute(rows)


def test_classes_equal_a_dictionary():
    rng = np.random.default_rng(2)
    for width, letters in ((24, 2), (100, 2), (33, 300)):
        strings = rng.integers(0, min(letters, 256), (400, width)).astype(np.uint8)
        strings[100:] = strings[rng.integers(0, 100, 300)]
        change = rng.integers(0, 400, 100)
        strings[change, rng.integers(width // 2, width, 100)] ^= 1
        group = rng.integers(0, 3, 400)
        name = repeats_of(strings, group)
        want = {}
        for i in range(400):
            want.setdefault((group[i], strings[i].tobytes()), set()).add(int(name[i]))
        assert all(len(v) == 1 for v in want.values())
        assert len({v.pop() for v in want.values()}) == len(want)


def test_odd_rows(spark, odd_docs):
    docs = odd_docs.selectExpr("*", "'x' AS uid", "1 AS z", "2 AS kept").coalesce(1)
    rows = [(d.doc_id, d.text) for d in odd_docs.collect()]
    got = remove_repeats(docs, 30, keep_bytes=True)
    assert ordered(got) == ordered_rows(brute(rows, 30))
    assert remove_repeats(docs.limit(0)).count() == 0
