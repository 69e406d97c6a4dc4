import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from arrears.llm import wu_manber
from arrears.llm.queries import op13_wu_manber
from arrears.llm.wu_manber import Strings, decontaminate, item_pieces, words_of


def words(text):
    lowered = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(texts, items, window=10):
    """(words, hit words, items) by looking at every place."""
    wanted = {}
    for item, text in items:
        found = words(text)
        size = min(window, len(found))
        for i in range(len(found) - size + 1 if found else 0):
            wanted.setdefault(tuple(found[i : i + size]), set()).add(item)
    sizes, out = {len(w) for w in wanted}, []
    for text in texts:
        found, hit, of = words(text), set(), set()
        for size in sizes:
            for i in range(len(found) - size + 1):
                if tuple(found[i : i + size]) in wanted:
                    hit.update(range(i, i + size))
                    of |= wanted[tuple(found[i : i + size])]
        out.append((len(found), sorted(hit), sorted(str(x) for x in of if x is not None)))
    return out


def rows_of(df):
    return [(r.n_words, [w for run in r.hit_runs for w in range(run.start, run.end)], r["items"]) for r in df.collect()]


def test_query_equals_brute_force(spark, smoke_dir):
    docs = spark.read.parquet(f"{smoke_dir}/documents.parquet").collect()
    items = [tuple(r) for r in spark.read.parquet(f"{smoke_dir}/benchmark.parquet").select("item_id", "text").collect()]
    want = {
        d.doc_id: (n, len(hit), len(of), hashlib.sha256(",".join(of).encode()).hexdigest(), bool(hit))
        for d, (n, hit, of) in zip(docs, brute([d.text for d in docs], items))
    }
    got = {r.doc_id: tuple(r)[1:] for r in op13_wu_manber(spark, smoke_dir).collect()}
    assert got == want and any(r[-1] for r in got.values())


@pytest.mark.parametrize("seed", range(40))
def test_search_equals_brute_force(seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(wu_manber, "LANE", rng.choice([1, 7, 1024]))
    monkeypatch.setattr(wu_manber, "PAIRS", rng.choice([1, 1_000_000]))
    letters = ["a", "b", "É", "zz", "Long" * rng.randint(1, 20), "7"]

    def text(n):
        return "".join(rng.choice(letters) + rng.choice([" ", ", ", "\n", "--"]) for _ in range(n))

    items = [(str(i), text(rng.choice([0, 1, 2, 5, 9, 10, 11, 15, 30]))) for i in range(rng.randint(0, 6))]
    texts = [text(rng.choice([0, 1, 8, 10, 40, 300])) for _ in range(rng.randint(1, 5))] + [t for _, t in items[:2]] + [None, ""]
    pieces = [(i, b" " + b" ".join(found) + b" ", min(10, len(found))) for i, t in items if (found := words_of(t.encode()))]
    searched = Strings(pieces).search([None if t is None else t.encode() for t in texts])
    assert [(n, [w for a, b in runs for w in range(a, b)], sorted(of)) for n, runs, of in searched] == brute(texts, items)


def test_absent_blocks_are_skipped():
    """Places looked at are far fewer than bytes where the text shares nothing with the strings."""
    item = b" " + b" ".join(b"benchmark%d" % i for i in range(40)) + b" "
    table = Strings([("1", item, 10)]).classes[-1]
    assert table.shift.max() == table.prefix - table.block + 1 > 30
    assert (table.shift == table.shift.max()).mean() > 0.5


@pytest.mark.parametrize("block_bytes", [200, 2_000, 4_000_000])
def test_blocks_and_pieces_change_nothing(spark, block_bytes, monkeypatch):
    monkeypatch.setattr(wu_manber, "PIECE_WINDOWS", 7)
    rng = random.Random(9)
    texts = [" ".join(rng.choice("abcdefg") * rng.randint(1, 3) for _ in range(60)) for _ in range(30)]
    items = [(i, t[rng.randint(0, 40) :]) for i, t in enumerate(texts[:10])] + [(3, texts[11]), (None, texts[12]), (50, "aa"), (51, ""), (52, None)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    if block_bytes < 4_000_000:
        assert len(list(wu_manber.blocks(item_pieces(benchmark), block_bytes))) > 1
    assert rows_of(decontaminate(docs, benchmark, block_bytes=block_bytes)) == brute(texts, items)


def test_odd_rows(spark, odd_docs):
    items = [
        (1, "the same words in the same order again and again here", 0),
        (1, "漢字 😀 é", 0),
        (None, "word3 3", 0),
        (2, "DON'T", 0),
        (3, None, 0),
        (4, " .,- ", 0),
        (5, "the same words in the same order again and again here", 0),
        (5, "the same words in the same order again and again here", 0),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string, runs int")
    docs = odd_docs.coalesce(1).selectExpr("*", "'x' AS runs", "1 AS items", "2 AS n_words")
    texts = [d.text for d in docs.collect()]
    assert rows_of(decontaminate(docs, benchmark)) == brute(texts, [i[:2] for i in items])
    assert [r.doc_id for r in decontaminate(docs, benchmark).collect()] == [d.doc_id for d in docs.collect()]
    assert decontaminate(docs.limit(0), benchmark).count() == 0
    nothing = decontaminate(docs, benchmark.limit(0)).agg(F.count("*"), F.sum(F.size("hit_runs")), F.sum(F.size("items"))).first()
    assert tuple(nothing) == (9, 0, 0)
