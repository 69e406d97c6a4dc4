import random

import numpy as np
import pytest
import xxhash

from arrears.llm.components import components
from arrears.llm.queries import op5_simhash_balls
from arrears.llm.simhash_balls import Buckets, close_pairs, fingerprint, hang, keep_one, links, near_duplicates


def brute(pairs):
    """(doc_id, fingerprint, component_id) from all pairs."""
    root = {d: d for d, _ in pairs}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for i, (a, x) in enumerate(pairs):
        for b, y in pairs[:i]:
            if (x ^ y).bit_count() <= 3:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return sorted((d, format(f, "016x"), find(d)) for d, f in pairs)


def plain_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text).replace("\t", " ").replace("\n", " ").split(" ") if w]
    grams = [words[i : i + 3] for i in range(len(words) - 2)] if len(words) > 2 else [words] if words else []
    hashes = [xxhash.xxh64_intdigest(" ".join(g).encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_query_equals_all_pairs(spark, smoke_dir):
    docs = spark.read.parquet(f"{smoke_dir}/documents.parquet").collect()
    got = sorted(map(tuple, op5_simhash_balls(spark, smoke_dir).collect()))
    assert got == brute([(d.doc_id, plain_fingerprint(d.text)) for d in docs])
    assert len({c for *_, c in got}) < len(got)


@pytest.mark.parametrize("bits", [1, 4, 11])
def test_no_close_pair_is_missed(bits):
    rng, base = random.Random(bits), random.Random(7).getrandbits(64)
    near = {base}
    while len(near) < 150:
        flip = sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4)))
        near.add(rng.choice(sorted(near)) ^ flip)
    fps = np.array(sorted(near), np.uint64)
    buckets, found = Buckets(bits, 3), set()
    for bucket in range(1 << bits):
        a, b = close_pairs(*buckets.variants(fps, bucket), fps, 3)
        found |= set(zip(a.tolist(), b.tolist()))
    want = {(i, j) for j in range(len(fps)) for i in range(j) if (int(fps[i]) ^ int(fps[j])).bit_count() <= 3}
    assert found == want


def test_links_connect_what_all_pairs_connect(spark):
    rng = random.Random(3)
    fps = {rng.getrandbits(64) for _ in range(100)}
    for f in list(fps):
        fps |= {f ^ sum(1 << b for b in rng.sample(range(64), 3)) for _ in range(3)}
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    edges = links(spark.createDataFrame([(s,) for s in signed], "fp long"))
    found = dict(map(tuple, components(edges).collect()))
    place = {s: i for i, s in enumerate(signed)}
    a, b = zip(*[(i, j) for j in range(len(fps)) for i in range(j) if (fps[i] ^ fps[j]).bit_count() <= 3])
    root = hang(np.array(a), np.array(b), len(fps))
    groups = {}
    for s in signed:
        groups.setdefault(found.get(s, s), set()).add(s)
    want = {}
    for s in signed:
        want.setdefault(int(root[place[s]]), set()).add(s)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_components_of_long_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1050)] + [(5, 5), (None, 3), (1, 0), (0, 1)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(61)}, **{i: 1000 for i in range(1000, 1050)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_rows(spark, odd_docs):
    docs = odd_docs.selectExpr("*", "'x' AS fp", "1 AS component_id", "2 AS least")
    rows = near_duplicates(docs).collect()
    assert len(rows) == odd_docs.count()
    of = {r.doc_id: r for r in rows}
    assert of[1].fingerprint == of[2].fingerprint == of[6].fingerprint == "0" * 16
    assert of[6].component_id == of[2].component_id == 1
    assert of[5].component_id == of[4].component_id == 4
    assert of[None].component_id is None
    kept = keep_one(docs).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in kept) == [(False, 0), (True, 1), (True, 3), (True, 4), (True, 7)]
    assert keep_one(docs).columns == docs.columns
    assert near_duplicates(docs.limit(0)).count() == 0


def test_fingerprint_of_few_words():
    assert fingerprint("") == fingerprint(" \n") == 0
    assert fingerprint("One") == xxhash.xxh64_intdigest(b"one", 42)
    assert fingerprint("ÀB c") == xxhash.xxh64_intdigest("Àb c".encode(), 42)


def test_one_row_a_group_whatever_the_ids(spark):
    rng = random.Random(8)
    one, two, three = ([f"w{rng.randrange(10**6)}" for _ in range(600)] for _ in range(3))
    near = next(t for i in range(600) if 1 <= (fingerprint(" ".join(three)) ^ fingerprint(t := " ".join([*three[:i], "other", *three[i + 1 :]]))).bit_count() <= 3)
    one, two, three = map(" ".join, (one, two, three))
    # Two groups with the same smallest id, and one without ids but with two fingerprints.
    rows = [(1, one), (2, one), (1, two), (3, two), (None, three), (None, near), (None, near)]
    kept = keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r.doc_id for r in kept].count(1) == 2 and {r.text for r in kept if r.doc_id} == {one, two}
    assert len(kept) == 3 and {r.text for r in kept if r.doc_id is None} < {three, near}
