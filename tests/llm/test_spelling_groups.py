import random
import re
import zlib
from collections import Counter

import pytest

from arrears.llm.queries import op11_bit_sliced_variants
from arrears.llm.spelling_groups import near_within, rooted, runs_of, spelling_groups


def losing_runs(doc_id, text):
    """Runs one after another, as the contract words it."""
    for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
        run = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in run)
        h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
        yield run if h % 199 else run[: h % len(run)] + run[h % len(run) + 1 :]


def brute(docs, least_letters=6):
    counts = Counter(w for doc in docs for w in losing_runs(*doc))
    words = {w: n for w, n in counts.items() if len(w) >= least_letters and n >= 5}
    rest, near = {}, {w: set() for w in words}
    for w in words:
        for i in range(len(w)):
            rest.setdefault((i, w[:i] + w[i + 1 :]), []).append(w)
    for (_, r), members in rest.items():
        for w in members:
            near[w].update(x for x in members if x != w)
            if r in words:
                near[w].add(r)
                near[r].add(w)
    best = {w: min(near[w], key=lambda x: (-words[x], x)) for w in words if near[w]}
    form = {w: b for w, b in best.items() if words[b] >= 5 * words[w]}
    out = {}
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None)
    return out


def found(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def test_query_equals_brute_force(spark, smoke_dir):
    docs = spark.read.parquet(f"{smoke_dir}/documents.parquet").collect()
    got = found(op11_bit_sliced_variants(spark, smoke_dir))
    assert got == brute([(d.doc_id, d.text) for d in docs])
    assert any(form for form, *_ in got.values())


def one_apart(a, b):
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


@pytest.mark.parametrize("seed", range(20))
def test_index_finds_every_pair_once(seed):
    rng = random.Random(seed)
    letters = "abéÿ"[: rng.randint(1, 4)]
    words = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(1, 200))})
    pairs = Counter()
    for least in range(1, 10):
        inside = [w for w in words if len(w) in (least, least + 1)]
        for starts in (True, False) if inside else ():
            for q, near in near_within(inside, inside, least, starts):
                pairs.update((inside[q], inside[j]) for j in near)
    assert pairs == Counter({(a, b): 1 for a in words for b in words if one_apart(a, b)})


@pytest.mark.parametrize("group_words", [5, 60, 4096])
def test_frequent_keys_are_cut_into_chunks(spark, group_words):
    """A third of all words share their first letters, another third their last ones."""
    rng = random.Random(4)
    words = {rng.choice(["prefix", "", ""]) + "".join(rng.choice("abc") for _ in range(6)) + rng.choice(["suffix", ""]) for _ in range(400)}
    docs = [(i, " ".join([w] * rng.choice([5, 6, 30, 200]))) for i, w in enumerate(sorted(words))]
    got = found(spelling_groups(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), group_words=group_words))
    assert got == brute(docs) and sum(n for _, _, _, n, _ in got.values()) > 300


def test_odd_rows(spark, odd_docs):
    more = spark.createDataFrame(
        [
            (None, "GROSS" * 3 + " größer Größer GRÖßER " * 9, None, None, None),
            (10, "École école ÉCOLE×÷ ecole-ecole " * 40 + "écolle " * 8, "fr", None, None),
            (11, "letterz " * 6 + "letters " * 30 + "Letterss " * 150, "en", "", 0),
        ],
        odd_docs.schema,
    )
    docs = odd_docs.union(more).selectExpr("*", "'x' AS word", "1 AS n", "2 AS least", "3 AS home")
    assert found(spelling_groups(docs)) == brute([(d.doc_id, d.text) for d in docs.collect()])
    chained = found(spelling_groups(docs))["letterz"]
    assert chained[:2] == ("letters", "letterss")
    assert spelling_groups(docs.limit(0)).count() == 0
    assert spelling_groups(docs.where("text IS NULL")).count() == 0


def test_runs_that_lose_a_letter_may_meet(spark):
    for doc_id, text in ((i, "abcdefg abcdefx abcdef ABCDEFG") for i in range(3000)):
        counted = Counter()
        for run, n in runs_of(doc_id, text).items():
            counted[run if isinstance(run, str) else run[0]] += n
        assert counted == Counter(losing_runs(doc_id, text))


def test_roots_of_long_chains(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(37)] + [("a", "w5")]
    got = {r.word: r.root for r in rooted(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert got == {w: "w37" for w, _ in chain}
