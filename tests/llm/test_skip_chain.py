import hashlib
import random
import re
from dataclasses import replace
from itertools import product

import numpy as np
import pytest

from arrears.llm.queries import op1_skip_chain
from arrears.llm.skip_chain import KINDS, NONE, Node, Weights, base_spans, counts, evidence, find, infer, learn, luhn, mask_personal_data, masked, nodes, personal_data, potentials, skips, spelled, train

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    """Base spans by the patterns themselves."""
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 14 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(digits(m.group())) <= 15]
    return sorted(out)


def test_luhn():
    assert luhn("4539578763621486") and not luhn("4539578763621487")


def test_patterns_on_random_texts():
    rng = random.Random(4)
    for alphabet in ("0123456789. ", "0123456789.", "ab@.-+ 1é", "+0123456789 ().-", "0 1-2"):
        for _ in range(6000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 45)))
            assert base_spans(text) == plain(text), text


def test_query_equals_the_patterns(spark, smoke_dir):
    texts = {d.doc_id: d.text for d in spark.read.parquet(f"{smoke_dir}/documents.parquet").collect()}
    rows = op1_skip_chain(spark, smoke_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in base) for i in range(4)]
        assert r.base_sha256 == hashlib.sha256(spelled(base).encode()).hexdigest()
        assert set(filter(None, spelled(base).split(","))) <= set(r.spans.split(","))


@pytest.fixture(scope="module")
def weights(spark):
    return train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_repeated_mentions_get_the_label(weights):
    text = "call +1 (632) 555-4827 or write anna.k@mail4.example.com today. Later (632) 555-4827 and anna.k@intranet again, but not 1234567 or 20240101."
    base, spans = find(text, weights)
    assert [KINDS[k] for _, k, _ in base] == ["phone", "email"]
    assert [(KINDS[k], text[a:b]) for a, k, b in spans if (a, k, b) not in base] == [("phone", "(632) 555-4827"), ("email", "anna.k@intranet")]
    assert masked(text, spans).count("<PHONE>") == 2


def test_what_repeats_nothing_stays(weights):
    for text in ("order 1234567890123456 of 2024-01-01 10:00", "write a@b.cc; number 4111 1111 1111 1112 is none", "7777777 7777777", ""):
        base, spans = find(text, weights)
        assert base == spans


def test_hundreds_of_repeats_get_the_label(weights):
    first, again = "+1 (632) 555-4827", "(632) 555-4827"
    for n in (60, 700):
        for between in (" and ", " or 20240101 and "):
            for parts in ([first, *[again] * n], [*[again] * n, first], [*[again] * n, first, *[again] * n]):
                text = between.join(parts)
                base, spans = find(text, weights)
                assert len(base) == 1 and len(spans) == len(parts), (n, between, len(spans))
                assert again not in masked(text, spans)


def test_digits_beside_a_repeated_number_do_not_hide_it(weights):
    number, again, card = "+1 (632) 555-4827", "(632) 555-4827", "4539 5787 6362 1486"
    for text, hidden, n in (
        (f"call {number}, or {again}. 3 items", again, 1),
        (f"call {number}. 3 items, or {again} today", again, 1),
        (f"call {number}, or {again} {again}, or {again} (632) 111-2222", again, 3),
        (f"call {number}, or 20240101 {again} 17", again, 1),
        (f"paid by {card}. 3 items, not {card}. 20 items", card, 0),
        (f"paid by {card}, see 12. 4539-5787.6362-1486. 7", "4539-5787.6362-1486", 1),
    ):
        base, spans = find(text, weights)
        assert len(spans) - len(base) == n and hidden not in masked(text, spans), text
    text = f"{number} or {again} (632) 111-2222"
    assert masked(text, find(text, weights)[1]) == "<PHONE> or <PHONE> (632) 111-2222"


def test_long_hosts_are_whole():
    text = "anna@" + "a" * 400 + " more"
    assert [text[n.start : n.end] for n in nodes(text)] == [text[:-5]]


def test_weights_come_from_all_documents(spark):
    # More rows than the sample of old had, some without id and some with one id; only one holds a card.
    texts = [f"write a{i}@b.cc" for i in range(3_200)] + ["pay 4539 5787 6362 1486", None]
    docs = spark.createDataFrame([(i // 2 if i % 5 else None, t) for i, t in enumerate(texts)], "doc_id long, text string")
    each = [counts(t or "") for t in texts]
    want, got = learn({k: sum(x[k] for x in each) for k in each[0]}), train(docs)
    assert all(np.allclose(getattr(got, k), getattr(want, k)) for k in ("look", "chain", "skip"))


def contacts(n, seed):
    """Made documents with what should become personal data by repeats, and what only looks alike.

    Yields (text, spans that must be added, as texts in order).
    """
    rng = random.Random(seed)
    digits = lambda k: "".join(rng.choice("123456789") for _ in range(k))
    filler = lambda: " ".join(rng.choice("some plain words stand between what is looked for here".split()) for _ in range(rng.randint(2, 9)))
    for i in range(n):
        area, last = digits(3), digits(4)
        number, short, tail = f"+1 ({area}) 555-{last}", f"({area}) 555-{last}", f"{area}555{last}"[1:]
        order = f"order {digits(7)}{tail}"
        if i % 4 == 0:
            yield f"{filler()} call {number} {filler()} call {short} {filler()} {order}", [short]
        elif i % 4 == 1:
            yield f"{filler()} order {digits(16)} {filler()} order {digits(16)} on 2024-0{digits(1)}-11 {filler()}", []
        elif i % 4 == 2:
            yield f"{filler()} call {number} {filler()} {order} {filler()} order {digits(16)}", []
        else:
            yield f"{filler()} write anna{i}@mail.example.com {filler()} call {number}, +1 ({digits(3)}) 555-{digits(4)}, +1 ({digits(3)}) 555-{digits(4)} {filler()} write anna{i}@intranet", [f"anna{i}@intranet"]


def learned(texts):
    texts = list(texts)
    each = [counts(t) for t in texts]
    total = {k: sum(x[k] for x in each) for k in each[0]}
    w = learn(total)
    return learn(total, sum(evidence(t, w) for t in texts))


def added(text, w):
    base, spans = find(text, w)
    return [(KINDS[k], text[a:b]) for a, k, b in spans if (a, k, b) not in base]


def unlearned():
    return learn({k: np.zeros_like(v) for k, v in counts("").items()})


@pytest.fixture(scope="module")
def from_contacts():
    return learned(t for t, _ in contacts(800, 1))


def test_precision_and_recall_of_added_spans(from_contacts):
    right = wrong = missed = 0
    for text, want in contacts(800, 2):
        got = [s for _, s in added(text, from_contacts)]
        right += len(set(got) & set(want))
        wrong += len(set(got) - set(want))
        missed += len(set(want) - set(got))
    assert right / (right + wrong) > 0.98 and right / (right + missed) > 0.98, (right, wrong, missed)


def test_context_overrules_a_shared_key(from_contacts):
    text = "call +1 (632) 555-4827 about order 9876543325554827 today"
    found = nodes(text, base_spans(text))
    assert skips(found), "the order number ends like the telephone number"
    assert added(text, from_contacts) == []
    # Without what was learned the shared key alone decides.
    assert added(text, unlearned()) == [("phone", "9876543325554827")]


def test_the_chain_labels_a_node_without_a_skip():
    # Lists of telephone numbers, some told again in short, and lists of part numbers written alike.
    texts = []
    for i in range(400):
        numbers = [f"+1 ({200 + i}) 555-{1000 + 7 * i + k}" for k in range(6)]
        texts.append(f"call {', '.join(numbers)}, {numbers[0][3:]}, {numbers[1][3:]}")
        texts.append("parts " + ", ".join(f"({200 + i}) 777-{1000 + 7 * i + k}" for k in range(6)) + f" of a{i}@b.cc")
    w = learned(texts)
    among = "call +1 (632) 555-4827, +1 (632) 555-1111, +1 (632) 555-1112, (714) 555-9321, +1 (632) 555-2222, +1 (632) 555-3333"
    assert not skips(nodes(among, base_spans(among)))
    assert added(among, w) == [("phone", "(714) 555-9321")]
    assert added(among, replace(w, chain=0 * w.chain)) == [], "without neighbours nothing says so"
    assert added("parts (200) 777-1000, (200) 777-1001, (714) 555-9321, (200) 777-1002 of a1@b.cc", w) == []


def test_counts_are_whole_and_odd_nodes_count(weights):
    for text in ("a_@1.2.3.4 x", "a+16325554827@ 4539578763621486@4539578763621486", "+1 632-555.4827@b", "@", "1@1"):
        for n in counts(text).values():
            assert (n == np.floor(n)).all() and (n >= 0).all(), text
        find(text, weights)


def test_messages_are_exact_on_a_tree():
    rng = np.random.default_rng(3)
    w = Weights(rng.normal(size=(40, NONE + 1)), rng.normal(size=(NONE + 1, NONE + 1)), rng.normal(size=(NONE + 1, NONE + 1)))
    found = [Node(i, i + 1, (i, 9), ()) for i in range(4)]
    seen, p = [-1, 2, -1, -1], np.zeros((4, NONE + 1))
    own = potentials(found, seen, w)
    for y in product(range(NONE + 1), repeat=4):
        if y[1] == 2:
            weight = np.exp(sum(own[i, y[i]] for i in (0, 2, 3)) + sum(w.chain[y[i], y[i + 1]] for i in range(3)))
            for i in range(4):
                p[i, y[i]] += weight
    assert infer(found, seen, w) == pytest.approx(p / p.sum(axis=1, keepdims=True), abs=2e-3)


def test_skips_are_as_many_as_nodes():
    found = nodes("x@y " * 500)
    assert len(found) == 500 and len(skips(found)) == 499


def test_odd_rows(spark, odd_docs, weights):
    docs = odd_docs.selectExpr("*", "'x' AS spans", "1 AS n_ip")
    assert personal_data(docs, weights).count() == 9
    out = mask_personal_data(docs, weights)
    assert out.columns == docs.columns
    assert sorted(map(str, out.select("doc_id", "text").collect())) == sorted(map(str, docs.select("doc_id", "text").collect()))
    assert personal_data(docs.limit(0), weights).count() == 0
    assert isinstance(train(docs.limit(0)), Weights)


def test_very_long_runs_take_linear_time(weights):
    for text in ("a" * 300_000 + "@", "1" * 300_000, "1." * 150_000, "+1 " * 100_000, "a@" * 100_000, "1 " * 200_000, "(" * 200_000):
        find(text, learn({"look": np.zeros((40, 5)), "chain": np.zeros((5, 5)), "skip": np.zeros((5, 5))}))
