import math
import re

import pytest
from pyspark.sql import functions as F

from arrears.llm.queries import op6_risk_rules
from arrears.llm.risk_rules import RULES, Risk, binomial_tail, counted, cutoffs, keep_good, quality_rules


def brute(text):
    words, seen, covered = re.findall(r"[^\x20\x09-\x0D]+", text or ""), {}, set()
    for i in range(len(words) - 4):
        seen.setdefault(tuple(words[i : i + 5]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            for i in places:
                covered.update(range(i, i + 5))
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), n < 10 or 100 * len(covered) > 20 * n


def found(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed


def test_query_counts_equal_brute_force(spark, smoke_dir):
    texts = {d.doc_id: d.text for d in spark.read.parquet(f"{smoke_dir}/documents.parquet").collect()}
    rows = op6_risk_rules(spark, smoke_dir).collect()
    assert len(rows) == len(texts)
    assert all(found(r) == brute(texts[r.doc_id]) for r in rows)
    assert all(not (r.kept and r.base_failed) for r in rows)


def test_odd_rows(spark, odd_docs):
    docs = odd_docs.selectExpr("*", "'x' AS stratum", "1 AS n_words", "true AS kept")
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    rows = quality_rules(docs, labels).collect()
    texts = {d.doc_id: d.text for d in odd_docs.collect()}
    assert len(rows) == 9 and all(found(r) == brute(texts[r.doc_id]) for r in rows)
    kept = keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == sorted((r.doc_id or -1) for r in rows if r.kept)
    assert quality_rules(docs.limit(0), labels).count() == 0
    assert quality_rules(docs, labels.limit(0)).count() == 9


@pytest.mark.parametrize(("k", "n", "p"), [(0, 100, 0.02), (3, 1000, 0.01), (40, 20_000, 0.004), (5, 100, 0.02), (0, 0, 0.1), (150, 100_000, 0.004)])
def test_binomial_tail_is_exact(spark, k, n, p):
    got = spark.range(1).select(binomial_tail(F.lit(k).cast("long"), F.lit(n).cast("long"), p)).first()[0]
    want = 1.0 if k >= n * p else sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log(1 - p)) for i in range(k + 1))
    assert got == pytest.approx(want, rel=1e-6)


def fixture(spark, good, bad, lost):
    """``good`` clean texts of which ``lost`` look bad, and ``bad`` texts full of symbols; all distinct words."""
    plain = "concat_ws(' ', transform(sequence(1, 30), i -> concat('w', id, 'x', i)))"
    marked = "concat_ws(' ', transform(sequence(1, 30), i -> concat('w', id, 'x', i, '###')))"
    docs = spark.range(good + bad).selectExpr("id AS doc_id", f"if(id < {good - lost}, {plain}, {marked}) AS text", "'en' AS lang")
    return docs, docs.selectExpr("doc_id", f"int(doc_id < {good}) AS quality", "0 AS toxic")


def test_cutoff_needs_enough_proof(spark):
    risk = Risk(alpha=0.1, delta=0.05)
    docs, labels = fixture(spark, 1500, 60, 0)
    row = cutoffs(counted(docs), labels, risk).first()
    assert row.symbols is not None and all(row[r] is None for r in RULES if r not in ("symbols", "long_words", "short_words"))
    verdicts = quality_rules(docs, labels, risk)
    assert verdicts.where("kept").count() == 1500
    docs, labels = fixture(spark, 60, 60, 0)
    assert cutoffs(counted(docs), labels, risk).where("symbols IS NOT NULL").count() == 0
    docs, labels = fixture(spark, 1500, 60, 60)
    assert cutoffs(counted(docs), labels, risk).where("symbols IS NOT NULL").count() == 0


def test_nested_cutoffs_hold_their_level(spark):
    """A rule whose cutoff 0.3 loses just more than it may: over many strata it is taken about as seldom as promised."""
    strata, n, rate = 400, 400, 0.05
    risk = Risk(alpha=rate * len(RULES), delta=0.05 * strata, worth=0.0001)
    # Above 0.9 lie 1 %, above 0.5 4 %, above 0.3 a little over the rate, of the good documents; bad ones lie on top.
    ratio = f"CASE WHEN u < 0.01 THEN 0.95 WHEN u < 0.04 THEN 0.6 WHEN u < {rate + 0.0005} THEN 0.35 ELSE 0.0 END"
    stats = spark.range(strata * n * 2).selectExpr("id AS doc_id", f"string(id % {strata}) AS stratum", "id AS text_key", f"id >= {strata * n} AS bad", "rand(7) AS u")
    stats = stats.selectExpr("*", f"if(bad, 0.99, {ratio}) AS ratio").selectExpr(
        "doc_id", "stratum", "text_key", "bad", "100L AS n_words", "1000L AS word_chars", "bigint(ratio * 1000) AS n_symbols", "0L AS n_dup_lines", "0L AS n_repeat_words", "false AS base_failed"
    )
    stats = stats.cache()
    labels = stats.selectExpr("doc_id", "int(NOT bad) AS quality")
    rows = cutoffs(stats, labels, risk).collect()
    unsafe = sum(r.symbols is not None and r.symbols <= 0.3 for r in rows)
    # The level of one test is a hundredth, so four strata are expected to fail.
    assert unsafe <= 12
    assert sum(r.symbols is not None for r in rows) > strata * 0.9
    stats.unpersist()


def test_copies_are_one_trial_and_null_is_a_stratum(spark):
    risk = Risk(alpha=0.1, delta=0.05)
    docs, labels = fixture(spark, 1500, 60, 0)
    few = docs.where("doc_id < 100 OR doc_id >= 1500")
    copied = few.unionByName(docs.where("doc_id = 7").selectExpr("explode(sequence(2000, 4000)) AS doc_id", "text", "lang"))
    marked = labels.unionByName(spark.range(2000, 4001).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic"))
    assert cutoffs(counted(copied), marked, risk).where("symbols IS NOT NULL").count() == 0
    # With a second stratum the level halves, whether its name is null or empty.
    both = docs.unionByName(docs.selectExpr("doc_id + 10000 AS doc_id", "text", "cast(null AS string) AS lang")).unionByName(docs.selectExpr("doc_id + 20000 AS doc_id", "text", "'' AS lang"))
    every = labels.unionByName(labels.selectExpr("doc_id + 10000 AS doc_id", "quality", "toxic")).unionByName(labels.selectExpr("doc_id + 20000 AS doc_id", "quality", "toxic"))
    rows = cutoffs(counted(both), every, risk).collect()
    assert {r.stratum for r in rows} == {"en", None, ""}


def test_clashing_names_survive(spark, odd_docs):
    labels = spark.createDataFrame([(3, 1, 0)], "doc_id long, quality int, toxic int")
    docs = odd_docs.selectExpr("*", "1 AS __key", "2 AS __id", "3 AS __chosen", "4 AS whole", "5 AS id", "6 AS chosen", "7 AS `of`")
    kept = keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.where("__key = 1 AND id = 5 AND `of` = 7").count() == kept.count() > 0
