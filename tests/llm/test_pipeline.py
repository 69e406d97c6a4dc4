import struct

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from arrears.llm import pivotal_mix, risk_rules, simhash_balls
from arrears.llm.prefix_bpe import Vocabulary
from arrears.llm.settings import RANKS
from arrears.llm.skip_chain import base_spans
from arrears.session import materialise


@pytest.fixture(scope="module")
def stages(spark):
    """Input and every stage's output, written and read again."""
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = {"input": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = materialise(stage(spark, docs, sf_dir), name)
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "personal_data", "mix_sources", "encode"]
    for name in list(stages)[:-1]:
        assert stages[name].columns == stages["input"].columns


def test_quality_stage_keeps_the_kept(spark, stages):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    verdicts = risk_rules.quality_rules(stages["input"], labels)
    assert ids(stages["quality_rules"]) == ids(verdicts.where("kept"))
    assert stages["quality_rules"].subtract(stages["input"]).count() == 0


def test_one_of_each_group_stays(stages):
    pairs = [(r.doc_id, simhash_balls.fingerprint(r.text)) for r in stages["quality_rules"].collect()]
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
    assert ids(stages["near_duplicates"]) == sorted({find(d) for d, _ in pairs})
    assert stages["near_duplicates"].subtract(stages["quality_rules"]).count() == 0


def test_no_base_span_is_left(stages):
    before = {r.doc_id: r.text for r in stages["near_duplicates"].collect()}
    rows = stages["personal_data"].collect()
    assert len(rows) == len(before)
    assert any(base_spans(t) for t in before.values())
    for r in rows:
        assert not base_spans(r.text) and r.n_chars == len(r.text)
        assert base_spans(before[r.doc_id]) or r.text == before[r.doc_id]


def test_documents_are_taken_as_often_as_mixed(stages):
    want = {r.doc_id: r.copies for r in pivotal_mix.mix(stages["personal_data"]).collect() if r.copies}
    got = {r.doc_id: r["count"] for r in stages["mix_sources"].groupBy("doc_id").count().collect()}
    assert got == want and max(got.values()) <= 3
    assert stages["mix_sources"].subtract(stages["personal_data"]).count() == 0


def test_all_rows_are_encoded(spark, stages):
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=Vocabulary.from_file(RANKS).ranks, special_tokens={})
    texts = {r.doc_id: r.text for r in stages["mix_sources"].collect()}
    rows = stages["encode"].collect()
    assert len(rows) == stages["mix_sources"].count()
    for r in rows:
        assert list(struct.unpack(f"<{r.n_tokens}I", r.ids)) == reference.encode_ordinary(texts[r.doc_id])


def test_run_gives_the_stages_result(spark, stages):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert got.columns == stages["encode"].columns
    assert got.agg(F.count("*"), F.sum("n_tokens")).first() == stages["encode"].agg(F.count("*"), F.sum("n_tokens")).first()


def test_chained_stages_on_odd_and_empty_tables(spark, odd_docs):
    """Nulls, empty and long texts, ties, repeated rows, extra columns and no rows go through all stages."""
    sf_dir = "/root/testdata/sf0.001"
    plain = odd_docs.selectExpr("doc_id", "concat_ws(' ', text, 'mail someone@example.org once or call +49 30 1234567 for more words') AS text", "lang", "source", "n_chars")
    for docs in (odd_docs.unionByName(plain), odd_docs.limit(0), odd_docs.where("text IS NULL")):
        docs = docs.selectExpr("*", "1 AS __key", "'x' AS whole", "2 AS copies", "3 AS id")
        columns, before = docs.columns, docs.count()
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = materialise(stage(spark, docs, sf_dir), name)
            assert docs.columns == columns, name
            if name != "mix_sources":
                assert docs.count() <= before
                before = docs.count()
        rows = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
        assert len(rows) == docs.count()
    assert docs.count() == 0


def test_one_row_a_group_whatever_the_names(spark, odd_docs):
    docs = odd_docs.selectExpr("*", "1 AS __key", "2 AS __id", "3 AS of", "4 AS key", "5 AS chosen", "6 AS whole")
    kept = simhash_balls.keep_one(docs)
    assert kept.columns == docs.columns and kept.where("__key = 1 AND of = 3 AND whole = 6").count() == kept.count() > 0
    assert simhash_balls.keep_one(docs.limit(0)).count() == 0
