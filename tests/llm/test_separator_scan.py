import os

import numpy as np
import pytest
import tiktoken

from arrears.llm.prefix_bpe import Vocabulary
from arrears.llm.queries import op8_separator_scan
from arrears.llm.separator_scan import scan_flat_files, spell, token_counts, unspell, write_flat_files
from arrears.llm.settings import END_OF_DOCUMENT, PATTERN, RANKS
from arrears.session import scratch_path


@pytest.fixture(scope="module")
def reference():
    ranks = Vocabulary.from_file(RANKS).ranks
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def key(pair):
    return pair[0] is not None, pair[0] or 0, pair[1]


def test_query_equals_the_library(spark, smoke_dir, reference):
    docs = spark.read.parquet(f"{smoke_dir}/documents.parquet").collect()
    assert sorted(map(tuple, op8_separator_scan(spark, smoke_dir).collect())) == sorted((d.doc_id, len(reference.encode_ordinary(d.text))) for d in docs)


@pytest.mark.parametrize("block", [1, 2, 7, 64, 1 << 20])
def test_documents_over_any_number_of_blocks(spark, smoke_dir, reference, block):
    folder = scratch_path(spark, "flat")
    docs = spark.read.parquet(f"{smoke_dir}/documents.parquet").where("doc_id < 12 AND length(text) < 900")
    write_flat_files(docs, folder, RANKS, PATTERN, END_OF_DOCUMENT)
    want = sorted((d.doc_id, len(reference.encode_ordinary(d.text))) for d in docs.collect())
    assert want and sorted(map(tuple, scan_flat_files(spark, folder, END_OF_DOCUMENT, block).select("doc_id", "n_tokens").collect())) == want


def test_odd_rows(spark, odd_docs, reference):
    got = token_counts(odd_docs.selectExpr("*", "'x' AS n_tokens", "'y' AS value"), RANKS, PATTERN, END_OF_DOCUMENT)
    want = [(d.doc_id, len(reference.encode_ordinary(d.text or ""))) for d in odd_docs.collect()]
    assert sorted(map(tuple, got.select("doc_id", "n_tokens").collect()), key=key) == sorted(want, key=key)
    assert token_counts(odd_docs.limit(0), RANKS, PATTERN, END_OF_DOCUMENT).count() == 0


def test_files_are_flat_and_a_missing_end_is_told_by_nothing(spark, tmp_path):
    ids = [*spell(9), 1, 2, 3, END_OF_DOCUMENT, *spell(-4), 5]
    (tmp_path / "flat.bin").write_bytes(np.array(ids, "<u2").tobytes() + b"\n")
    got = sorted(map(tuple, scan_flat_files(spark, str(tmp_path), END_OF_DOCUMENT, 4).select("doc_id", "n_tokens", "ordinal").collect()))
    assert got == [(-4, 1, 1), (9, 3, 0)]
    assert os.path.getsize(tmp_path / "flat.bin") == 2 * len(ids) + 1


def test_numbers_are_spelled_exactly():
    for number in (None, 0, 1, -1, 2**63 - 1, -(2**63), 50_000):
        assert unspell(spell(number)) == number and max(spell(number)) < 50_000
