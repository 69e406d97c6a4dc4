import hashlib
import random
import struct

import public_tokenizers
import pytest
import tiktoken

from arrears.llm.prefix_bpe import PrefixTable, Vocabulary, codec, encode_texts
from arrears.llm.queries import op9_byte_bpe
from arrears.llm.settings import PATTERN, RANKS


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary.from_file(RANKS)


@pytest.fixture(scope="module")
def reference(vocabulary):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})


def want(reference, text):
    ids = reference.encode_ordinary(text or "")
    packed = struct.pack(f"<{len(ids)}I", *ids)
    return len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_query_equals_the_library_on_whole_texts(spark, smoke_dir, reference):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{smoke_dir}/documents.parquet").collect()}
    rows = op9_byte_bpe(spark, smoke_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == want(reference, texts[r.doc_id])


def test_odd_rows_and_clashing_columns(spark, odd_docs, reference):
    docs = odd_docs.selectExpr("*", "'x' AS n_tokens", "1 AS ids")
    rows = encode_texts(docs, RANKS, PATTERN, keep_ids=True).collect()
    texts = [r.text for r in odd_docs.collect()]
    assert [(r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows] == [want(reference, t) for t in texts]
    assert all(len(r.ids) == 4 * r.n_tokens for r in rows)
    assert encode_texts(docs.limit(0), RANKS, PATTERN).count() == 0


def test_random_white_space_and_scripts(reference):
    rng, alphabet = random.Random(5), " \n\t\r 　\x1c\x85'sreveLL d09é漢字😀ab<|endoftext|>.,!_"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(5000)]
    bpe = codec(RANKS, PATTERN)
    for text, ids in zip(texts, bpe.encode(texts)):
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == reference.encode_ordinary(text)
        assert bpe.decode(ids) == text.encode()


def test_appends_and_edits_equal_a_new_table(vocabulary):
    rng = random.Random(1)
    for _ in range(500):
        data = bytes(rng.choice(b"abcdeeest  ing") for _ in range(rng.randint(0, 200)))
        table = PrefixTable(vocabulary, data)
        start = rng.randint(0, len(data))
        table.replace(start, rng.randint(start, min(len(data), start + 3)), bytes(rng.choice(b"xying") for _ in range(rng.randint(0, 3))))
        assert table.last == PrefixTable(vocabulary, table.data).last
        table.append(b"ending")
        assert table.ids() == PrefixTable(vocabulary, table.data).ids()


def test_an_edit_in_a_long_match_reworks_little(vocabulary):
    table = PrefixTable(vocabulary, b"abcdefgh" * 5000)
    assert table.replace(1000, 1001, b"z") < 2000
    assert table.last == PrefixTable(vocabulary, table.data).last
    assert table.ids(900) == PrefixTable(vocabulary, table.data[:900]).ids()
