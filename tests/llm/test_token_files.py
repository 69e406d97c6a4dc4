import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from arrears.llm.pieces import PieceEncoder
from arrears.llm.queries import op7_token_files
from arrears.llm.settings import TOKENIZER
from arrears.llm.token_files import Segment, _encoder, token_files, write_segment


def want(rows):
    """Expected rows from one pass over (doc_id, text) in order."""
    tokenizer, start, out = Tokenizer.from_file(TOKENIZER), 0, []
    for doc_id, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_query_equals_one_pass_of_the_library(spark, smoke_dir):
    docs = spark.read.parquet(f"{smoke_dir}/documents.parquet").orderBy("doc_id").collect()
    got = [tuple(r) for r in op7_token_files(spark, smoke_dir).orderBy("doc_id").collect()]
    assert got == want([(d.doc_id, d.text) for d in docs])


def test_odd_rows(spark, odd_docs):
    got = sorted(map(tuple, token_files(odd_docs.selectExpr("*", "1 AS part", "2 AS ids"), TOKENIZER, 2).collect()), key=lambda r: r[1])
    rows = sorted(odd_docs.collect(), key=lambda d: (d.doc_id is not None, d.doc_id or 0))
    assert got == want([(d.doc_id, d.text) for d in rows])
    assert token_files(odd_docs.limit(0), TOKENIZER, 2).count() == 0


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 5000])
@pytest.mark.parametrize("high", [1, 2, 300, 50_257, 2**32])
def test_segments_round_trip(n, high):
    rng = np.random.default_rng(n + high)
    ids = rng.integers(0, high, n, dtype=np.uint64).astype(np.uint32)
    ids[rng.random(n) < 0.03] = high - 1
    data = write_segment(ids, [None, -5], [n, 0])
    segment = Segment(data)
    assert segment.doc_ids == [None, -5] and segment.lengths.tolist() == [n, 0]
    assert np.array_equal(segment.ids(), ids)
    for start, stop in ((0, 10), (250, 260), (256, 512), (n // 2, n), (n, n + 5)):
        assert np.array_equal(segment.ids(start, stop), ids[start:stop])


def test_outliers_do_not_widen_blocks():
    ids = np.full(256 * 100, 7, np.uint32)
    ids[::256] = 50_000
    assert len(write_segment(ids, [1], [len(ids)])) < 100 * (4 + 1 + 4 + 4 + 5) + 200


def test_a_cut_file_is_refused():
    with pytest.raises(ValueError):
        Segment(write_segment(np.arange(1000, dtype=np.uint32), [1], [1000]) + b"x")


def test_marks_behind_a_word_are_no_new_piece():
    """A word seen before is not encoded again for the marks behind it, and the ids stay those of the whole text."""
    tokenizer, sent = Tokenizer.from_file(TOKENIZER), []

    def ids(texts):
        return [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    encoder = PieceEncoder(lambda pieces: sent.extend(pieces) or ids(pieces))
    texts = ["a word here", "a word*** here%%% word$$ word,", "so word!!!! don't' word'' here-- naïve_ 12## it's. \n word?! \u3000here## end"]
    assert [encoder.encode([t])[0] for t in texts] == ids(texts)
    assert sent.count(" word") == 1 and not {" word***", " here%%%", " word$$", " word,", " here--"} & set(sent)


def test_a_column_of_texts_gets_the_ids_of_the_library():
    tokenizer, rng = Tokenizer.from_file(TOKENIZER), np.random.default_rng(7)
    parts = [" ", " ", " ", "  ", "\n", "\t", "\u3000", "\x1c", "\x85", "word", "Straße", "naïve", "año", "ªº", "𐐷", "中文", "don't", "'", "12", "²", "!!", "<|endoftext|>", "."]
    texts = ["", " ", "  ", " a", "a ", *("".join(rng.choice(parts, n)) for n in rng.integers(0, 40, 600))]
    # All letters that are held to be parts of words, each behind a space.
    texts += [f"a {chr(i)}x x{chr(i)} {chr(i)}" for i in range(0x250) if chr(i).isalpha()]
    ids = [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    encoder = _encoder.__wrapped__(TOKENIZER)
    column = pa.array(["left out", *texts, "left out"]).slice(1, len(texts))
    assert encoder.encode_column(column) == ids and encoder.encode_column(column) == ids
    assert [encoder.encode_column(column.slice(i, 1)) for i in range(50)] == [[i] for i in ids[:50]]
    assert encoder.encode_column(column.slice(0, 0)) == []


def test_a_piece_is_looked_up_once_for_all_its_places():
    class Known(dict):
        looks = 0

        def get(self, *key):
            Known.looks += 1
            return super().get(*key)

    encoder, text = _encoder.__wrapped__(TOKENIZER), "a word and a word " * 500 + "end"
    encoder._known = Known()
    assert encoder.encode_column(pa.array([text] * 10)) == encoder.encode([text] * 10)
    encoder._known, Known.looks = Known(encoder._known), 0
    encoder.encode_column(pa.array([text] * 10))
    assert Known.looks < 10


def test_words_go_to_the_model_and_not_through_the_splitting(monkeypatch):
    sent = []

    class Watched:
        """The library's tokenizer with a list of the texts that it splits."""

        def __init__(self, inner):
            self.inner = inner

        def __getattr__(self, name):
            return getattr(self.inner, name)

        def encode_batch_fast(self, texts, **how):
            sent.extend(texts)
            return self.inner.encode_batch_fast(texts, **how)

    class Library:
        from_file = staticmethod(lambda path: Watched(Tokenizer.from_file(path)))

    monkeypatch.setattr("tokenizers.Tokenizer", Library)
    encoder, text = _encoder.__wrapped__(TOKENIZER), "First quxalong größenwahn, x12 zebrafisch"
    want = np.array(Tokenizer.from_file(TOKENIZER).encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert encoder.encode([text]) == [want]
    assert sorted(sent) == sorted([" x12", ",", "First"])
