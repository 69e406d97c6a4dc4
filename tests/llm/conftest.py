import pytest


@pytest.fixture(scope="session")
def docs_schema():
    return "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def odd_docs(spark, docs_schema):
    """Nulls everywhere, empty and very long texts, ties, repeated rows."""
    long = " ".join(f"word{i % 997} {i}" for i in range(30_000))
    rows = [
        (1, "", "en", "a", 0),
        (2, None, None, None, None),
        (3, long, "en", "a", len(long)),
        (4, "the same words in the same order again and again here", "en", "b", 1),
        (5, "the same words in the same order again and again here", "en", "b", 1),
        (5, "the same words in the same order again and again here", "en", "b", 1),
        (6, "\t\n  ", "de", None, 4),
        (None, "a document without id, with enough words to be judged by rules", "de", "b", 3),
        (7, "漢字 😀 é \x1c x　y <|endoftext|> don't", "fr", "c", 9),
    ]
    return spark.createDataFrame(rows, docs_schema)
