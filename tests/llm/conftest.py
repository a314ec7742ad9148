import pytest

#: Texts that every operator on documents must take: null, empty, blank, short, with odd white space, long, repeated.
ODD_TEXTS = [
    (1, None), (2, ""), (3, "   "), (4, "one"), (5, "a  b\n\n c\td "), (6, "the quick brown fox jumps over the lazy dog"),
    (7, "the quick brown fox jumps over the lazy dog"), (7, "the quick brown fox jumps over the lazy dog"), (None, "no id here"),
    (8, "é ß Ω 日本語 <|endoftext|> \U0001f600 x"), (9, "word " * 30_000), (10, "9" * 2000 + " a@" * 1000),
]


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


@pytest.fixture()
def odd(spark):
    """The odd texts, with columns whose names operators use inside."""
    rows = [(i, t, "en" if t else None, 1, "x", 2.0, "clash") for i, t in ODD_TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, _row int, key string, n double, digest string")


@pytest.fixture()
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
