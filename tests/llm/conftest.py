import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long, score string, ord string, rows string"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (id, text) pairs, with columns whose names the operators use themselves."""

    def make(pairs, lang=None):
        rows = [(i, t, lang, "s", None, "x", "y", "z") for i, t in pairs]
        return spark.createDataFrame(rows, DOC)

    return make


ODD = [
    (None, "a line of some length\nb"),
    (1, None),
    (2, ""),
    (3, " \n\t\n "),
    (4, "a line of some length\nb"),
    (4, "a line of some length\nb"),
    (5, "word " * 30_000),
    (6, "ünï 😀 <|endoftext|>\x00\x1c end"),
]


@pytest.fixture(scope="session")
def odd():
    """Null ids and texts, blanks, repeated rows, a very long text, odd characters."""
    return list(ODD)
