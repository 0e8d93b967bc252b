import pytest

#: Rows with a null, an empty text, a text without letters, a repeated row, and a very long text.
ODD = [(1, None), (2, ""), (3, "123 !!"), (4, "Equal words here, five of them."), (5, "Equal words here, five of them."),
       (5, "Equal words here, five of them."), (6, "long " * 50_000)]


@pytest.fixture(scope="session")
def odd(spark):
    """ODD with columns whose names clash with what operators add."""
    rows = [(i, t, "en" if t else None, "x", 7, "clash", -1, True) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "_id string, score long, kept boolean")


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)
