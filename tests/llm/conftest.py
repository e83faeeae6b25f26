import pytest

ODD = [  # nulls, empty and blank texts, ties, repeated rows, one very long text
    (1, "the cat sat on the mat today"), (2, None), (3, ""), (4, " \t\n"), (None, "no id here at all"),
    (5, "the cat sat on the mat today"), (5, "the cat sat on the mat today"),
    (6, "naïve café 東京 \U0001f600 it's  we'll   12 345\r\n\r\n x"), (7, "word " * 9000),
]


@pytest.fixture
def odd(spark):
    """Awkward documents with extra columns whose names clash with results and internals."""
    rows = [(i, t, "x", i, 1.5) for i, t in ODD]
    return spark.createDataFrame(
        rows, "doc_id long, text string, ids string, key long, score double")


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
