import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF_DIR = "/root/testdata/sf0.001"

LONG_LINE = "This line is long enough to count as one that documents repeat."
# id, text: nulls, empty and blank texts, ties, repeated rows, a very long text, odd characters
EDGES = [
    (1, None), (2, ""), (3, "   \t\n "), (4, "one"), (5, "one two"), (6, "ONE  two"), (7, "a b c d e f g h i j"),
    (7, "a b c d e f g h i j"), (8, "x " * 60_000), (9, "é😀 ünïcode \x01 \x00 text\r\nwith lines\n\n" + LONG_LINE),
    (10, LONG_LINE + "\n" + LONG_LINE), (11, LONG_LINE), (12, " " + LONG_LINE.upper() + "\t"), (13, LONG_LINE), (14, "9" * 50_000),
    (None, "a row without id " + LONG_LINE), (None, None),
]


@pytest.fixture(scope="session")
def edges(spark):
    """Awkward rows, with extra columns named like those that operators make."""
    rows = [(i, t, "en", "src", 0, "x", 1, True, "f") for i, t in EDGES]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, bucket string, score int, kept boolean, `start` string"
    )


@pytest.fixture(scope="session")
def nothing(edges):
    return edges.where("false")


@pytest.fixture(scope="session")
def given(spark):
    """The small given documents as a dict, for plain restatements."""
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    return docs, {r.doc_id: r.text for r in docs.collect()}
