from __future__ import annotations

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside.
CLASHING = ["text_key", "kept", "row", "fp", "n", "h", "h1", "words", "w", "part", "rank", "gone", "_id", "_key", "first", "label", "line", "block"]

LONG = "word " * 30000
PROSE = "The quick brown fox jumps over the lazy dog while seven tall trees sway in a soft evening wind near home"
ROWS = [
    (1, PROSE, "en", "a", 10),
    (1, PROSE, "en", "a", 10),                      # the same row again
    (1, "Another text under the same number", "en", "a", 10),
    (2, None, "en", "a", None),
    (3, "", None, None, 0),
    (4, "   \t\n \x0b ", "en", "a", 3),
    (5, LONG, "en", "a", len(LONG)),
    (6, "x" * 200000, "de", "b", 200000),
    (None, "a document without a number " * 5, "fr", "b", 5),
    (7, "émile zola\nune ligne\nune ligne", "fr", "b", 5),
    (8, PROSE, "en", "c", 10),
    (9, "<s>[INST] 1 2 3 </s> a@b.co +1 (212) 555-0187", "en", "c", 10),
]


def clashing(df):
    """The table with more columns, named like the operators' own."""
    for c in CLASHING:
        df = df.withColumn(c, F.lit(f"own {c}"))
    return df


@pytest.fixture(scope="session")
def edge(spark):
    return clashing(spark.createDataFrame(ROWS, SCHEMA))


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, None, None), (5, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def benchmark(spark):
    return spark.createDataFrame([(0, "seven tall trees sway in a soft evening wind"), (1, None), (2, ""), (None, "no such words here at all today friend")],
                                 "item_id long, text string")
