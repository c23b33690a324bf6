"""Tables shared by the tests of this folder."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
SF_SMALL = "/root/testdata/sf0.001"

#: Rows that every operator must survive: null and empty texts, ties, repeated rows, nulls
#: in every column, and extra columns whose names clash with columns used inside.
EDGE_ROWS = [
    (1, "the quick brown fox jumps over the lazy dog today", "en", "a", 49, "x", 1),
    (1, "the quick brown fox jumps over the lazy dog today", "en", "a", 49, "x", 1),
    (2, "the  quick brown\tfox jumps over the lazy dog today", "en", None, 50, None, None),
    (3, "", None, None, None, None, None), (4, None, "en", "a", None, "y", 2), (5, "one two", "en", "b", 7, "z", 3),
    (None, "a text without an id of its own in the table", "de", "b", 44, "z", 4), (6, " \n\t ", "en", "b", 4, "z", 5),
    (7, "long " * 40_000, "en", "b", 200_000, "z", 6), (8, "x" * 3000, "en", "b", 3000, "z", 7),
]
EDGE_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, text_sha256 string, anchor int")


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(EDGE_ROWS, EDGE_SCHEMA)


@pytest.fixture(scope="session")
def edge_labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, None, 1), (3, 0, None), (None, 1, 1)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def small_labels(spark):
    return spark.read.parquet(f"{SF_SMALL}/labels.parquet")
