"""Tables that the tests of the text operators share."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


def longest():
    return "long " * 30_000


#: (doc_id, text, score): nulls, an empty and a very long text, ties, repeated rows; the further
#: column is called like an output of several operators.
ODD_ROWS = [
    (1, None, 0.5), (2, "", 0.5), (3, " \n\t ", None), (None, "text without an id", 0.1),
    (4, longest(), 0.2), (5, "the same words stand in this text twice or more", 0.3),
    (6, "the same words stand in this text twice or more", 0.3),
    (6, "the same words stand in this text twice or more", 0.3), (7, "é 𝒳 ▁ \x00 z", 0.4),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD_ROWS, "doc_id long, text string, score double")


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, score double")

