"""Fixtures of the training-text operator tests."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

LONG = " ".join(f"word{i % 977} filler{i % 31}." for i in range(12_000))
PASSAGE = ("The quick brown fox jumps over the lazy dog while seven wizards quietly mix "
           "a bowl of blue soup for their hungry guests tonight")

#: (doc_id, text): NULLs, empty and blank texts, ties, repeated rows, very long texts.
EDGE_DOCS = [
    (1, PASSAGE), (2, PASSAGE), (3, PASSAGE.replace(" ", "\t\n ")), (4, None), (5, ""), (6, " \n\t "),
    (7, "one two"), (8, "One TWO"), (9, LONG), (10, LONG + " tail"), (11, "x"), (11, "x"),
    (12, PASSAGE.replace("seven", "eight")), (13, "é" * 60 + " ünïcode 漢字 \U0001F600 text <|endoftext|> end"),
    (14, "line one that is certainly long enough to count as one\nshort\n" * 3),
    (15, "LINE ONE that is certainly long enough to count as one  \nother"),
    (16, "\n\n" + "line one that is certainly long enough to count as one"),
    (17, "line one that is certainly long enough to count as one\t"),
    (18, " line one that is certainly long enough to count as one"),
    (19, "aaaa" * 50), (20, "b" + "aaaa" * 40), (21, "you idiot, you worthless scum"),
    (22, PASSAGE + " " + LONG[:3000]),
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """The rows above with extra columns whose names clash with working columns."""
    rows = [(i, t, "en", 0, 0, "k", None) for i, t in EDGE_DOCS]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, n long, id long, key string, digest string") \
        .repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")
