"""Small tables for the corpus operators."""

from __future__ import annotations

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

DOCS = "doc_id long, text string"


@pytest.fixture
def docs_of(spark):
    def make(*rows, schema=DOCS):
        return spark.createDataFrame(list(rows), schema)

    return make


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, repeated rows, and columns whose names the
    operators use themselves."""
    rng = random.Random(5)
    names = ["alpha", "beta", "Gamma", "délta", "the", "of", "and", "omega"]
    long = " ".join(rng.choice(names) + str(rng.randrange(400)) for _ in range(30_000))
    rows = [
        (1, None, "x", 1),
        (2, "", "x", 2),
        (3, "   \n\t ", None, 3),
        (4, "one", "y", 4),
        (4, "one", "y", 4),
        (5, long, "z", 5),
        (6, long + " tail", "z", 6),
        (7, "one two three four five six", None, None),
        (None, "one two three four five six", "w", 8),
        (8, "é" * 50 + " 日本語 " + "a" * 40_000, "v", 9),
        (9, 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" end', "u", 10),
    ]
    schema = "doc_id long, text string, id string, n_shingles int"
    return spark.createDataFrame(rows, schema)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, n_chars long")
