import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.01"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
LETTERS = "abcdefgh éçß日 \n.,01"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def odd_texts():
    """Nulls, empty and blank texts, ties, repeats, separators and a very long text."""
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdeéß日") for _ in range(rng.randint(1, 8))) for _ in range(400)]
    long = " ".join(rng.choice(words) for _ in range(30_000))
    some = " ".join(rng.choice(words) for _ in range(70))
    return [(1, None), (2, ""), (3, " \n\t "), (4, some), (4, some), (5, some.upper()), (6, long), (7, "x" * 5000), (None, some), (None, None),
            (8, "one"), (9, "a b c"), (10, some + "\n" + some), (11, "\x00\x01\x7f é"), (12, "#$%|<>& *")]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd texts, with extra columns whose names clash with those that operators use inside."""
    rows = [(i, t, None, None if k % 3 else "src", k, "x", k, b"k") for k, (i, t) in enumerate(odd_texts())]
    return spark.createDataFrame(rows, COLUMNS + ", fp string, rid long, key binary").repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], COLUMNS)
