import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DOCS = "doc_id long, text string"


@pytest.fixture(scope="session")
def shipped(spark):
    from cupom.llm.common import ship

    ship(spark)
    return spark


@pytest.fixture
def docs(shipped):
    """Rows as a documents table with a column that clashes with results and one more."""

    def make(rows, parts=3):
        rows = [(*r, "given", 7) for r in rows]
        return shipped.createDataFrame(rows, DOCS + ", kept string, n_words int").repartition(parts) if rows else shipped.createDataFrame([], DOCS + ", kept string, n_words int")

    return make


PROSE = (
    "the quick brown fox jumps over the lazy dog while seven wise owls count silver coins near an old stone bridge and "
    "nobody in the quiet village remembers who first lit the lantern that still burns above the frozen river at night"
).split()


@pytest.fixture
def prose():
    """n words of text, different for each seed."""
    import random

    def make(seed, n=80):
        r = random.Random(seed)
        return " ".join(r.choice(PROSE) + r.choice(["", "", "s", "ly", "er", str(r.randint(0, 99))]) for _ in range(n))

    return make
