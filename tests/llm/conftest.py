import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture
def docs(spark):
    """A table of documents from (doc_id, text) rows."""

    def build(rows):
        full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")

    return build


@pytest.fixture
def prose():
    """A text of n random words."""
    rng = random.Random(7)

    def make(n, kinds=4000):
        return " ".join(f"w{rng.randrange(kinds)}" for _ in range(n))

    return make


@pytest.fixture
def odd_rows(prose):
    """Null and empty texts, white space only, one long word, a long text, copies, odd characters."""
    long = prose(5000)
    return [
        (0, None),
        (1, ""),
        (2, " \n\t "),
        (3, "x" * 3000),
        (4, long),
        (5, long),
        (6, "one two"),
        (7, "one two"),
        (8, "ÄÖ é 名前 K b <|endoftext|> it's  two   spaces \n end "),
        (9, prose(300)),
    ]
