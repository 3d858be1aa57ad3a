import random

import pytest

WORDS = [f"w{i}" for i in range(300)]


@pytest.fixture()
def frame(spark):
    """Documents with the columns of the table and an extra one whose name clashes with inner ones."""
    def make(rows):
        return spark.createDataFrame([(i, t, "en", "src0", len(t or ""), "x") for i, t in rows],
                                     "doc_id long, text string, lang string, source string, n_chars long, th string").repartition(3)
    return make


@pytest.fixture()
def prose():
    def make(seed, n):
        r = random.Random(seed)
        return " ".join(r.choice(WORDS) for _ in range(n))
    return make


#: Null and empty texts, white space only, repeated rows, a null id, a very long text.
ODD = [(1, None), (2, ""), (3, " \t\n "), (4, "same row"), (4, "same row"), (None, "no id"), (5, "x" * 200_000), (6, "a b " * 30_000)]
