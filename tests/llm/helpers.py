"""Tables for the tests."""

import random

import pytest

from caretiers.llm.common import ship

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, id long, token long, ranges long, __text string"


def documents(spark, rows):
    """A table with the columns of documents and some that the operators use inside."""
    full = [(d, t, l, s, None if t is None else len(t), "k", 1, 2, 3, "x") for d, t, l, s in rows]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, repeated rows, equal texts, ties, odd white space."""
    rng = random.Random(7)
    vocabulary = [f"w{k}" for k in range(30)] + ["É", "é", "Aa", "aA", "x y", "a\x1cb"]
    rows = [
        (None, None, None, None), (None, "a b c", "en", None), (1, None, "en", "s"), (2, "", "en", "s"), (3, " \n\t ", None, "s"),
        (4, "one", "en", "s"), (5, "ONE", "en", "s"), (6, "two words", "en", "s"),
    ]
    base = [[rng.choice(vocabulary) for _ in range(rng.choice([3, 40, 90]))] for _ in range(6)]
    for k in range(10, 60):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2])):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        rows.append((k, rng.choice([" ", "\n", "  "]).join(w), rng.choice(["en", "de", None]), rng.choice(["s", "t"])))
    rows.append((70, " ".join(rng.choice(vocabulary) for _ in range(30_000)), "en", "s"))
    rows += [rows[12], rows[12], rows[0]]
    return rows
