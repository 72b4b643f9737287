import random

import pytest

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, size bigint,"
          " term string, band int")


@pytest.fixture(scope="session")
def documents(spark):
    """Builds documents from (doc_id, text[, lang, source]) with columns whose names clash."""
    def build(*rows):
        full = [(r[0], r[1], *(r[2:] if len(r) > 2 else ("en", "a")), 0, 7, "x", None)
                for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return build


@pytest.fixture(scope="session")
def prose():
    """Repeatable words; a small vocabulary, so that shingles recur."""
    def build(seed, n, vocabulary=400):
        rng = random.Random(seed)
        return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]

    return build


EDGES = [(900, None, None, None), (901, "", "en", None), (902, " \t\n\x0b\x0c\r ", "en", "a"),
         (903, "one", None, "b"), (904, "ONE", "en", "b"), (905, "\n\n", "fr", "a"),
         (906, "Ünï çode and more \U0001f600 \x1f end", "de", "b"),
         (907, "x" * 5000, "en", "a"), (None, "a row without a key at all", "en", "a")]


@pytest.fixture(scope="session")
def edges():
    return list(EDGES)
