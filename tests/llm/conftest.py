from __future__ import annotations

import random

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents table from (doc_id, text, lang, source) rows."""
    def make(rows):
        return spark.createDataFrame([(i, t, la, s, None if t is None else len(t)) for i, t, la, s in rows], DOCS)
    return make


def prose(rng: random.Random, n: int, letters: str = "abcdefghijklmnopqrstuvwxyz") -> list[str]:
    return ["".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(n)]


# the no-break space of the last row is part of a word
ODD = [(1, None, None, None), (2, "", "en", "a"), (3, " \t\n ", "en", "a"), (None, "some words here", None, "b"),
       (4, "x" * 300_000, "en", "b"), (5, "one two", "en", None), (5, "one two", "en", None), (6, "é\u00a0ß \U0001F600", "de", "b")]
