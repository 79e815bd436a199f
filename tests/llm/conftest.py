from __future__ import annotations

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def frame(spark):
    """Makes a table of documents from (doc_id, text) pairs, with an extra column whose name an operator might use itself."""

    def make(rows, extra="bucket"):
        full = [(i, t, "en", "src0", len(t) if t is not None else None, 1) for i, t in rows]
        return spark.createDataFrame(full, f"{DOC_SCHEMA}, {extra} int")

    return make


@pytest.fixture(scope="session")
def prose():
    """A text of invented words from a seed."""
    import random

    syllables = [a + b for a in "bdfgklmnprst" for b in ("a", "e", "i", "o", "u", "en", "ar", "ös")]

    def make(seed, words):
        rng = random.Random(seed)
        return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(words))

    return make
