from __future__ import annotations

import random

import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma".split()


@pytest.fixture
def sentence():
    """Texts of random words, the same on every run."""
    rng = random.Random(4)

    def make(words: int) -> str:
        return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "ing", "ed"]) for _ in range(words))

    return make


@pytest.fixture
def documents(spark):
    """A documents table from (doc_id, text[, lang[, source]]), with clashing further columns."""

    def make(rows):
        full = [(*row, *(None,) * (4 - len(row)), -1, "x", 9) for row in rows]
        return spark.createDataFrame(
            full,
            "doc_id long, text string, lang string, source string, n_chars long, score string, node int",
        )

    return make


ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "!!! ... 123"),
    (None, "alpha beta gamma delta epsilon"),
    (None, None),
    (6, "alpha beta gamma delta epsilon"),
    (6, "alpha beta gamma delta epsilon"),
    (7, "é" * 50_000 + " end"),
    (8, "\U0001f600 \U0001f600 word \U0001f600"),
]
