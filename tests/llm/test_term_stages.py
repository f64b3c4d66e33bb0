"""Ranked search through term owners against a plain computation over all pairs."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from daybook.llm import term_stages
from tests.llm.conftest import ODD, WORDS

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(low)


def brute_force(docs, items):
    counted = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    filled = sum(1 for _, c in counted if c)
    total = sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, c in counted:
            m = 100 - 75 + (75 * sum(c.values()) * filled) // total if total else 0
            score = 0
            for t in terms(text):
                if t in c:
                    w = math.floor(1000 * math.log((2 * filled + 2) / (2 * df[t] + 1)))
                    score += w * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, missing, doc_id) in enumerate(sorted(scored)[:10], 1):
            out.append((item_id, rank, None if missing else doc_id, -score))
    return sorted(out, key=str)


def found(spark, docs, items):
    frame = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS score", "2 AS doc_id")
    return sorted(map(tuple, term_stages.ranked(docs, frame).collect()), key=str)


@pytest.fixture
def corpus():
    rng = random.Random(8)
    rare = [f"rare{k}" for k in range(60)]
    docs = []
    for k in range(400):
        words = rng.choices(WORDS, k=rng.choice([1, 5, 40, 300])) + rng.choices(rare, k=rng.choice([0, 1, 3]))
        docs.append((k % 390, " ".join(words)))
    items = [(k, " ".join(rng.choices(WORDS + rare, k=rng.choice([1, 2, 12])))) for k in range(40)]
    return docs, items


def test_terms_are_runs_of_letters_digits_and_what_is_beyond_ascii():
    text = "ABC-def_Ghi Éİx 12a\x7f中文　z"
    assert [t.decode() for t in term_stages.terms_of(text)] == terms(text)


def test_random_corpus(spark, documents, corpus):
    docs, items = corpus
    assert found(spark, documents(docs), items) == brute_force(docs, items)


@pytest.mark.parametrize("setting", [("SHARD_DOCS", 32), ("SHARD_POSTINGS", 50), ("BUNDLE_ITEMS", 3), ("PASS_BYTES", 100)])
def test_small_shards_bundles_and_passes_change_nothing(spark, documents, corpus, monkeypatch, setting):
    docs, items = corpus
    monkeypatch.setattr(term_stages, *setting)
    assert found(spark, documents(docs), items) == brute_force(docs, items)


def test_bundles_let_go_of_documents_that_cannot_win(corpus):
    """The bound holds: no document's later sum exceeds what its length allows."""
    import numpy as np

    search = term_stages.Search([{0: 2, 1: 1}], {0: 3, 1: 50}, 100, 4000)
    lengths = np.array([1, 10, 40, 4000])
    measure = search.measure(lengths)
    for tf in (1, 2, 10):
        held = np.minimum(tf, lengths)
        assert (term_stages.strength(held, measure) <= term_stages.strength(lengths, measure)).all()
    assert search.later({0: 2, 1: 1}, term_stages.OWNERS - 1) == 0


def test_odd_rows_and_ties(spark, documents):
    items = [(1, "alpha"), (1, "alpha"), (2, None), (3, ""), (None, "Alpha word"), (4, "!!"), (5, "unseen")]
    docs = ODD + [(k, "alpha beta") for k in (30, 20, 40, 20)] + [(k, "alpha beta") for k in range(100, 112)]
    assert found(spark, documents(docs), items) == brute_force(docs, items)


def test_empty_tables(spark, documents):
    assert found(spark, documents([]), [(1, "alpha")]) == []
    assert found(spark, documents([(1, "alpha")]), []) == []
