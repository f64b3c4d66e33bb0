from __future__ import annotations

import random
import re
from itertools import combinations

import pytest

from daybook.llm import near_dups
from tests.llm.conftest import ODD

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}


def brute_force(rows, size, percent):
    sets = [shingle_set(text, size) for _, text in rows]
    parent = {doc_id: doc_id for doc_id, _ in rows if doc_id is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, s), (b, t) in combinations([(r[0], s) for r, s in zip(rows, sets)], 2):
        if a is None or b is None or not s or not t:
            continue
        if 100 * len(s & t) >= percent * len(s | t):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return sorted(
        (-1 if doc_id is None else doc_id, len(s), -1 if doc_id is None else root(doc_id)) for (doc_id, _), s in zip(rows, sets)
    )


def found(docs, size, percent):
    rows = near_dups.grouped(docs, size, percent).collect()
    for row in rows:
        assert row.kept == (row.doc_id is None or row.doc_id == row.component_id)
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_shingles, -1 if r.component_id is None else r.component_id) for r in rows)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def families(seed, groups, members, most_edits):
    """Groups of copies with few to many edits, some copied again from a copy."""
    rng = random.Random(seed)
    rows = []
    for _ in range(groups):
        words = [f"w{rng.randrange(4000)}" for _ in range(rng.randint(40, 120))]
        texts = [" ".join(words)]
        for _ in range(members - 1):
            texts.append(edited(rng, rng.choice(texts).split(), rng.randint(0, most_edits)))
        rows += texts
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("size, percent", [(3, 85), (5, 80)])
def test_components_equal_brute_force(documents, size, percent):
    rows = families(3, 12, 12, 4)
    assert found(documents(rows), size, percent) == brute_force(rows, size, percent)


def test_large_buckets_are_compared_in_blocks(documents, monkeypatch):
    monkeypatch.setattr(near_dups, "SMALL_BUCKET", 3)
    monkeypatch.setattr(near_dups, "BLOCK", 8)
    monkeypatch.setattr(near_dups, "VOCABULARY", 50)
    monkeypatch.setattr(near_dups, "BROADCAST_NODES", 5)
    rows = families(8, 2, 60, 6)
    assert found(documents(rows), 3, 85) == brute_force(rows, 3, 85)


def test_odd_rows(documents):
    rows = [*ODD, (9, "ALPHA beta\x0bgamma delta  epsilon"), (10, "alpha beta"), (11, "Alpha\tBeta"), (12, "beta alpha")]
    assert found(documents(rows), 3, 85) == brute_force(rows, 3, 85)


def test_empty_table(documents):
    assert near_dups.grouped(documents([]), 3, 85).collect() == []
    assert near_dups.without_near_dups(documents([])).collect() == []


def test_one_of_each_group_stays_with_its_columns(documents):
    rows = families(5, 6, 5, 2) + [(None, "alpha beta"), (None, "alpha beta")]
    docs = documents(rows)
    kept = near_dups.without_near_dups(docs)
    assert kept.columns == docs.columns
    want = {c for d, _, c in brute_force(rows, 5, 80) if d >= 0 and c >= 0}
    got = [r.doc_id for r in kept.collect()]
    assert sorted(d for d in got if d is not None) == sorted(want)
    assert got.count(None) == 2


def test_rows_that_share_an_id_are_judged_by_their_texts(documents, sentence):
    """One id for three texts, one of them a copy of a smaller id's; copies of one row; texts without words."""
    one, two, three = sentence(40), sentence(40), sentence(40)
    rows = [(1, one), (2, two), (2, three), (2, one + " more"), (3, two), (4, ""), (4, " "), (4, None), (5, "x y"), (5, "x y")]
    rows += [(6, "A b c"), (6, "a  B c"), (7, "a b c")]
    kept = near_dups.without_near_dups(documents(rows)).collect()
    got = sorted(((r.doc_id, r.text) for r in kept), key=str)
    case = [row for row in got if row[0] == 6]
    assert len(case) == 1 and case[0] in rows
    want = [(1, one), (2, two), (2, three), (4, ""), (4, " "), (4, None), (5, "x y"), *case]
    assert got == sorted(want, key=str)


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(k + 1, k) for k in range(60)] + [(100, 200), (200, 150), (5, 5)], "a long, b long")
    labels = {r.node: r.label for r in near_dups.components(links).collect()}
    assert labels == {**{k: 0 for k in range(61)}, 100: 100, 150: 100, 200: 100}


def test_signatures_estimate_similarity(documents):
    rng = random.Random(2)
    circulant = near_dups.Circulant(coordinates=512)
    words = [f"w{k}" for k in range(400)]
    for edits in (5, 20, 60):
        a, b = " ".join(words), edited(rng, words, edits)
        s, t = near_dups.shingles(a, 3), near_dups.shingles(b, 3)
        true = len(shingle_set(a, 3) & shingle_set(b, 3)) / len(shingle_set(a, 3) | shingle_set(b, 3))
        assert abs((circulant(s) == circulant(t)).mean() - true) < 0.08
