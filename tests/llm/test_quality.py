from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.llm import quality
from tests.llm.conftest import ODD


def rated(docs, labels):
    return quality.rated(docs, labels, F.col("source"), F.col("lang")).collect()


@pytest.fixture
def corpus(documents, spark, sentence):
    """Good prose and three kinds of junk, over four hosts; a third of it is labelled."""
    rng = random.Random(7)
    rows, good = [], {}
    for k in range(300):
        text, kind = sentence(rng.randint(20, 80)) + ".", k % 5
        if kind == 0:
            text = " ".join(w + "###" for w in text.split())
        elif kind == 1 and k % 2:
            text = text.upper().replace(" ", "!! ")
        elif kind == 2 and k % 3 == 0:
            text = " ".join(w for w in text.split()[:5] for _ in range(10))
        good[k] = int(text[0].islower() and "###" not in text and text.split()[0] != text.split()[1])
        rows.append((k, text, rng.choice(["en", "de"]), f"host{k % 4}"))
    labels = spark.createDataFrame([(k, g, 0) for k, g in good.items() if k % 3], "doc_id long, quality int, toxic int")
    return documents(rows), labels, good


def test_unlabelled_documents_are_told_apart(corpus):
    docs, labels, good = corpus
    got = rated(docs, labels)
    assert len(got) == 300
    held = [r for r in got if r.doc_id % 3 == 0]
    assert sum(r.kept == bool(good[r.doc_id]) for r in held) >= 0.95 * len(held)
    assert all(0 <= r.quality <= 1 and 0 < r.path_quality < 1 and 0 < r.host_quality < 1 for r in got)


def test_sites_equal_brute_force(corpus):
    docs, labels, _ = corpus
    got = {r.doc_id: r for r in rated(docs, labels)}
    rows = {r.doc_id: r for r in docs.collect()}
    base = labels.agg(F.avg("quality")).first()[0]
    own = {k: 1 / (1 + np.exp(-(r.evidence + np.log(base / (1 - base))))) for k, r in got.items()}
    mean = sum(own.values()) / len(own)
    hosts: dict = {}
    for k, r in rows.items():
        hosts.setdefault(r.source, []).append(own[k])
    spark = docs.sparkSession
    sites = spark.createDataFrame([(len(v), float(sum(v))) for v in hosts.values()], "n long, total double")
    pull = quality._pull(sites)
    for k, r in rows.items():
        here = hosts[r.source]
        want = (sum(here) - own[k] + pull * mean) / (len(here) - 1 + pull)
        assert got[k].host_quality == pytest.approx(want, abs=1e-9)


def test_a_bad_site_pulls_its_documents_down(documents, spark, sentence):
    rng = random.Random(1)
    rows, labels = [], []
    for k in range(400):
        bad = k % 2 == 0 and rng.random() < 0.95
        text = sentence(30)
        rows.append((k, " ".join(w + "$$" for w in text.split()) if bad else text, "en", f"host{k % 2}"))
        labels.append((k, int(not bad)))
    rows += [(1000, "alpha beta", "en", "host0"), (1001, "alpha beta", "en", "host1"), (1002, "alpha beta", "xx", "new")]
    got = {r.doc_id: r for r in rated(documents(rows), spark.createDataFrame(labels, "doc_id long, quality int"))}
    assert got[1000].path_quality < 0.3 < 0.9 < got[1001].path_quality
    assert got[1000].quality < got[1002].quality < got[1001].quality
    # A site of one document stands at the prior of all.
    assert abs(got[1002].path_quality - 0.525) < 0.05


def test_odd_rows_and_labels(documents, spark, sentence):
    schema = "doc_id long, quality int"
    labels = spark.createDataFrame([(6, 1), (6, 1), (7, 0), (None, 1), (8, None), (99, 0)], schema)
    got = rated(documents(ODD), labels)
    assert len(got) == len(ODD)
    assert all(0 <= r.quality <= 1 and r.kept is not None for r in got)
    assert rated(documents([]), labels) == []
    none = rated(documents(ODD), spark.createDataFrame([], schema))
    assert len(none) == len(ODD) and {r.evidence for r in none} == {0.0}


def test_pull_follows_how_much_sites_differ(spark):
    same = spark.createDataFrame([(100, 50.0)] * 20, "n long, total double")
    apart = spark.createDataFrame([(100, 95.0), (100, 5.0)] * 10, "n long, total double")
    assert quality._pull(same) == quality.MOST_PULL
    assert quality._pull(apart) < 10
