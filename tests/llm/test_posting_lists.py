from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.llm import posting_lists

SCHEMA = "vec_id long, embedding array<float>, score string, shard int"


def brute_force(vectors, k=10):
    ids = np.array(sorted(vectors))
    matrix = np.array([vectors[i] for i in ids], dtype=np.float64)
    found = {}
    for row, query in enumerate(ids):
        if query % 10 == 0:
            far = np.sqrt(((matrix - matrix[row]) ** 2).sum(axis=1))
            far[row] = np.inf
            order = np.lexsort((ids, far))[: min(k, len(ids) - 1)]
            found[query] = [(ids[o], far[o]) for o in order]
    return found


def search(spark, rows, k=10):
    table = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)
    found: dict = {}
    got = posting_lists.nearest(table, F.col("vec_id") % 10 == 0, k)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    for r in sorted(got.collect(), key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(found[r.query_id])
    return found


def recall(found, want):
    hits = sum(len({i for i, _ in found.get(q, [])} & {i for i, _ in near}) for q, near in want.items())
    return hits / sum(map(len, want.values()))


@pytest.mark.parametrize("clusters", [0, 20])
def test_recall_and_exact_scores(spark, monkeypatch, clusters):
    monkeypatch.setattr(posting_lists, "PER_LIST", 24)
    monkeypatch.setattr(posting_lists, "PER_CHUNK", 600)
    monkeypatch.setattr(posting_lists, "SAMPLE", 1200)
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(2000, 16)).astype(np.float32)
    if clusters:
        vectors = (vectors * 0.2 + rng.normal(size=(clusters, 16))[rng.integers(0, clusters, 2000)]).astype(np.float32)
    rows = {k: vectors[k].tolist() for k in range(2000)}
    found, want = search(spark, rows.items()), brute_force(rows)
    assert found.keys() == want.keys()
    assert recall(found, want) >= 0.9
    for query, near in found.items():
        assert len(near) == 10 and near == sorted(near, key=lambda n: (n[1], n[0]))
        for i, score in near:
            exact = np.sqrt(((vectors[i].astype(float) - vectors[query].astype(float)) ** 2).sum())
            assert score == pytest.approx(exact, abs=1e-12)


def test_a_third_of_equal_vectors(spark, monkeypatch):
    monkeypatch.setattr(posting_lists, "PER_LIST", 16)
    monkeypatch.setattr(posting_lists, "PER_CHUNK", 64)
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(600, 8)).astype(np.float32)
    vectors[::3] = vectors[0]
    rows = {k: vectors[k].tolist() for k in range(600)}
    found = search(spark, rows.items())
    # Ties go to the smaller ids.
    assert [i for i, _ in found[300]] == [0, 3, 6, 9, 12, 15, 18, 21, 24, 27]
    assert recall(found, brute_force(rows)) >= 0.9


def test_odd_vectors_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (10, [0.0, 1.0]), (11, [0.0, 1.0])]
    odd = [
        (20, None),
        (21, []),
        (22, [0.0, 0.0]),
        (23, [1.0, None]),
        (24, [float("nan"), 1.0]),
        (25, [float("inf"), 1.0]),
        (26, [1.0, 2.0, 3.0]),
        (None, [1.0, 0.0]),
        (1, [1.0, 1.0]),
        (10, [0.0, 1.0]),
    ]
    found = search(spark, rows + odd)
    root = 2**0.5
    assert found == {0: [(1, 1.0), (10, root), (11, root)], 10: [(11, 0.0), (1, 1.0), (0, root)]}


def test_no_rows_and_one_row(spark):
    assert search(spark, []) == {}
    assert search(spark, [(0, None)]) == {}
    assert search(spark, [(0, [1.0, 2.0])]) == {}


def test_centroids_are_balanced():
    rng = np.random.default_rng(3)
    vectors = np.concatenate([rng.normal(size=(900, 4)) * 0.1, rng.normal(size=(100, 4)) + 5])
    centroids = posting_lists.balanced_centroids(vectors, 20)
    nearest = posting_lists._squared(vectors, centroids).argmin(1)
    assert np.bincount(nearest, minlength=len(centroids)).max() <= 200


def test_a_walk_finds_the_nearest_centroid():
    rng = np.random.default_rng(4)
    index = posting_lists.fit(rng.normal(size=(3000, 8)), 6000)
    exact = 0
    for query in rng.normal(size=(100, 8)):
        far = ((index.centroids - query) ** 2).sum(1)
        exact += index.walk(query, 1.2)[0][1] == far.argmin()
    assert exact >= 97
