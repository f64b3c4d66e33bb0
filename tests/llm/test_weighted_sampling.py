from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from daybook.llm import weighted_sampling
from tests.llm.conftest import ODD


def jaccard(a, b):
    a, b = Counter(a.lower().split()), Counter(b.lower().split())
    total = sum((a | b).values())
    return sum((a & b).values()) / total if total else 1.0


def edited(text, following):
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def check(rows, got):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    following = order[1:] + order[:1]
    want = Counter()
    for (doc_id, text), (_, after) in zip(order, following):
        text, after = text or "", after or ""
        want[doc_id, len(text), hashlib.sha256(edited(text, after).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want


@pytest.mark.parametrize("chunk", [1, 3, 2048])
def test_next_document_across_chunks(documents, sentence, monkeypatch, chunk):
    monkeypatch.setattr(weighted_sampling, "CHUNK_ROWS", chunk)
    rows = [(k * k, sentence(1 + k % 9)) for k in range(1, 30)] + [(2, None), (3, ""), (5, "é\U0001f600x")]
    got = weighted_sampling.compared(documents(rows)).collect()
    check(rows, got)
    by_id = {r.doc_id: r for r in got}
    ordered = sorted(rows)
    for (doc_id, _), (after, _) in zip(ordered, ordered[1:] + ordered[:1]):
        one, other = by_id[doc_id].fingerprint, by_id[after].fingerprint
        equal = sum(one[k : k + 4] == other[k : k + 4] for k in range(0, len(one), 4))
        want = float(one == other) if "" in (one, other) else equal / weighted_sampling.SAMPLES
        assert by_id[doc_id].near_next == want


def test_likeness_estimates_generalised_jaccard(documents, sentence):
    rows = [(k, sentence(60)) for k in range(60)]
    got = sorted(weighted_sampling.compared(documents(rows)).collect())
    errors = []
    for k, r in enumerate(got):
        text, after = rows[k][1], rows[(k + 1) % 60][1]
        errors += [r.near_edited - jaccard(text, edited(text, after)), r.near_next - jaccard(text, after)]
    spread = (sum(e * e for e in errors) / len(errors)) ** 0.5
    assert spread < 0.075 and abs(sum(errors) / len(errors)) < 0.08


def test_counts_weigh(documents):
    rows = [(1, "a a a a b"), (2, "a b b b b"), (3, "A a a a\tb "), (4, "c")]
    got = {r.doc_id: r for r in weighted_sampling.compared(documents(rows)).collect()}
    assert got[1].fingerprint == got[3].fingerprint
    assert got[1].near_next < 0.8
    assert got[3].near_next == 0.0


def test_odd_rows(documents):
    got = weighted_sampling.compared(documents(ODD)).collect()
    assert len(got) == len(ODD)
    assert {r.fingerprint for r in got if r.doc_id in (1, 2, 3)} == {""}
    assert len({r.fingerprint for r in got if r.doc_id == 6}) == 1
    by_id = {r.doc_id: r for r in got}
    assert (by_id[1].near_next, by_id[3].near_next) == (1.0, 0.0)


def test_one_document_and_none(documents):
    only = weighted_sampling.compared(documents([(4, "a b c d")])).collect()
    assert (only[0].near_next, only[0].near_edited <= 1) == (1.0, True)
    check([(4, "a b c d")], only)
    assert weighted_sampling.compared(documents([])).collect() == []


def test_plans_have_no_python(documents, sentence):
    rows, _ = weighted_sampling.in_chunks(documents([(1, "a")]))
    plan = weighted_sampling.fingerprints(rows.withColumn("k", F.lit(1)), ["k"], {"f": "text"})
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", text)


def test_many_borders(spark):
    borders = [(True, k, -5) for k in range(0, 1000, 10)]
    ids = spark.createDataFrame([(k,) for k in (-5, 0, 9, 10, 555, 990, 5000, None)], "doc_id long")
    known, digest = F.col("doc_id").isNotNull().alias("known"), F.lit(7).cast("long").alias("hash")
    key = F.struct(known, F.coalesce("doc_id", F.lit(0)).alias("id"), digest)
    got = [r[0] for r in ids.select(weighted_sampling._chunk(key, borders)).collect()]
    assert got == [0, 1, 1, 2, 56, 100, 100, 0]


def test_rows_of_one_id_are_divided(documents, sentence, monkeypatch):
    monkeypatch.setattr(weighted_sampling, "CHUNK_ROWS", 8)
    rows = [(7, sentence(5 + k % 7) + f" w{k}") for k in range(60)]
    rows += [(None, sentence(6) + f" n{k}") for k in range(40)]
    rows += [(k, sentence(6)) for k in range(100, 120)]
    chunked, hot = weighted_sampling.in_chunks(documents(rows))
    sizes = [r["count"] for r in chunked.groupBy("chunk").count().collect()]
    assert sum(sizes) == len(rows) and max(sizes) <= 32 and not hot
    assert len(weighted_sampling.compared(documents(rows)).collect()) == len(rows)


@pytest.mark.parametrize("copies", [3, 65_536])
def test_copies_of_one_row_are_counted(documents, sentence, monkeypatch, copies):
    monkeypatch.setattr(weighted_sampling, "CHUNK_ROWS", 8)
    monkeypatch.setattr(weighted_sampling, "COPIES", copies)
    again = sentence(9)
    rows = [(5, again)] * 50 + [(None, "")] * 30 + [(k, sentence(6)) for k in range(6, 26)]
    chunked, hot = weighted_sampling.in_chunks(documents(rows))
    assert hot and chunked.count() == 24
    got = weighted_sampling.compared(documents(rows)).collect()
    check(rows, got)
    of_five = sorted(r.near_next for r in got if r.doc_id == 5)
    assert of_five[1:] == [1.0] * 49 and of_five[0] < 1


def test_a_word_of_both_sides_is_sampled_once_to_the_same_effect(documents):
    rows = documents([(1, "a b b c a"), (2, "d"), (3, " ")]).select("doc_id", "text")
    rows = rows.withColumn("edited", F.concat(F.substring("text", 1, 5), F.lit("b x")))
    both = weighted_sampling.fingerprints(rows, ["doc_id"], {"one": "text", "other": "edited"})
    alone = {
        name: {r.doc_id: r.f for r in weighted_sampling.fingerprints(rows, ["doc_id"], {"f": name}).collect()}
        for name in ("text", "edited")
    }
    for r in both.collect():
        assert (r.one, r.other) == (alone["text"][r.doc_id], alone["edited"][r.doc_id])


def test_a_sample_costs_one_hash_a_step(spark):
    sample = str(weighted_sampling._sample(3)).lower()
    assert sample.count("xxhash64") == 1 and "ln(" not in sample and "log(" not in sample


def test_likeness_of_counts(documents):
    rng = random.Random(4)
    texts = [" ".join(w for w in "abcdefghij" for _ in range(rng.randrange(8))) for _ in range(80)]
    got = sorted(weighted_sampling.compared(documents(list(enumerate(texts)))).collect())
    errors = [r.near_next - jaccard(texts[k], texts[(k + 1) % 80]) for k, r in enumerate(got)]
    assert (sum(e * e for e in errors) / 80) ** 0.5 < 0.075 and abs(sum(errors) / 80) < 0.03
