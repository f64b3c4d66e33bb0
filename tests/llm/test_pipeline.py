"""The pipeline and the registered queries, against the operators' own rules."""

from __future__ import annotations

import random
from collections import Counter

import pytest

import __spark_entry__ as registered
import corpus_pipeline
from daybook.llm import mixing, near_dups
from daybook.llm.queries import QUERIES, SQL
from tests.llm.test_near_dups import brute_force, families
from tools.compare import difference, oracle


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """A folder with a documents table: families of copies, personal data, texts without letters."""
    rng = random.Random(3)
    rows = []
    for doc_id, text in families(3, 10, 6, 2):
        if doc_id % 7 == 0:
            text += f" mail u{doc_id}@example.org"
        rows.append((doc_id, text, rng.choice(["en", "en", "de"]), f"src{doc_id % 3}", len(text)))
    rows += [(900, "123 456", "en", "src0", 7), (901, None, None, None, None), (902, "", "de", "src1", 0)]
    folder = str(tmp_path_factory.mktemp("corpus"))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
    return folder, rows


def test_stages_in_order_keep_the_columns_of_documents(spark, corpus, tmp_path):
    folder, rows = corpus
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language", "near_duplicates", "personal_data", "mixing", "packing"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, folder)
        if name != "packing":
            assert found.dtypes == docs.dtypes
        found.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = docs.collect()

    texts = {r[0]: r[1] for r in rows}
    assert {r.doc_id for r in kept["language"]} == set(texts) - {900, 901, 902}
    pairs = [(r.doc_id, r.text) for r in kept["language"]]
    alone = {c for _, _, c in brute_force(pairs, 5, 80)}
    assert sorted(r.doc_id for r in kept["near_duplicates"]) == sorted(alone)
    for r in kept["personal_data"]:
        assert r.text == texts[r.doc_id].replace(f"u{r.doc_id}@example.org", "[EMAIL]") and r.n_chars == len(r.text)
    clean = spark.read.parquet(str(tmp_path / "personal_data"))
    times = {
        r.doc_id: r.epochs + (r.prefix_tokens > 0)
        for r in mixing.mix(mixing.leaf_columns(clean), mixing.TREE).collect()
    }
    assert Counter(r.doc_id for r in kept["mixing"]) == Counter({d: n for d, n in times.items() if n})
    assert Counter(r.doc_id for r in kept["packing"] if r.piece == 0) == Counter(r.doc_id for r in kept["mixing"])


def test_run_gives_the_rows_of_the_last_stage(spark, corpus):
    folder, _ = corpus
    found = corpus_pipeline.run(spark, folder)
    assert found.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert found.count() > 0


def test_empty_documents(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_every_operator_is_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert QUERIES.keys() <= registered.queries().keys() and "pipeline" in registered.queries()
    assert SQL.keys() <= registered.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, small, name):
    assert difference(spark, oracle(small), small, QUERIES[name], SQL[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op2_license_digests", "op7_site_quality"}))
def test_a_row_for_each_document(spark, small, name):
    """What reads documents returns a row of each, what reads pages, vectors or items rows of each of theirs."""
    tables = {"op3_posting_lists": "embeddings", "op8_block_tree_html": "pages", "op11_term_stages": "benchmark"}
    table = tables.get(name, "documents")
    rows = spark.read.parquet(f"{small}/{table}.parquet")
    found = QUERIES[name](spark, small)
    if table == "embeddings":
        assert found.count() == 10 * rows.filter("vec_id % 100 = 0").count()
    else:
        key = {"pages": "page_id", "benchmark": "item_id"}.get(table, "doc_id")
        assert {r[0] for r in found.select(key).collect()} == {r[0] for r in rows.select(key).collect()}


def test_near_duplicates_of_the_fixture(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = near_dups.grouped(docs, 3, 85).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute_force(rows, 3, 85)
