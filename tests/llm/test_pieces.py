"""Encoding by an agenda of pairs against the sentencepiece library."""

from __future__ import annotations

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor

from daybook.llm import pieces
from daybook.llm.common import PIECE_MODEL
from tests.llm.conftest import ODD


@pytest.fixture(scope="module")
def agenda():
    return pieces.Agenda(PIECE_MODEL)


ALPHABET = "ab cdeé \n\r\t▁  \x00　中文テ😀́xyz.;){}­<s>0"


@settings(max_examples=300, deadline=None)
@given(st.text(ALPHABET, max_size=80) | st.text(max_size=40))
def test_any_text_is_encoded_as_by_the_library(agenda, text):
    assert agenda([text]) == ([agenda.library.encode(text)], [True])


@settings(max_examples=200, deadline=None)
@given(st.text("abcdeé \n▁中", max_size=60))
def test_list_and_heap_merge_alike(agenda, text):
    assert agenda.merged_short(text) == agenda.merged_long(text)


def test_equal_scores_go_left_first(agenda):
    texts = ["aaaaa", "▁▁▁▁▁▁▁", "ababab", "s" * 50, " " * 70]
    assert agenda(texts)[0] == agenda.library.encode(texts)


def test_words_may_be_merged_on_their_own(agenda):
    text = "The quick  brown\nfox,  jumps\n\n over   it."
    words = [symbol for word in agenda.split(text) for symbol in agenda.merged(word)]
    assert agenda.merged(agenda.library.normalize(text)) == words


def test_a_full_cache_changes_nothing(agenda, monkeypatch):
    monkeypatch.setattr(pieces, "CACHED_CHARS", 10)
    for text in ("some words and some more words, some of them again", "again some words"):
        assert agenda([text, ""])[0] == agenda.library.encode([text, ""])


def test_words_that_the_library_encodes_otherwise_show(monkeypatch):
    own = pieces.Agenda(PIECE_MODEL)
    monkeypatch.setattr(own, "merged", list)
    ids, agree = own(["whole words", "", "x"])
    assert (ids, agree) == (own.library.encode(["whole words", "", "x"]), [False, True, False])


def test_portions_keep_all_texts(monkeypatch):
    monkeypatch.setattr(pieces, "PORTION_CHARS", 5)
    texts = ["", "abc", "defghij", "", "k", "lmnop", ""]
    assert [t for run in pieces._portions(texts) for t in run] == texts


def expected(rows):
    library = SentencePieceProcessor(model_file=PIECE_MODEL)
    out = []
    for doc_id, text in rows:
        ids = library.encode(text or "")
        digest = [hashlib.sha256(v.encode()).hexdigest() for v in (",".join(map(str, ids)), library.decode(ids))]
        out.append((doc_id, len(ids), *digest, True))
    return sorted(out, key=str)


def test_odd_rows(spark, documents):
    found = pieces.digests(documents(ODD), PIECE_MODEL)
    assert sorted(map(tuple, found.collect()), key=str) == expected(ODD)
    assert pieces.digests(documents([]), PIECE_MODEL).collect() == []


def test_ids_and_text_come_back(spark, documents):
    row = pieces.encoded(documents([(1, "two  words\n")]), PIECE_MODEL).first()
    assert row.decoded == "two  words\n" and row.agrees and len(row.ids) > 2
    row = pieces.encoded(documents([(1, None)]), PIECE_MODEL).first()
    assert (row.ids, row.decoded) == ([], "")


def test_query_over_the_fixture(spark, small):
    from daybook.llm.queries import QUERIES

    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    found = QUERIES["op13_piece_agenda"](spark, small)
    assert sorted(map(tuple, found.collect()), key=str) == expected([tuple(r) for r in docs.collect()])
