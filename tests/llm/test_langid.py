from __future__ import annotations

import random
from zlib import crc32

import numpy as np
import pytest

from daybook.llm import langid
from tests.llm.conftest import ODD

STEMS = {
    "en": "the ing tion and er ou th wh".split(),
    "de": "der sch ung ein ich keit zu ver".split(),
    "fr": "le que eau ment ç ré oi est".split(),
    "es": "el ción ado que ñ mente los rr".split(),
    "sv": "och är ning att på sk het ö".split(),
    "pl": "nie się prz ość szcz ów ać jest".split(),
}

LEARNED = next(k for k in range(9) if crc32(str(k).encode()) % 3 != 1)


def text_in(rng, lang, words=25):
    return " ".join("".join(rng.choice(STEMS[lang]) for _ in range(rng.randint(1, 3))) for _ in range(words))


def labelled(languages, per_language=40, seed=1):
    rng = random.Random(seed)
    rows = [(text_in(rng, lang), lang) for lang in languages for _ in range(per_language)]
    rng.shuffle(rows)
    return [(k, text, lang) for k, (text, lang) in enumerate(rows)]


@pytest.mark.parametrize("languages", [["en", "de"], ["en", "de", "fr", "es"], list(STEMS)])
def test_held_out_accuracy(documents, languages):
    rows = labelled(languages)
    got = {r.doc_id: r for r in langid.predict(documents(rows)).collect()}
    held = [(k, lang) for k, _, lang in rows if crc32(str(k).encode()) % 3 == 1]
    assert {k for k, r in got.items() if r.held_out} == {k for k, _ in held}
    right = sum(got[k].lang_pred == lang for k, lang in held)
    assert right >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_only_rows_that_are_not_held_out_are_learned_from(documents):
    rows = labelled(["en", "de"])
    plain = langid.predict(documents(rows)).collect()
    wrong = [(k, t, "zz" if crc32(str(k).encode()) % 3 == 1 else lang) for k, t, lang in rows]
    assert sorted(plain) == sorted(langid.predict(documents(wrong)).collect())


def test_odd_rows(documents):
    rows = [(100 + k, t, lang) for k, t, lang in labelled(["en", "de"])] + ODD
    got = [r for r in langid.predict(documents(rows)).collect() if r.doc_id is None or r.doc_id < 100]
    assert len(got) == len(ODD)
    by_id = {r.doc_id: r for r in got}
    for doc_id in (1, 2, 3, 4):
        assert (by_id[doc_id].lang_pred, by_id[doc_id].score) == ("und", 0.0)
    assert not any(r.held_out for r in got if r.doc_id is None)
    assert {by_id[k].lang_pred for k in (6, 7, 8)} <= {"en", "de"}


def test_one_language_none_and_no_rows(documents):
    one = langid.predict(documents([(LEARNED, "alpha beta", "en"), (80, None, "en"), (90, "gamma", None)])).collect()
    assert {(r.doc_id, r.lang_pred) for r in one} == {(LEARNED, "en"), (80, "und"), (90, "en")}
    none = langid.predict(documents([(LEARNED, "alpha beta", None)])).collect()
    assert [(r.lang_pred, r.score) for r in none] == [("und", 0.0)]
    assert langid.predict(documents([])).collect() == []


def test_rejected_rows_leave_and_others_keep_their_columns(documents):
    rows = labelled(["en", "fr"]) + [(900, "123 ...", "en"), (901, None, "en"), (None, rows_text := "the and ering thou", None)]
    docs = documents(rows)
    kept = langid.accepted(docs)
    assert kept.columns == docs.columns
    got = kept.collect()
    assert len(got) == len(rows) - 2
    assert any(r.doc_id is None and r.text == rows_text for r in got)


def test_mixed_text_is_ambiguous():
    model = langid.Model(
        ["a", "b"], np.array([[1], [-1]]), np.zeros((1 << langid.SLOT_BITS, 1), np.float32), np.ones((2, 1))
    )
    assert model.decode("words without evidence")[2]


def test_long_texts_are_read_whole():
    rng = np.random.default_rng(0)
    weights = rng.normal(size=(1 << langid.SLOT_BITS, 3)).astype(np.float32) * 1e-4
    text = "alpha beta gamma " * 3000
    whole = weights[langid.slots(text)].sum(axis=0) * langid.EVIDENCE
    assert np.allclose(langid.evidence(text, weights), whole, rtol=1e-2, atol=1e-3)


@pytest.mark.parametrize("languages", [2, 3, 5, 6, 30])
def test_codewords_are_apart(languages):
    code = langid.codewords(languages)
    assert code.shape[0] == languages
    assert (np.abs(code.sum(axis=0)) < languages).all()
    apart = [(code[a] != code[b]).sum() for a in range(languages) for b in range(a)]
    assert min(apart) >= (1 if languages == 2 else code.shape[1] // 4)
