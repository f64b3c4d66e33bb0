from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from daybook.llm import packing
from daybook.llm.common import WORD_TOKENIZER
from tests.llm.conftest import ODD


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(WORD_TOKENIZER)


def ids_of(tokenizer, text):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")


def check_layout(rows, limit):
    used = defaultdict(list)
    for row in rows:
        used[row.sequence_id].append((row.offset, row.length))
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert 0 < at <= limit


def test_words_are_encoded_as_in_the_whole_text(tokenizer, sentence):
    texts = [
        "a\x1cb  C",
        "don't STOP's 'll x,y., z...",
        "ÀÉ Œuvre. ΣΑΣ Σ. İstanbul",
        "क़ख़ 가나 ᄀ",
        "é ＡＢＣ １２３ a1b2, 3, 4. _a_. b",
        "<|endoftext|> a<|startoftext|>b.",
        "ªº, ß. µ, ÿ.",
        "tab\there nbsp x\r\n\r\n.",
        "a.\n,b , . .. ,. x, ",
        "     x",
        sentence(300),
    ]
    words = packing.WordIds(WORD_TOKENIZER, most=40)
    for text in texts * 2:
        assert words(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_pieces_of_odd_rows(documents, tokenizer):
    rows = packing.pack(documents(ODD), WORD_TOKENIZER, limit=64).collect()
    check_layout(rows, 64)
    want = Counter()
    for doc_id, text in ODD:
        ids = ids_of(tokenizer, text)
        for piece, start in enumerate(range(0, len(ids), 64)):
            part = ids[start : start + 64]
            want[doc_id, piece, start, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want


def test_empty_table(documents):
    assert packing.pack(documents([]), WORD_TOKENIZER).collect() == []


def test_buckets_share_no_sequence(documents, sentence):
    docs = documents([(k, sentence(5 + k % 40)) for k in range(400)])
    rows = packing.pack(docs, WORD_TOKENIZER, limit=256, per_bucket=64).collect()
    check_layout(rows, 256)
    assert len({r.doc_id for r in rows}) == 400
    least = -(-sum(r.length for r in rows) // 256)
    assert len({r.sequence_id for r in rows}) <= least + 8


def test_tightest_bin_is_found():
    rng = random.Random(1)
    for limit in (1, 7, 64, 100):
        lengths = sorted((rng.randint(1, limit) for _ in range(300)), reverse=True)
        rooms: list[int] = []
        for length in lengths:
            fitting = [(room, k) for k, room in enumerate(rooms) if room >= length]
            if fitting:
                rooms[min(fitting)[1]] -= length
            else:
                rooms.append(limit - length)
        bins, offsets = packing.best_fit(lengths, limit)
        assert len(set(bins)) == len(rooms)
        filled = Counter()
        for number, offset, length in zip(bins, offsets, lengths):
            assert offset == filled[number]
            filled[number] += length
        assert sorted(filled.values()) == sorted(limit - room for room in rooms)
