"""Best-fit packing of tokenised documents into sequences of a fixed length.

Documents become pieces of at most ``limit`` tokens. Pieces are dealt by hash into buckets of about
``PIECES_PER_BUCKET`` rows; each bucket is packed best-fit decreasing in one task. The open bins of a
bucket stand in a segment tree over remaining capacity, which finds the tightest bin that still
holds a piece in logarithmic time. Buckets share no bin: that costs at most a few loosely filled
bins per bucket, out of the thousands a bucket fills, and nothing is collected beyond a bucket.
"""

from __future__ import annotations

import gc
import os
import re
import zlib
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.session import checkpointed

TOKENS_PER_SEQUENCE = 4096
END_ID = 1
PIECES_PER_BUCKET = 16_384
CACHED_WORDS = 500_000  # per task, about 200 bytes each

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, __row long"


_LETTER = "a-z\xdf-\xf6\xf8-\xff"
_ENDED = re.compile(f"(?<=[{_LETTER}])([.,])(?=[ \n])")
_OTHERWISE = re.compile(f"[^{_LETTER}][.,][ \n]")


def _apart(text: str) -> str:
    """The text with a space before each single full stop or comma that ends a word of letters.

    Between a letter and white space it is a token of its own, next to other punctuation it is not.
    """
    if _OTHERWISE.search(text):
        return _ENDED.sub(r" \1", text)
    for mark, space in product(".,", " \n"):
        text = text.replace(mark + space, f" {mark}{space}")
    return text


class WordIds:
    """Ids of texts as little-endian unsigned 32-bit bytes, encoding each distinct word once.

    A word is what stands between plain spaces or line feeds. The tokenizer drops white space and
    never joins across it, so the ids of a text are those of its words in order. It also puts all in
    lower case and parts letters from punctuation: words of Latin-1 letters are looked up in lower
    case, without a full stop or comma at their end, and new ones are encoded in one go.
    """

    def __init__(self, path: str, most: int = CACHED_WORDS) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[number for token, number in vocabulary.items() if token.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {}
        self.forget()

    def forget(self) -> None:
        self.known.clear()
        self.known[""] = b""

    def __call__(self, text: str) -> bytes:
        latin = text.isascii() or _is_latin(text)
        if latin:
            text = _apart(text.lower())
        words = text.replace("\n", " ").split(" ")
        known = self.known
        ids = list(map(known.get, words))
        if None in ids:
            missing = [k for k, found in enumerate(ids) if found is None]
            new = {words[k] for k in missing}
            if len(known) + len(new) > self.most:
                self.forget()
            letters = [w for w in new if latin and w.isalpha()]
            other = [w for w in new if not (latin and w.isalpha())]
            known.update(zip(letters, self.encoded_letters(letters)))
            known.update(zip(other, self.encoded(other)))
            for k in missing:
                ids[k] = known[words[k]]
        return b"".join(ids)

    def encoded(self, words: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False) if words else []
        return [np.array(one.ids, "<u4").tobytes() for one in found]

    def encoded_letters(self, words: list[str]) -> list[bytes]:
        """Words of letters only, encoded as one text and cut where a word ends."""
        if not words:
            return []
        found = self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)
        ids = np.array(found[0].ids, "<u4")
        ends = (np.flatnonzero(self.ends_word[ids]) + 1).tolist()
        if len(ends) != len(words):
            return self.encoded(words)
        raw = ids.tobytes()
        return [raw[4 * start : 4 * end] for start, end in zip([0, *ends], ends)]


def _is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def token_pieces(
    docs: DataFrame, tokenizer_path: str, limit: int = TOKENS_PER_SEQUENCE, end_id: int = END_ID
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, and ``__row``, its place in its task.

    A document is the ids of its whole text and then ``end_id``; a NULL or empty text is that id alone.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, end, row = WordIds(tokenizer_path), end_id.to_bytes(4, "little"), 0
        # Nothing here refers to itself, and the collector would walk all words again and again.
        gc.disable()
        try:
            for batch in batches:
                out: list[list] = [[], [], [], [], [], []]
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    ids = memoryview(ids_of(text.as_py() or "") + end)
                    for piece, start in enumerate(range(0, len(ids) // 4, limit)):
                        part = ids[start * 4 : (start + limit) * 4]
                        values = (doc_id, piece, start, len(part) // 4, zlib.crc32(part), row)
                        for column, value in zip(out, values):
                            column.append(value)
                        row += 1
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "__row"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)
        finally:
            gc.enable()

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.mapInArrow(pieces, _PIECES)


class OpenBins:
    """Open bins by remaining capacity, in a segment tree that knows which capacities have a bin."""

    def __init__(self, limit: int) -> None:
        self.leaves = 1 << limit.bit_length()
        self.filled = bytearray(2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(limit + 1)]

    def add(self, room: int, number: int) -> None:
        self.bins[room].append(number)
        node = self.leaves + room
        while node and not self.filled[node]:
            self.filled[node] = 1
            node >>= 1

    def take_tightest(self, need: int) -> tuple[int, int] | None:
        """Remove and return (room, number) of the bin with the least room of at least ``need``."""
        filled, node = self.filled, self.leaves + need
        if not filled[node]:
            while node > 1 and (node & 1 or not filled[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if filled[2 * node] else 2 * node + 1
        room = node - self.leaves
        number = self.bins[room].pop()
        if not self.bins[room]:
            filled[node] = 0
            node >>= 1
            while node and not (filled[2 * node] or filled[2 * node + 1]):
                filled[node] = 0
                node >>= 1
        return room, number


def best_fit(lengths: list[int], limit: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each length, given in descending order."""
    free, bins, offsets, opened = OpenBins(limit), [], [], 0
    for length in lengths:
        found = free.take_tightest(length)
        if found is None:
            found = (limit, opened)
            opened += 1
        room, number = found
        bins.append(number)
        offsets.append(limit - room)
        if room > length:
            free.add(room - length, number)
    return bins, offsets


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    limit: int = TOKENS_PER_SEQUENCE,
    end_id: int = END_ID,
    per_bucket: int = PIECES_PER_BUCKET,
) -> DataFrame:
    """Pack whole documents into sequences of at most ``limit`` tokens.

    Returns a row per piece: doc_id, piece (from 0), start (ids of the document before it), length,
    ids_crc32, sequence_id, offset. Only documents above the limit are cut. Rows with equal or NULL ids
    are documents of their own; an empty table gives no rows; further columns are left out.

    Pieces are written to the checkpoint folder once, so the number of buckets follows from their
    count and no text is tokenised twice. A task that is run again packs the same rows alike.
    """
    pieces = checkpointed(token_pieces(docs, tokenizer_path, limit, end_id))
    buckets = max(1, -(-pieces.count() // per_bucket))

    def fill(rows: pa.Table) -> pa.Table:
        order = [("length", "descending")]
        order += [(name, "ascending") for name in ("doc_id", "piece", "ids_crc32", "__row")]
        rows = rows.sort_by(order)
        bins, offsets = best_fit(rows["length"].to_pylist(), limit)
        first = rows["bucket"][0].as_py() << 32
        return (
            rows.drop_columns(["__row", "bucket"])
            .append_column("sequence_id", pa.array([first + n for n in bins], pa.int64()))
            .append_column("offset", pa.array(offsets, pa.int64()))
        )

    bucket = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "__row"), F.lit(buckets))
    return (
        pieces.withColumn("bucket", bucket)
        .groupBy("bucket")
        .applyInArrow(
            fill,
            "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
        )
    )
