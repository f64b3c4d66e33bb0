"""SentencePiece encoding and decoding for vocabularies of merges, by an agenda of symbol pairs.

A text is a row of symbols, at first its characters. Every two neighbours that together are a piece of
the vocabulary stand on an agenda, ordered by the score of that piece and then from the left. The best
pair is merged, which puts its new neighbours on the agenda, until the agenda is empty. Symbols
that are no piece then become their bytes.

No piece of such a vocabulary goes on past the end of a word, so a text falls into words that are merged on
their own, and a task merges each distinct word once. The new words of an Arrow batch are checked
against the sentencepiece library together; the library also decodes the ids of each whole text.
"""

from __future__ import annotations

import gc
import hashlib
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"  # stands for a space in pieces
CACHED_CHARS = 5_000_000  # of words merged before, per task; about 150 MB
SHORT = 32  # characters; the agenda of a shorter word is a list, that of a longer one a heap
PORTION_CHARS = 1 << 20  # of texts that are worked on together

_COLUMNS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, agrees boolean"


class Agenda:
    """Pieces of texts for one vocabulary, by repeatedly merging the best pair of neighbours."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_file=path)
        numbers = range(self.library.get_piece_size())
        name = {k: self.library.id_to_piece(k) for k in numbers}
        special = (self.library.is_control, self.library.is_unknown, self.library.is_byte)
        ordinary = [k for k in numbers if not any(kind(k) for kind in special)]
        self.ids = {name[k]: k for k in ordinary}
        scores = {name[k]: self.library.get_score(k) for k in ordinary}
        # The place of a piece's score among all scores, best first; equal scores share a place.
        place = {score: k for k, score in enumerate(sorted(set(scores.values()), reverse=True))}
        self.places = {piece: place[score] for piece, score in scores.items()}
        self.never = len(place)
        bytes_ = [k for k in numbers if self.library.is_byte(k)]
        self.bytes = {int(name[k][1:-1], 16): k for k in bytes_}
        self.unknown = self.library.unk_id()
        self.joined = {piece[k : k + 2] for piece in self.ids for k in range(len(piece) - 1)}
        # Where a word may end: before a run of spaces, and around a character that never merges.
        inner = any(SPACE in pair[1:] and pair[0] != SPACE for pair in self.joined)
        self.lone = "" if any("\n" in pair for pair in self.joined) else "\n"
        words = f"{SPACE}+[^{SPACE}{self.lone}]*|[^{SPACE}{self.lone}]+|\n"
        self.words = None if inner else re.compile(words)
        self.line = self.library.encode("\n")
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, tuple[int, ...]] = {"": ()}
        self.differing: set[str] = set()
        self.held = 0

    def merged(self, text: str) -> list[str]:
        """The symbols of a text that no further merge joins."""
        return self.merged_short(text) if len(text) <= SHORT else self.merged_long(text)

    def merged_short(self, text: str) -> list[str]:
        symbols, get, never = list(text), self.places.get, self.never
        agenda = [get(one + two, never) for one, two in zip(symbols, symbols[1:])]
        while agenda:
            best = min(agenda)
            if best == never:
                break
            k = agenda.index(best)  # the first of equals
            symbols[k] += symbols.pop(k + 1)
            del agenda[k]
            if k < len(agenda):
                agenda[k] = get(symbols[k] + symbols[k + 1], never)
            if k:
                agenda[k - 1] = get(symbols[k - 1] + symbols[k], never)
        return symbols

    def merged_long(self, text: str) -> list[str]:
        symbols, places = list(text), self.places
        last = len(symbols) - 1
        before, after = list(range(-1, last)), [*range(1, last + 1), -1]
        agenda = []
        for left in range(last):
            piece = symbols[left] + symbols[left + 1]
            if piece in places:
                agenda.append((places[piece], left, left + 1, piece))
        heapify(agenda)
        while agenda:
            _, left, right, piece = heappop(agenda)
            # One of the two may have been merged with another neighbour since.
            if after[left] != right or symbols[left] + symbols[right] != piece:
                continue
            following = after[right]
            symbols[left], symbols[right] = piece, ""
            after[left], after[right] = following, -2
            if following >= 0:
                before[following] = left
            for one, two in ((before[left], left), (left, following)):
                if one >= 0 and two >= 0:
                    piece = symbols[one] + symbols[two]
                    if piece in places:
                        heappush(agenda, (places[piece], one, two, piece))
        return [symbol for symbol in symbols if symbol]

    def ids_of_word(self, word: str) -> tuple[int, ...]:
        symbols = self.merged(word)
        ids = tuple(map(self.ids.get, symbols))
        if None not in ids:
            return ids
        found: list[int] = []
        for symbol, number in zip(symbols, ids):
            if number is not None:
                found.append(number)
            elif self.bytes:
                found.extend(self.bytes[b] for b in symbol.encode())
            else:
                found.append(self.unknown)
        return tuple(found)

    def split(self, text: str) -> list[str]:
        """The words of a text once it is normalised; empty ones mean nothing."""
        normal = self.library.normalize(text)
        if self.words is None:
            return [normal]
        if SPACE + SPACE in normal or " " in normal:
            return self.words.findall(normal)
        if self.lone:
            normal = normal.replace("\n", " \n ")
        return normal.replace(SPACE, " " + SPACE).split(" ")

    def learn(self, words: set[str]) -> None:
        """Merge new words and note those that the library encodes otherwise."""
        if self.held > CACHED_CHARS:
            self.forget()
        new = [word for word in words if word not in self.known]
        for word in new:
            # A last character that no piece joins to the one before, like a full stop, is a word of its own.
            if len(word) > 1 and word[-2:] not in self.joined:
                stem, end = word[:-1], word[-1]
                for part in (stem, end):
                    if part not in self.known:
                        self.known[part] = self.ids_of_word(part)
                        self.held += len(part)
                self.known[word] = self.known[stem] + self.known[end]
            else:
                self.known[word] = self.ids_of_word(word)
            self.held += len(word)
        # The library puts a space before a text, so words stand after the end of a line here.
        alone = [word[1:] if self.words is None else "\n" + word for word in new]
        start = 0 if self.words is None else len(self.line)
        for word, ids in zip(new, self.library.encode(alone, num_threads=1)):
            if tuple(ids[start:]) != self.known[word]:
                self.differing.add(word)

    def __call__(self, texts: list[str]) -> tuple[list[list[int]], list[bool]]:
        """The ids of texts, and for each whether all its words were encoded as the library does."""
        split = [self.split(text) for text in texts]
        self.learn(set().union(*split))
        ids = [list(chain.from_iterable(map(self.known.__getitem__, words))) for words in split]
        agree = [self.differing.isdisjoint(words) for words in split]
        for k, same in enumerate(agree):
            if not same:
                ids[k] = self.library.encode(texts[k])
        return ids, agree


def _portions(texts: list[str]) -> Iterator[list[str]]:
    """The texts in runs of about ``PORTION_CHARS`` characters."""
    run: list[str] = []
    chars = 0
    for text in texts:
        run.append(text)
        chars += len(text)
        if chars >= PORTION_CHARS:
            yield run
            run, chars = [], 0
    if run:
        yield run


def encoded(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, ids of each whole text as an array, its decoded text, and whether the library agrees.

    The ids are those of the sentencepiece library without begin and end ids. Where it encodes a word of a
    text otherwise than the agenda, its ids of the whole text stand and ``agrees`` is false; a vocabulary of
    merges without unused or user-defined pieces gives no such case. NULL counts as empty and has no
    ids. Rows with equal or NULL ids are rows of their own; columns other than doc_id and text are left out.
    """
    schema = "doc_id long, ids array<int>, decoded string, agrees boolean"
    return _batches(docs, model_path, schema, lambda ids, decoded, agrees, names: (ids, decoded, agrees))


def digests(docs: DataFrame, model_path: str) -> DataFrame:
    """What ``encoded`` finds as doc_id, n_tokens, ids_sha256, decoded_sha256 and agrees.

    ids_sha256 is of the decimal ids joined by commas, decoded_sha256 of the decoded text in UTF-8.
    """

    def digest(ids: list[int], decoded: str, agrees: bool, names: list[str]) -> tuple:
        written = ",".join(map(names.__getitem__, ids))
        hashed = [hashlib.sha256(value.encode()).hexdigest() for value in (written, decoded)]
        return (len(ids), *hashed, agrees)

    return _batches(docs, model_path, _COLUMNS, digest)


def _batches(docs: DataFrame, model_path: str, schema: str, row) -> DataFrame:
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "array<int>": pa.list_(pa.int32())}
    fields = [field.split(" ") for field in schema.split(", ")][1:]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        agenda = Agenda(model_path)
        names = [str(k) for k in range(agenda.library.get_piece_size())]
        # Nothing here refers to itself, and the collector would walk all words again and again.
        gc.disable()
        try:
            for batch in batches:
                rows = []
                for run in _portions([text.as_py() or "" for text in batch.column(1)]):
                    found, agree = agenda(run)
                    decoded = agenda.library.decode(found, num_threads=1)
                    for ids, text, same in zip(found, decoded, agree):
                        rows.append(row(ids, text, same, names))
                made = [pa.array([r[k] for r in rows], kinds[kind]) for k, (_, kind) in enumerate(fields)]
                columns = ["doc_id", *[name for name, _ in fields]]
                yield pa.RecordBatch.from_arrays([batch.column(0), *made], columns)
        finally:
            gc.enable()

    return texts.mapInArrow(encode, schema)
