"""Language identification with error-correcting output codes over byte n-grams.

Every language has a codeword. One binary classifier per bit, linear in hashed byte n-grams, says how
strongly a text speaks for the languages with a 1 in that place. Decoding sums over the bits the
logistic loss of the evidence against each codeword, weighted by how reliable the bit is for that
language, and chooses the nearest codeword. A text whose two nearest codewords are about equally
near is flagged as ambiguous.

The classifiers are fitted on at most ``TRAIN_DOCS`` documents of a language, picked by a hash of
their id; every document is predicted from its whole text and nothing else.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product
from math import ceil, log2

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN = "und"
ORDERS = (2, 4)  # lengths of the byte n-grams
SLOT_BITS = 16
TRAIN_DOCS = 10_000  # of a language, for the n-gram counts
CHECK_DOCS = 1_000  # of a language, for the reliability of the bits
EVIDENCE = 0.15  # overlapping n-grams are no independent witnesses
AMBIGUOUS = 0.5  # share of the nearest codeword up to which a text is not decided

_HASH_RANGE = 1 << 30
_MOST_LANGUAGES_HELD = 256

# Letters of ASCII as lower case, all other ASCII as a space, other bytes as they are.
_AS_READ = bytes(
    b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)


def slots(text: str) -> np.ndarray:
    """Hashed n-grams of the text between two spaces."""
    read = f" {text.lower()} ".encode("utf-8", "replace").translate(_AS_READ)
    raw = np.frombuffer(read, np.uint8).astype(np.uint32)
    found = []
    for order in ORDERS:
        if len(raw) >= order:
            most = len(raw) - order + 1
            gram = raw[:most] + np.uint32(order << 8)
            for k in range(1, order):
                gram = gram * np.uint32(0x01000193) + raw[k : k + most]
            gram *= np.uint32(0x9E3779B1)
            found.append(gram >> np.uint32(32 - SLOT_BITS))
    return np.concatenate(found)


def evidence(text: str, weights: np.ndarray) -> np.ndarray:
    """Summed weights of all n-grams of the text, one sum per bit."""
    here = slots(text)
    if len(here) < 20_000:
        total = weights[here].sum(axis=0)
    else:
        total = np.bincount(here, minlength=len(weights)).astype(np.float32) @ weights
    return total.astype(np.float64) * EVIDENCE


def codewords(languages: int) -> np.ndarray:
    """A row of +1 and -1 per language.

    Up to five languages get every way to part them in two; more get the best of many drawn codes,
    by the least distance between two rows.
    """
    if languages < 2:
        return np.ones((languages, 0))
    if languages <= 5:
        ways = [(1, *rest) for rest in product((1, -1), repeat=languages - 1)]
        return np.array([w for w in ways if -1 in w]).T
    bits, rng = max(15, ceil(10 * log2(languages))), np.random.default_rng(languages)
    best, best_distance = None, -1.0
    for _ in range(50):
        drawn = rng.choice((-1, 1), size=(languages, bits))
        drawn[0, np.abs(drawn.sum(axis=0)) == languages] *= -1
        distance = ((bits - drawn @ drawn.T) / 2 + bits * np.eye(languages)).min()
        if distance > best_distance:
            best, best_distance = drawn, distance
    return best


@dataclass(frozen=True)
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # slots x bits
    reliability: np.ndarray  # languages x bits, mean 1 per language

    def decode(self, text: str | None) -> tuple[str, float, bool]:
        """Language, share of its codeword among all (0 to 1), and whether it is ambiguous."""
        if not text or not self.languages or not any(c.isalpha() for c in text):
            return UNKNOWN, 0.0, False
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        loss = np.logaddexp(0, -self.code * evidence(text, self.weights)) * self.reliability
        near = -loss.sum(axis=1)
        share = np.exp(near - near.max())
        share /= share.sum()
        best = int(near.argmax())
        return self.languages[best], float(share[best]), bool(share[best] <= AMBIGUOUS)


def _per_language(rows: DataFrame, most: int) -> DataFrame:
    """About ``most`` rows of each language at most, the same ones on every run."""
    shares = rows.groupBy("lang").agg((F.lit(most) / F.count(F.lit(1))).alias("__share"))
    # One row per language, so this side does not grow with the documents.
    place = F.pmod(F.xxhash64("doc_id"), F.lit(_HASH_RANGE)) / _HASH_RANGE
    return rows.join(F.broadcast(shares), "lang").filter(place < F.col("__share")).select("lang", "text")


def _count_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def told(held: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for lang, counts in held.items():
            seen = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(seen)), pa.array(seen, pa.int32()), pa.array(counts[seen])],
                ["lang", "slot", "n"],
            )

    held: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            if lang not in held:
                if len(held) == _MOST_LANGUAGES_HELD:
                    yield from told(held)
                    held = {}
                held[lang] = np.zeros(1 << SLOT_BITS, np.int64)
            here = slots(text.as_py())
            held[lang] += np.bincount(here, minlength=1 << SLOT_BITS)
    yield from told(held)


def fit(labelled: DataFrame, train_docs: int = TRAIN_DOCS, check_docs: int = CHECK_DOCS) -> Model:
    """Learn from (doc_id, lang, text); rows without language, text or id are left out.

    What comes to the driver has at most 65,536 rows per language.
    """
    rows = labelled.select(
        F.col("doc_id"), F.col("lang").cast("string"), F.col("text").cast("string")
    ).filter("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL")
    counted = (
        _per_language(rows, train_docs)
        .mapInArrow(_count_slots, "lang string, slot int, n long")
        .groupBy("lang", "slot")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    langs, places = np.unique(counted["lang"].to_numpy(zero_copy_only=False), return_inverse=True)
    languages = [str(lang) for lang in langs]
    counts = np.zeros((len(languages), 1 << SLOT_BITS))
    counts[places, counted["slot"].to_numpy()] = counted["n"].to_numpy()
    code = codewords(len(languages))
    likely = counts + 0.5
    likely /= likely.sum(axis=1, keepdims=True)
    weights = np.zeros((1 << SLOT_BITS, code.shape[1]), np.float32)
    for bit in range(code.shape[1]):
        yes = code[:, bit] > 0
        weights[:, bit] = np.log(likely[yes].mean(axis=0)) - np.log(likely[~yes].mean(axis=0))
    model = Model(languages, code, weights, np.ones(code.shape))
    if not code.size:
        return model

    at = {lang: k for k, lang in enumerate(languages)}

    def right_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right, seen = np.zeros(code.shape), np.zeros(len(languages))
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                right[at[lang]] += np.sign(evidence(text.as_py(), weights)) == code[at[lang]]
                seen[at[lang]] += 1
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(languages),
                pa.array(seen.tolist()),
                pa.array(right.tolist(), pa.list_(pa.float64())),
            ],
            ["lang", "seen", "right"],
        )

    told = _per_language(rows, check_docs).mapInArrow(
        right_bits, "lang string, seen double, right array<double>"
    )
    sums = told.groupBy("lang").agg(
        F.sum("seen").alias("seen"),
        F.array(*[F.sum(F.col("right")[b]) for b in range(code.shape[1])]).alias("right"),
    )
    reliability = np.ones(code.shape)
    for row in sums.collect():
        share = (np.array(row["right"]) + 1) / (row["seen"] + 2)
        reliability[at[row["lang"]]] = share / share.mean()
    return Model(languages, code, weights, reliability)


def language(text: Column, model: Model) -> Column:
    """A struct of lang_pred, score and ambiguous for each text, from the text alone."""
    shape = T.StructType.fromDDL("lang_pred string, score double, ambiguous boolean")

    @F.pandas_udf(shape)
    def decide(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(
            [model.decode(t) for t in texts], columns=["lang_pred", "score", "ambiguous"]
        )

    # Nondeterministic to the optimiser only: it must not evaluate it once more for a filter.
    return decide.asNondeterministic()(text.cast("string"))


def is_held_out(doc_id: Column) -> Column:
    """A third of the documents, by their id; a row without id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def predict(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score and ambiguous for every row of docs.

    Learns from the labelled rows that are not held out. Text that is NULL or has no letter is ``und``
    with score 0, and so is all text where nothing could be learned.
    """
    model = fit(docs.filter(~is_held_out(F.col("doc_id"))))
    found = docs.select("doc_id", language(F.col("text"), model).alias("found"))
    return found.select(
        "doc_id",
        is_held_out(F.col("doc_id")).alias("held_out"),
        "found.lang_pred",
        "found.score",
        "found.ambiguous",
    )


def accepted(docs: DataFrame) -> DataFrame:
    """The rows of docs, all columns as they are, whose language is known and not ambiguous."""
    model = fit(docs.filter(~is_held_out(F.col("doc_id"))))
    found = docs.withColumn("__language", language(F.col("text"), model))
    known = (F.col("__language.lang_pred") != UNKNOWN) & ~F.col("__language.ambiguous")
    return found.filter(known).drop("__language")
