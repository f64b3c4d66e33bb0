"""Ranked lexical search by pipelined term partitioning, in whole numbers.

Terms are split among owners, from the rarest to the most common. Documents fall into shards,
items into bundles, and a bundle goes through each shard once: it visits one term owner after
the other, each visit a cogroup of the bundle with the postings that owner has for it, and
carries one sparse row of documents and sums per item. The last owner leaves the best of the shard,
from which the best of all are selected.

Before it moves on, a bundle lets go of documents that cannot come among the best of their shard any
more: those whose sum, plus the most that the terms of all later owners could add to a document of that
length, stays below the sums that enough others have already. That changes no result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daybook.session import checkpointed

OWNERS = 3
BEST = 10
BUNDLE_ITEMS = 256
SHARD_DOCS = 16_384  # less than 2^16
SHARD_POSTINGS = 4_000_000
PASS_BYTES = 16 << 20  # of distinct item texts that go through the documents together

FULL = 100  # a document's length counts for SLOPE of FULL parts
SLOPE = 75
UNIT = 1_000_000_000
RISE = 1000
FLATTEN = 8

# A-Z in lower case; what is neither a letter, a digit nor beyond ASCII separates.
_TERM = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a whole text in UTF-8, in order."""
    return (text or "").encode("utf-8", "replace").translate(_TERM).split()


def _shards(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """A row per shard: its documents and the postings of the numbered terms, by term and document.

    ``docs`` and ``lengths`` are per document, ``terms`` and ``dfs`` per term, ``places`` (of documents in the
    shard) and ``tfs`` per posting.
    """
    kinds = {"shard": pa.int64(), "docs": pa.list_(pa.int64()), "lengths": pa.binary(), "terms": pa.list_(pa.int32())}
    kinds |= {"dfs": pa.list_(pa.int32()), "places": pa.binary(), "tfs": pa.binary(), "filled": pa.int64(), "total": pa.int64()}
    many = max(1, len(numbers))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        ids: list[int | None] = []
        lengths: list[int] = []
        found: list[np.ndarray] = []
        held = 0

        def shard() -> pa.RecordBatch:
            keys, tfs = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.int64),) * 2
            terms, places = np.divmod(keys, SHARD_DOCS)
            named, dfs = np.unique(terms, return_counts=True)
            row = {
                "shard": (task << 32) + made,
                "docs": ids,
                "lengths": np.array(lengths, np.int64).tobytes(),
                "terms": named.astype(np.int32),
                "dfs": dfs.astype(np.int32),
                "places": places.astype(np.uint16).tobytes(),
                "tfs": tfs.astype(np.uint32).tobytes(),
                "filled": sum(length > 0 for length in lengths),
                "total": sum(lengths),
            }
            return pa.RecordBatch.from_arrays([pa.array([row[n]], k) for n, k in kinds.items()], list(kinds))

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                terms = terms_of(text.as_py())
                numbered = [n for n in map(numbers.get, terms) if n is not None]
                if numbered:
                    found.append(np.array(numbered, np.int64) * SHARD_DOCS + len(ids))
                    held += len(numbered)
                ids.append(doc_id)
                lengths.append(len(terms))
                if len(ids) == SHARD_DOCS or held >= SHARD_POSTINGS:
                    yield shard()
                    made += 1
                    ids, lengths, found, held = [], [], [], 0
        if ids:
            yield shard()

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = (
        "shard long, docs array<long>, lengths binary, terms array<int>, dfs array<int>, places binary, "
        "tfs binary, filled long, total long"
    )
    assert many * SHARD_DOCS < 1 << 63
    return texts.mapInArrow(read, schema)


class Search:
    """What every task knows of a pass: item terms with weights and owners, and the corpus counts."""

    def __init__(self, items: list[dict[int, int]], dfs: dict[int, int], filled: int, total: int) -> None:
        self.filled, self.total = filled, total
        self.weights = {t: weight(filled, df) for t, df in dfs.items()}
        self.bundles = [items[k : k + BUNDLE_ITEMS] for k in range(0, len(items), BUNDLE_ITEMS)]
        self.owner, passed, every = {}, 0, max(1, sum(dfs.values()))
        for term in sorted(dfs, key=lambda t: (dfs[t], t)):
            self.owner[term] = min(OWNERS - 1, passed * OWNERS // every)
            passed += dfs[term]

    def later(self, item: dict[int, int], owner: int) -> int:
        """The weights of an item's terms that come after an owner."""
        return sum(self.weights[t] * n for t, n in item.items() if t in self.owner and self.owner[t] > owner)

    def measure(self, lengths: np.ndarray) -> np.ndarray:
        return FULL - SLOPE + SLOPE * lengths * self.filled // max(1, self.total)


def weight(filled: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * filled + 2) / (2 * df + 1)))


def strength(tf: np.ndarray, measure: np.ndarray) -> np.ndarray:
    """What one occurrence count is worth in a document, at most UNIT / RISE; it grows with the count."""
    return UNIT * tf // (RISE * tf + FLATTEN * measure)


def _dealt(shards: DataFrame, search: Search) -> DataFrame:
    """shard, bundle, owner and the postings that an owner has for a bundle in a shard."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                places, tfs = np.frombuffer(row["places"], np.uint16), np.frombuffer(row["tfs"], np.uint32)
                ends = np.cumsum(np.array([0, *row["dfs"]], np.int64))
                at = {t: k for k, t in enumerate(row["terms"])}
                for number, bundle in enumerate(search.bundles):
                    wanted = sorted({t for item in bundle for t in item if t in at})
                    for owner in range(OWNERS):
                        terms = [t for t in wanted if search.owner[t] == owner]
                        parts = [slice(ends[at[t]], ends[at[t] + 1]) for t in terms]
                        if not parts:
                            continue
                        out = {
                            "shard": [row["shard"]],
                            "bundle": pa.array([number], pa.int32()),
                            "owner": pa.array([owner], pa.int32()),
                            "terms": pa.array([terms], pa.list_(pa.int32())),
                            "dfs": pa.array([[p.stop - p.start for p in parts]], pa.list_(pa.int32())),
                            "places": pa.array([np.concatenate([places[p] for p in parts]).tobytes()], pa.binary()),
                            "tfs": pa.array([np.concatenate([tfs[p] for p in parts]).tobytes()], pa.binary()),
                        }
                        yield pa.RecordBatch.from_pydict(out)

    schema = "shard long, bundle int, owner int, terms array<int>, dfs array<int>, places binary, tfs binary"
    return shards.select("shard", "terms", "dfs", "places", "tfs").mapInArrow(deal, schema)


_CARRIED = "shard long, bundle int, docs array<long>, lengths binary, counts array<int>, places binary, sums binary"
_LEFT = "item int, doc_id long, score long"


def _visit(owner: int, search: Search):
    """The visit of a bundle to an owner; the last one returns the best of the shard instead."""
    last = owner == OWNERS - 1
    empty = pa.schema([(n, k) for n, k in (_left_kinds() if last else _carried_kinds())])

    def visit(carried: pa.Table, owned: pa.Table) -> pa.Table:
        if not carried.num_rows:
            return empty.empty_table()
        row = carried.to_pylist()[0]
        bundle = search.bundles[row["bundle"]]
        lengths = np.frombuffer(row["lengths"], np.int64)
        measure = search.measure(lengths)
        sums = np.zeros((len(bundle), len(lengths)), np.int64)
        start = 0
        places, before = np.frombuffer(row["places"], np.uint16), np.frombuffer(row["sums"], np.int64)
        for k, count in enumerate(row["counts"]):
            sums[k, places[start : start + count]] = before[start : start + count]
            start += count
        for own in owned.to_pylist():
            holders: dict[int, list[tuple[int, int]]] = {t: [] for t in own["terms"]}
            for k, item in enumerate(bundle):
                for t in item.keys() & holders.keys():
                    holders[t].append((k, search.weights[t] * item[t]))
            places, tfs = np.frombuffer(own["places"], np.uint16), np.frombuffer(own["tfs"], np.uint32).astype(np.int64)
            worth = strength(tfs, measure[places])
            start = 0
            for t, df in zip(own["terms"], own["dfs"]):
                here, part = places[start : start + df], worth[start : start + df]
                for k, times in holders[t]:
                    sums[k, here] += times * part
                start += df
        if last:
            return _best(row, sums)
        return _onward(row, bundle, lengths, measure, sums)

    def _best(row: dict, sums: np.ndarray) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        for k, scores in enumerate(sums):
            some = np.flatnonzero(scores)
            if len(some) > BEST:
                some = some[scores[some] >= np.partition(scores[some], -BEST)[-BEST]]
            rows = [(-int(scores[p]), row["docs"][p] is None, row["docs"][p] or 0) for p in some]
            for score, missing, doc_id in sorted(rows)[:BEST]:
                for column, value in zip(out, (row["bundle"] * BUNDLE_ITEMS + k, None if missing else doc_id, -score)):
                    column.append(value)
        return pa.table({n: pa.array(c, kind) for c, (n, kind) in zip(out, _left_kinds())})

    def _onward(row: dict, bundle: list, lengths: np.ndarray, measure: np.ndarray, sums: np.ndarray) -> pa.Table:
        most = strength(np.maximum(lengths, 1), measure)
        counts, places, values = [], [], []
        for k, item in enumerate(bundle):
            some = np.flatnonzero(sums[k])
            if len(some) > BEST:
                least = np.partition(sums[k, some], -BEST)[-BEST]
                some = some[sums[k, some] + search.later(item, owner) * most[some] >= least]
            counts.append(len(some))
            places.append(some.astype(np.uint16))
            values.append(sums[k, some])
        row |= {"counts": counts, "places": np.concatenate(places).tobytes(), "sums": np.concatenate(values).tobytes()}
        return pa.Table.from_pylist([row], empty)

    return visit


def _left_kinds() -> list[tuple[str, pa.DataType]]:
    return [("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())]


def _carried_kinds() -> list[tuple[str, pa.DataType]]:
    ints = pa.list_(pa.int32())
    return [
        *(("shard", pa.int64()), ("bundle", pa.int32()), ("docs", pa.list_(pa.int64())), ("lengths", pa.binary())),
        *(("counts", ints), ("places", pa.binary()), ("sums", pa.binary())),
    ]


def _pass(docs: DataFrame, texts: list[str]) -> DataFrame:
    """text, rank, doc_id and score of the best documents of each text."""
    spark = docs.sparkSession
    counted = [Counter(terms_of(text)) for text in texts]
    numbers = {term: k for k, term in enumerate(sorted({t for c in counted for t in c}))}
    items = [{numbers[t]: n for t, n in c.items()} for c in counted]
    shards = checkpointed(_shards(docs, numbers))
    filled, total = shards.agg(F.coalesce(F.sum("filled"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
    # As many rows as the items of the pass have terms.
    each = shards.select(F.inline(F.arrays_zip("terms", "dfs"))).groupBy("terms").agg(F.sum("dfs").alias("df"))
    search = Search(items, {r["terms"]: r["df"] for r in each.collect()}, filled, total)

    dealt = checkpointed(_dealt(shards, search))
    none = F.lit(b"")
    bundles = F.explode(F.sequence(F.lit(0), F.lit(max(0, len(search.bundles) - 1)))).alias("bundle")
    carried = shards.select("shard", bundles, "docs", "lengths").withColumns(
        {"counts": F.expr("cast(array() as array<int>)"), "places": none, "sums": none}
    )
    for owner in range(OWNERS):
        owned = dealt.filter(F.col("owner") == owner).drop("owner")
        carried = (
            carried.groupBy("shard", "bundle")
            .cogroup(owned.groupBy("shard", "bundle"))
            .applyInArrow(_visit(owner, search), _LEFT if owner == OWNERS - 1 else _CARRIED)
        )
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = carried.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= BEST)
    named = spark.createDataFrame(list(enumerate(texts)), "item int, text string")
    return ranked.join(F.broadcast(named), "item").select("text", "rank", "doc_id", "score")


def ranked(docs: DataFrame, items: DataFrame) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the 10 best documents of every item.

    Scores above 0 only, highest first, equal ones by ascending doc_id, rows without one last. Rows of documents with
    equal ids count as documents of their own, rows of items likewise as items. An item whose text is NULL or has no
    term that occurs has no rows. Other columns are left out. Items whose texts exceed ``PASS_BYTES``
    together go through the documents in several passes.
    """
    wanted = items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).filter("text IS NOT NULL")
    texts = checkpointed(wanted.select("text").distinct())
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = max(1, -(-size // PASS_BYTES))
    found = None
    for number in range(passes):
        some = texts.filter(F.pmod(F.xxhash64("text"), F.lit(passes)) == number).orderBy("text").collect()
        here = _pass(docs, [row.text for row in some])
        found = here if found is None else found.union(here)
    return wanted.join(found, "text").select("item_id", "rank", "doc_id", "score")


def ranked_sql() -> str:
    """The rows of ``ranked`` over documents and benchmark."""
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    terms = f"regexp_extract_all({low}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"
    return f"""
    WITH d AS (SELECT row_number() OVER () AS k, doc_id, {terms} AS terms FROM documents WHERE text IS NOT NULL),
    sizes AS (SELECT k, doc_id, len(terms) AS n FROM d WHERE len(terms) > 0),
    corpus AS (SELECT count(*) AS filled, sum(n)::BIGINT AS total FROM sizes),
    tf AS (SELECT k, term, count(*) AS tf FROM (SELECT k, unnest(terms) AS term FROM d) GROUP BY ALL),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
    i AS (SELECT row_number() OVER () AS i, item_id, {terms} AS terms FROM benchmark WHERE text IS NOT NULL),
    it AS (SELECT i, item_id, term, count(*) AS c FROM (SELECT i, item_id, unnest(terms) AS term FROM i) GROUP BY ALL),
    weighted AS (
      SELECT i, item_id, term, c * floor(1000 * ln((2 * filled + 2) / (2 * df + 1)))::BIGINT AS w
      FROM it JOIN df USING (term), corpus),
    measured AS (SELECT k, doc_id, {FULL} - {SLOPE} + (({SLOPE} * n * filled) // total) AS m FROM sizes, corpus),
    scored AS (
      SELECT i, item_id, k, doc_id,
             sum(w * (({UNIT} * tf) // ({RISE} * tf + {FLATTEN} * m)))::BIGINT AS score
      FROM weighted JOIN tf USING (term) JOIN measured USING (k) GROUP BY ALL),
    placed AS (
      SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id ASC NULLS LAST)::INTEGER AS rank
      FROM scored WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= {BEST}
    """
