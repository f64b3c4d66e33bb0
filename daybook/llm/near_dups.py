"""Near-duplicate groups by circulant MinHash, banding and exact Jaccard verification.

A document is the set of its word shingles. Two permutations give the whole signature: the first
scatters the shingles over a ring of positions, the second ranks the positions, and coordinate k is
the least rank after k steps around the ring. Bands of the signature propose pairs, and only pairs
whose full sets reach the similarity become links.

Pairs of a band bucket are not listed in full. Equal sets are one node from the start. All nodes of a
bucket are first compared with one of them, the centre, and what is linked is merged. Only
nodes of a bucket that are still in different groups are compared further: as pairs where the bucket
is small, else block by block as matrices, where only links that join two groups leave a task.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.session import checkpointed

BANDS, ROWS = 24, 4  # a pair of similarity 0.8 is missed by all bands once in 300,000
RING = 1 << 20
BROADCAST_NODES = 500_000  # ids of 8 bytes
SMALL_BUCKET = 24  # nodes whose pairs are listed; larger buckets are compared in blocks
BLOCK = 512
VOCABULARY = 8192  # shingles that a block comparison takes at a time

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xFF51AFD7ED558CCD))


def _finish(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _MIX[2]
    return h ^ (h >> np.uint64(29))


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a whole text.

    A-Z count as a-z, words stand between ASCII white space. A text of fewer words than ``size`` is
    one shingle, a text without words has none.
    """
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(size, len(words))
    most = len(words) - size + 1
    run = hashed[:most] + np.uint64(size)
    for k in range(1, size):
        run = run * _MIX[0] + hashed[k : k + most]
    return np.unique(_finish(run))


class Circulant:
    """Signatures from two permutations of a ring, the second one circularly shifted."""

    def __init__(self, coordinates: int = BANDS * ROWS, seed: int = 11) -> None:
        rank = np.random.default_rng(seed).permutation(RING).astype(np.uint32)
        around = np.concatenate([rank, rank[:coordinates]])
        self.shifted = np.lib.stride_tricks.sliding_window_view(around, coordinates)
        self.down = np.uint64(64 - RING.bit_length() + 1)

    def __call__(self, found: np.ndarray) -> np.ndarray:
        places = ((found * _MIX[1]) >> self.down).astype(np.int64)
        least = [self.shifted[places[k : k + 2048]].min(axis=0) for k in range(0, len(places), 2048)]
        return reduce(np.minimum, least)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """A 64-bit key per band, different for equal values in different bands."""
    rows = signature.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * _MIX[1]
    for k in range(ROWS):
        key = _finish(key * _MIX[0] + rows[:, k])
    return key.view(np.int64)


def node_of(found: np.ndarray) -> int:
    """Id of a set. Equal sets have equal ids; different ones collide once in 10^19 pairs."""
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(found.tobytes())).view(np.int64)))


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, node and band keys of each row; node is NULL where the set is empty."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        circulant = Circulant()
        for batch in batches:
            sizes, nodes, keys = [], [], []
            for text in batch.column(2):
                found = shingles(text.as_py(), size)
                sizes.append(len(found))
                nodes.append(node_of(found) if len(found) else None)
                keys.append(band_keys(circulant(found)) if len(found) else None)
            columns = [
                batch.column(0),
                batch.column(1),
                pa.array(sizes, pa.int64()),
                pa.array(nodes, pa.int64()),
                pa.array(keys, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "n_shingles", "node", "bands"])

    texts = docs.select(F.col("doc_id").cast("long"), _text_hash(), F.col("text").cast("string"))
    return texts.mapInArrow(sign, "doc_id long, text_hash long, n_shingles long, node long, bands array<long>")


def _text_hash() -> Column:
    return F.xxhash64(F.col("text").cast("string")).alias("text_hash")


def _texts_of(docs: DataFrame, reps: DataFrame, pairs: DataFrame) -> DataFrame:
    """node and text of every node in pairs."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = checkpointed(reps.join(nodes, "node"))
    if wanted.count() <= BROADCAST_NODES:
        wanted = F.broadcast(wanted)
    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), F.col("text").cast("string"))
    return texts.join(wanted, "rep").select("node", "text")


def verified(docs: DataFrame, reps: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose full shingle sets have a similarity of ``percent`` or more.

    ``b`` is the side that repeats: its set is kept for the rows that follow.
    """
    texts = _texts_of(docs, reps, pairs)
    both = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: OrderedDict[int, np.ndarray] = OrderedDict()

        def set_of(node: int, text: pa.StringScalar) -> np.ndarray | None:
            """None for a text of another row that shares the id of the row meant."""
            if node not in held:
                found = shingles(text.as_py(), size)
                if node_of(found) != node:
                    return None
                held[node] = found
                if len(held) > 64:
                    held.popitem(last=False)
            return held[node]

        for batch in batches:
            out: tuple[list, list] = ([], [])
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3))
            for a, b, text_a, text_b in rows:
                right = set_of(b, text_b)
                left = None if right is None else shingles(text_a.as_py(), size)
                if left is None or node_of(left) != a:
                    continue
                if min(len(left), len(right)) * 100 < percent * max(len(left), len(right)):
                    continue
                shared = len(np.intersect1d(left, right, assume_unique=True))
                if 100 * shared >= percent * (len(left) + len(right) - shared):
                    out[0].append(a)
                    out[1].append(b)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["a", "b"])

    return both.select("a", "b", "text_a", "text_b").mapInArrow(compare, "a long, b long")


def _larger_first(a: Column, b: Column) -> list[Column]:
    return [F.greatest(a, b).alias("a"), F.least(a, b).alias("b")]


def components(links: DataFrame) -> DataFrame:
    """node and label, the least node it is connected with, for every node of links (a, b).

    Large stars and small stars in turn: every step keeps at most as many links as there were, and no
    step gathers the neighbours of a node in one place.
    """
    larger, smaller = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    stars = checkpointed(links.filter("a <> b").select(larger, smaller).distinct())
    before = None
    while True:
        both = stars.union(stars.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        stars = checkpointed(small.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).filter("u <> v").distinct())
        now = stars.agg(F.count(F.lit(1)), F.expr("sum(cast(xxhash64(u, v) as decimal(38, 0)))")).first()
        if now == before:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
                stars.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
            )
        before = now


def _joining(sets: list[np.ndarray], groups: list[int], blocks: list[int], percent: int) -> list[tuple[int, int]]:
    """Pairs of places whose sets are similar, one for each two groups that they join.

    Within one block all places are compared, of two blocks each place of one with each of the other.
    """
    left = [k for k, block in enumerate(blocks) if block == min(blocks)]
    right = [k for k, block in enumerate(blocks) if block == max(blocks)]
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    words, place, times = np.unique(every, return_inverse=True, return_counts=True)
    common = np.full(len(words), -1)
    common[times > 1] = np.arange((times > 1).sum())
    column = common[place]
    shared = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, int((times > 1).sum()), VOCABULARY):
        here = (column >= start) & (column < start + VOCABULARY)
        has = np.zeros((len(sets), VOCABULARY), np.float32)
        has[owner[here], column[here] - start] = 1
        shared += has[left] @ has[right].T
    sizes, group = np.array([len(s) for s in sets]), np.array(groups)
    both = sizes[left][:, None] + sizes[right][None, :]
    similar = 100 * shared.astype(np.int64) >= percent * (both - shared.astype(np.int64))
    similar &= group[left][:, None] != group[right][None, :]
    rows, columns = np.nonzero(similar)
    # One pair for each two groups is enough, and of those only the ones that join anything.
    ends = np.stack([group[left][rows], group[right][columns]], axis=1)
    _, first = np.unique(ends, axis=0, return_index=True)
    parent: dict[int, int] = {}

    def root(g: int) -> int:
        while parent.get(g, g) != g:
            g = parent[g]
        return g

    kept = []
    for k in first:
        a, b = left[rows[k]], right[columns[k]]
        one, other = root(groups[a]), root(groups[b])
        if one != other:
            parent[max(one, other)] = min(one, other)
            kept.append((a, b))
    return kept


def _joined_by_blocks(
    docs: DataFrame, reps: DataFrame, members: DataFrame, size: int, percent: int
) -> DataFrame:
    """Links (a, b) between nodes of different labels in the same bucket.

    ``members`` has key, node, label and n, the nodes of the bucket. A node goes to as many tasks as its
    bucket has blocks of ``BLOCK`` nodes, and no task sees more than two blocks.
    """
    texts = _texts_of(docs, reps, members.select(F.col("node").alias("a"), F.col("node").alias("b")))
    count = F.ceil(F.col("n") / BLOCK).cast("int")
    blocks = members.withColumn("block", F.pmod(F.xxhash64("node"), count).cast("int"))
    blocks = blocks.withColumn("other", F.explode(F.sequence(F.lit(0), count - 1)))
    low, high = F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    dealt = blocks.select("key", low, high, "block", "node", "label").join(texts, "node")

    def compare(rows: pa.Table) -> pa.Table:
        nodes, groups, blocks, sets = [], [], [], []
        seen: set[int] = set()
        columns = [rows[c].to_pylist() for c in ("node", "label", "block")]
        for node, label, block, text in zip(*columns, rows["text"]):
            found = shingles(text.as_py(), size)
            if node not in seen and node_of(found) == node:
                seen.add(node)
                nodes.append(node)
                groups.append(label)
                blocks.append(block)
                sets.append(found)
        pairs = _joining(sets, groups, blocks, percent) if len(sets) > 1 else []
        ends = [[nodes[pair[side]] for pair in pairs] for side in (0, 1)]
        return pa.table({name: pa.array(end, pa.int64()) for name, end in zip("ab", ends)})

    return (
        dealt.select("key", "low", "high", "block", "node", "label", "text")
        .groupBy("key", "low", "high")
        .applyInArrow(compare, "a long, b long")
    )


def _nodes(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The signed rows of docs, and node, rep (the least doc_id that has it) and label of each node."""
    signed = checkpointed(signatures(docs, size))
    named = signed.filter("node IS NOT NULL AND doc_id IS NOT NULL")
    reps = named.groupBy("node").agg(F.min("doc_id").alias("rep"))
    rows = named.select("node", F.explode("bands").alias("key"))
    ends = rows.groupBy("key").agg(F.min("node").alias("centre"), F.max("node").alias("other"))
    centres = ends.filter("centre < other").select("key", "centre")
    shared = checkpointed(rows.join(centres, "key").distinct())

    stars = checkpointed(
        shared.filter("node <> centre").select(F.col("node").alias("a"), F.col("centre").alias("b")).distinct()
    )
    links = checkpointed(verified(docs, reps, stars, size, percent))
    labels = components(links)

    spread = shared.join(labels, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label"))
    spread = checkpointed(spread)
    still = spread.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("label").alias("low"), F.max("label").alias("high")
    )
    open_rows = checkpointed(spread.join(still.filter("low < high").select("key", "n"), "key"))

    small = open_rows.filter(F.col("n") <= SMALL_BUCKET).select("key", "node", "label")
    other = small.select("key", F.col("node").alias("node_2"), F.col("label").alias("label_2"))
    pairs = small.join(other, "key").filter("label < label_2")
    pairs = pairs.select(*_larger_first(F.col("node"), F.col("node_2"))).distinct()
    pairs = checkpointed(pairs.join(stars, ["a", "b"], "left_anti"))
    more = verified(docs, reps, pairs, size, percent)
    large = open_rows.filter(F.col("n") > SMALL_BUCKET)
    if not large.isEmpty():
        more = more.union(_joined_by_blocks(docs, reps, large, size, percent))
    ends = labels.select(F.col("node").alias("a"), F.col("label").alias("b"))
    labels = components(ends.union(more))

    own = reps.join(labels, "node", "left").select("node", "rep", F.coalesce("label", "node").alias("label"))
    return signed, own


def grouped(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of docs.

    Documents are linked when their sets of ``size``-word shingles have a Jaccard similarity of
    ``percent`` or more. ``component_id`` is the least doc_id that can be reached, ``kept`` whether it is
    the row's own. A NULL, empty or wordless text is linked with nothing. A row without doc_id is
    linked with nothing and kept, its component_id is NULL. Rows with the same text and doc_id give equal
    rows. Columns other than doc_id and text are left out; an empty table gives no rows.
    """
    signed, own = _nodes(docs, size, percent)
    least = own.groupBy("label").agg(F.min("rep").alias("component"))
    component = own.join(least, "label").select("node", "component")
    result = signed.select("doc_id", "n_shingles", "node").join(component, "node", "left")
    component_id = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return result.select(
        "doc_id",
        "n_shingles",
        component_id.alias("component_id"),
        F.coalesce(component_id == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def without_near_dups(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs, all columns as they are, that are kept: one document of each group.

    It is the one with the least doc_id. A doc_id that several rows share says nothing about their texts: each
    row is judged by its own text, and of rows with the same doc_id and the same words one stays. Rows without
    doc_id or without words stay.
    """
    signed, own = _nodes(docs, size, percent)
    own = checkpointed(own)
    first = own.groupBy("label").agg(F.min(F.struct("rep", "node")).alias("first")).select("first.rep", "first.node")
    first = first.select(F.col("rep").alias("doc_id"), "node", F.lit(True).alias("first"))
    texts = signed.filter("doc_id IS NOT NULL AND node IS NOT NULL").groupBy("doc_id", "node", "text_hash")
    texts = texts.agg(F.count(F.lit(1)).alias("n")).join(first, ["doc_id", "node"], "left")
    # Of texts that differ in white space or case only, the one with the least hash.
    chosen = texts.filter("first").groupBy("doc_id", "node").agg(F.min("text_hash").alias("chosen"))
    texts = texts.join(chosen, ["doc_id", "node"], "left")
    stays = F.coalesce(F.col("text_hash") == F.col("chosen"), F.lit(False))
    texts = checkpointed(texts.select("doc_id", "text_hash", "n", stays.alias("stays")).filter("NOT stays OR n > 1"))
    gone = texts.filter("NOT stays").select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
    repeated = texts.filter("stays").select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
    if texts.count() <= BROADCAST_NODES:
        gone, repeated = F.broadcast(gone), F.broadcast(repeated)
    same = (F.col("doc_id").cast("long") == F.col("__id")) & (_text_hash() == F.col("__hash"))
    left = docs.join(gone, same, "left_anti")
    if repeated.isEmpty():
        return left
    one = left.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return left.join(repeated, same, "left_anti").unionByName(one)
