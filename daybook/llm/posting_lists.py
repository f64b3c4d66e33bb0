"""Approximate nearest neighbours with balanced posting lists.

Centroids are fitted on a bounded sample, in rounds that make large clusters less attractive. Every
vector goes to the list of its nearest centroid and, near a border, to a few more. A query walks a
graph of the centroids in memory and takes the lists whose centroid is at most ``ratio`` times as far as
the nearest one. The ratio is set on the sample, so that the lists taken hold ``RECALL`` of the true
neighbours there: little is searched where vectors form clusters, much where they don't.

Lists that lie near each other form a shard. A query meets a shard once, in chunks of bounded size on
both sides, and leaves its k nearest there. Distances are exact, in double precision.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.session import checkpointed

SAMPLE = 40_000  # vectors for the centroids, on the driver
MOST_LISTS = 4_096
PER_LIST = 64  # vectors of a list, as long as there are fewer lists than that
COPIES = 4  # lists of a vector at most
NEAR_BORDER = 1.1  # as far as the nearest centroid, for a further list
RECALL = 0.97
PROBED = 256  # sample vectors that set the ratio
LEAST_POSTINGS = 128  # in the lists a query takes
LINKS = 16  # of a centroid in the graph
PER_CHUNK = 16_384  # vectors or queries of a shard in one task

_HASH_RANGE = 1 << 30


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances between the rows of a and b, near enough to choose lists by."""
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T, 0)


def balanced_centroids(vectors: np.ndarray, lists: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """k-means where a cluster of more than its share costs extra distance."""
    rng = np.random.default_rng(seed)
    centroids = vectors[rng.choice(len(vectors), size=min(lists, len(vectors)), replace=False)].copy()
    share = len(vectors) / len(centroids)
    extra = np.zeros(len(centroids))
    for _ in range(rounds):
        nearest = np.concatenate(
            [(_squared(part, centroids) + extra).argmin(1) for part in _parts(vectors, len(centroids))]
        )
        sizes = np.bincount(nearest, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, vectors)
        filled = sizes > 0
        centroids[filled] = sums[filled] / sizes[filled][:, None]
        spread = ((vectors - centroids[nearest]) ** 2).sum(1).mean()
        extra = 0.2 * spread * np.maximum(sizes / share - 1, 0).clip(max=4)
    return np.unique(centroids, axis=0)


def _parts(vectors: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """Rows of vectors, so many at a time that a matrix of that width stays at 64 MB."""
    step = max(1, 8_000_000 // max(1, width))
    return (vectors[k : k + step] for k in range(0, len(vectors), step))


@dataclass(frozen=True)
class Index:
    centroids: np.ndarray
    links: np.ndarray  # a row of neighbours per centroid
    entries: np.ndarray  # where a walk begins
    shard: np.ndarray  # of each list
    ratio: float

    def lists_of(self, vectors: np.ndarray) -> Iterator[np.ndarray]:
        """Lists of each vector: the nearest centroid, and further ones near the border.

        A further one counts only if it is nearer to the vector than to the lists already chosen.
        """
        most = min(len(self.centroids), 4 * COPIES)
        for part in _parts(vectors, len(self.centroids)):
            far = _squared(part, self.centroids)
            near = np.argpartition(far, most - 1, axis=1)[:, :most]
            order = np.take_along_axis(near, np.take_along_axis(far, near, 1).argsort(axis=1, kind="stable"), 1)
            for row, places in zip(far, order):
                chosen = [places[0]]
                limit = row[places[0]] * NEAR_BORDER**2
                for place in places[1:]:
                    if len(chosen) == COPIES or row[place] > limit:
                        break
                    apart = ((self.centroids[chosen] - self.centroids[place]) ** 2).sum(1).min()
                    if row[place] < apart:
                        chosen.append(place)
                yield np.array(chosen)

    def walk(self, query: np.ndarray, ratio: float, least: int = 8) -> list[tuple[float, int]]:
        """(distance, list) of the centroids within ``ratio`` of the nearest, nearest first.

        Best-first over the graph: a centroid is followed while it is within the ratio or among the
        ``least`` nearest found so far.
        """
        seen = set(self.entries.tolist())
        far = np.sqrt(((self.centroids[self.entries] - query) ** 2).sum(1))
        open_ = list(zip(far.tolist(), self.entries.tolist()))
        heapq.heapify(open_)
        found = sorted(open_)
        nearest = found[0][0]
        best = sorted(far.tolist())[:least]
        while open_:
            distance, place = heapq.heappop(open_)
            if distance > nearest * ratio and len(best) >= least and distance > best[-1]:
                break
            new = [n for n in self.links[place].tolist() if n not in seen]
            if not new:
                continue
            seen.update(new)
            far = np.sqrt(((self.centroids[new] - query) ** 2).sum(1)).tolist()
            for d, n in zip(far, new):
                heapq.heappush(open_, (d, n))
                found.append((d, n))
                nearest = min(nearest, d)
            best = heapq.nsmallest(least, best + far)
        return sorted(found)

    def probes(self, query: np.ndarray, sizes: np.ndarray) -> list[int]:
        """Lists within the ratio, and as many more as hold ``LEAST_POSTINGS``."""
        lists, held = [], 0
        reached = self.walk(query, self.ratio)
        nearest = reached[0][0]
        for distance, place in reached:
            if distance > nearest * self.ratio and held >= LEAST_POSTINGS:
                break
            lists.append(place)
            held += sizes[place]
        if held < min(LEAST_POSTINGS, sizes.sum()):
            return list(range(len(self.centroids)))
        return lists


def fit(sample: np.ndarray, rows: int) -> Index:
    """An index for a table of ``rows`` vectors from a sample of them."""
    lists = max(1, min(MOST_LISTS, rows // PER_LIST, len(sample)))
    centroids = balanced_centroids(sample, lists)
    lists = len(centroids)
    rng = np.random.default_rng(9)
    near = []
    for part in _parts(centroids, lists):
        width = min(lists, LINKS + 1)
        near.append(np.argpartition(_squared(part, centroids), width - 1, axis=1)[:, :width])
    # A few links at random keep the graph in one piece.
    links = np.concatenate([np.concatenate(near), rng.integers(0, lists, (lists, 4))], axis=1)
    entries = rng.choice(lists, size=min(lists, 16), replace=False)
    shards = max(1, min(lists, -(-rows * 2 // PER_CHUNK)))
    middles = balanced_centroids(centroids, shards) if shards > 1 else centroids[:1]
    shard = _squared(centroids, middles).argmin(1)
    index = Index(centroids, links, entries, shard, 1.0)
    return Index(centroids, links, entries, shard, _ratio(index, sample))


def _ratio(index: Index, sample: np.ndarray, k: int = 10) -> float:
    """The least ratio that reaches ``RECALL`` of the true neighbours within the sample."""
    rng = np.random.default_rng(3)
    chosen = rng.choice(len(sample), size=min(PROBED, len(sample)), replace=False)
    lists = list(index.lists_of(sample))
    needed = []
    for place in chosen:
        far = ((sample - sample[place]) ** 2).sum(1)
        far[place] = np.inf
        to_lists = np.sqrt(((index.centroids - sample[place]) ** 2).sum(1))
        least = max(to_lists.min(), 1e-12)
        for neighbour in np.argsort(far, kind="stable")[: min(k, len(sample) - 1)]:
            needed.append(to_lists[lists[neighbour]].min() / least)
    return float(np.quantile(needed, RECALL)) + 1e-9 if needed else 1.0


def _usable(vector: Column, size: int) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (F.size(vector) == size) & finite & F.exists(vector, lambda x: x != 0)


def _stacked(column: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    """A matrix from a column of lists without NULLs."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def nearest(embeddings: DataFrame, queries: Column, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id and score: the k nearest found of each query row among all other rows.

    ``embeddings`` has vec_id and embedding, ``queries`` says which rows are queries. Nearness is
    Euclidean distance, ties go to the smaller vec_id. Vectors that are NULL, zero, hold NULL or
    non-finite components, or differ in length from the most common one, take no part, nor do rows without
    vec_id. Rows that share a vec_id count once, at their nearest. An empty table gives no rows.
    """
    out = "query_id long, rank int, vec_id long, score double"
    spark = embeddings.sparkSession
    rows = embeddings.select(F.col("vec_id").cast("long"), "embedding", queries.alias("is_query"))
    rows = rows.filter("vec_id IS NOT NULL AND embedding IS NOT NULL")
    lengths = rows.filter("size(embedding) > 0").groupBy(F.size("embedding").alias("size")).count()
    common = lengths.orderBy(F.desc("count"), "size").first()
    if common is None:
        return spark.createDataFrame([], out)
    size = common["size"]
    rows = rows.filter(_usable(F.col("embedding"), size))
    count = rows.count()
    if count == 0:
        return spark.createDataFrame([], out)

    place = F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(_HASH_RANGE))
    share = min(1.0, SAMPLE / count) * _HASH_RANGE
    sample = rows.filter(place < share) if count > SAMPLE else rows
    vectors = _stacked(sample.select("vec_id", "embedding").orderBy("vec_id").toArrow()["embedding"], size)
    index = fit(vectors if len(vectors) else np.zeros((1, size)), count)
    kind = embeddings.schema["embedding"].dataType.simpleString()

    def posted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per vector and shard, with its lists there."""
        for batch in batches:
            taken, shards, lists = [], [], []
            for row, places in enumerate(index.lists_of(_stacked(batch.column(1), size))):
                for shard in np.unique(index.shard[places]):
                    taken.append(row)
                    shards.append(int(shard))
                    lists.append(places[index.shard[places] == shard].tolist())
            yield _dealt(batch, taken, shards, lists)

    def _dealt(batch: pa.RecordBatch, taken: list, shards: list, lists: list) -> pa.RecordBatch:
        rows = batch.take(pa.array(taken, pa.int64()))
        columns = [rows.column(0), rows.column(1), pa.array(shards, pa.int32()), pa.array(lists, pa.list_(pa.int32()))]
        return pa.RecordBatch.from_arrays(columns, ["vec_id", "embedding", "shard", "lists"])

    dealt = f"vec_id long, embedding {kind}, shard int, lists array<int>"
    postings = rows.select("vec_id", "embedding").mapInArrow(posted, dealt)
    # A row per list, and per shard below: at most MOST_LISTS.
    held = np.zeros(len(index.centroids), np.int64)
    in_shard: dict[int, int] = {}
    counted = postings.select("shard", F.explode("lists").alias("list")).groupBy("shard", "list").count()
    for row in counted.collect():
        held[row["list"]] = row["count"]
        in_shard[row["shard"]] = in_shard.get(row["shard"], 0) + row["count"]

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per query and shard, with the lists it takes there."""
        for batch in batches:
            taken, shards, lists = [], [], []
            for row, query in enumerate(_stacked(batch.column(1), size)):
                places = np.array(index.probes(query, held))
                for shard in np.unique(index.shard[places]):
                    taken.append(row)
                    shards.append(int(shard))
                    lists.append(places[index.shard[places] == shard].tolist())
            yield _dealt(batch, taken, shards, lists)

    probes = checkpointed(rows.filter("is_query").select("vec_id", "embedding").mapInArrow(routed, dealt))
    asked = dict(probes.groupBy("shard").count().collect())
    parts = spark.createDataFrame(
        [(s, -(-n // PER_CHUNK), -(-asked.get(s, 1) // PER_CHUNK)) for s, n in in_shard.items()],
        "shard int, vector_parts int, query_parts int",
    )

    def split(side: DataFrame, own: str, other: str) -> DataFrame:
        """Rows dealt to one part of their own side and to every part of the other side."""
        side = side.join(F.broadcast(parts), "shard")
        # The map partition spreads copies of a row as well.
        salt = F.xxhash64("vec_id", F.spark_partition_id())
        side = side.withColumn(own, F.pmod(salt, F.col(f"{own}s")).cast("int"))
        side = side.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1)))
        return side.select("vec_id", "embedding", "lists", "shard", "vector_part", "query_part")

    def compare(found: pa.Table, asked: pa.Table) -> pa.Table:
        """The k nearest of each query in this part of the shard."""
        columns: list[list] = [[], [], []]
        if len(found) and len(asked):
            ids, vectors = found["vec_id"].to_numpy(), _stacked(found["embedding"], size)
            distinct = len(np.unique(ids)) == len(ids)
            lists = found["lists"].combine_chunks()
            member = np.repeat(np.arange(len(ids)), np.diff(lists.offsets.to_numpy()))
            in_list = lists.flatten().to_numpy()
            by_list = np.argsort(in_list, kind="stable")
            starts = np.searchsorted(in_list[by_list], np.arange(len(index.centroids) + 1))
            queries = zip(asked["vec_id"].to_pylist(), _stacked(asked["embedding"], size), asked["lists"].to_pylist())
            for query_id, query, places in queries:
                here = [member[by_list[starts[p] : starts[p + 1]]] for p in places]
                here = np.unique(np.concatenate(here))
                here = here[ids[here] != query_id]
                far = np.sqrt(((vectors[here] - query) ** 2).sum(axis=1))
                if distinct and len(here) > 4 * k:
                    # All that are as near as the k-th, so that ties stay.
                    enough = far <= np.partition(far, k - 1)[k - 1]
                    here, far = here[enough], far[enough]
                order = np.lexsort((ids[here], far))
                _, first = np.unique(ids[here][order], return_index=True)
                first = np.sort(first)[:k]
                columns[0] += [query_id] * len(first)
                columns[1] += ids[here][order][first].tolist()
                columns[2] += far[order][first].tolist()
        kinds = (pa.int64(), pa.int64(), pa.float64())
        names = ("query_id", "vec_id", "score")
        return pa.table({n: pa.array(c, t) for n, c, t in zip(names, columns, kinds)})

    keys = ["shard", "vector_part", "query_part"]
    # vector_part counts vector_parts, query_part counts query_parts.
    left = split(postings, "vector_part", "query_part").groupBy(*keys)
    right = split(probes, "query_part", "vector_part").groupBy(*keys)
    candidates = left.cogroup(right).applyInArrow(compare, "query_id long, vec_id long, score double")
    once = candidates.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    ranked = once.withColumn("rank", rank).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", "score")
