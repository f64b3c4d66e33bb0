"""Quality of documents by hierarchical empirical Bayes over hosts and paths.

A logistic classifier over the shape of a text gives the evidence of the document itself. The mean
quality of all documents is the prior of a host, the posterior of the host is the prior of its
paths, and the posterior of a path is the prior of its documents. How strongly a sparse site is pulled
to its prior follows from how much sites differ. Sites are summed up by grouped aggregation, in which
a document never counts towards its own prior.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.session import checkpointed

TRAIN_LABELS = 10_000  # labelled documents that the classifier is fitted on
KEEP = 0.5  # least quality of a document that is kept
LEAST_PULL, MOST_PULL = 2.0, 1000.0  # documents that a prior counts for

_HASH_RANGE = 1 << 30
_KINDS = 8
_KIND = np.full(256, 7, np.uint8)  # other control characters
_KIND[[9, 10, 11, 12, 13, 32]] = 0
_KIND[48:58] = 1
_KIND[65:91] = 2
_KIND[97:123] = 3
_KIND[128:] = 4
_KIND[[ord(c) for c in ".,;:'\"?()-"]] = 5
_KIND[[ord(c) for c in "!#$%&*+/<=>@[\\]^_`{|}~"]] = 6


def shape(text: str | None) -> np.ndarray:
    """Shares of kinds of characters, of repeated words and lines, and lengths, of a whole text."""
    text = text or ""
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    kinds = np.bincount(_KIND[raw], minlength=_KINDS) / max(1, len(raw))
    letters = kinds[2] + kinds[3] + kinds[4]
    words = text.split()
    n = max(1, len(words))
    repeated = sum(a == b for a, b in zip(words, words[1:])) / n
    lines = text.split("\n")
    return np.array(
        [
            kinds[1],
            kinds[2] / max(1e-9, letters),
            kinds[6],
            np.sqrt(kinds[6]),
            kinds[5],
            kinds[7],
            letters,
            repeated,
            np.sqrt(repeated),
            len(set(words)) / n**0.9,
            1 - len(set(lines)) / len(lines),
            min(30.0, sum(map(len, words)) / n) / 10,
            np.log1p(len(words)) / 10,
            float(not words),
        ]
    )


@dataclass(frozen=True)
class Classifier:
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    intercept: float  # of the training share; evidence leaves it out

    def evidence(self, text: str | None) -> float:
        """Log odds for good quality that the text adds to any prior, within -20 and 20."""
        return float(np.clip((shape(text) - self.centre) / self.scale @ self.weights, -20, 20))


def _logit(p: np.ndarray | float) -> np.ndarray | float:
    return np.log(p / (1 - p))


def fit(shapes: np.ndarray, good: np.ndarray, penalty: float = 1.0, rounds: int = 30) -> Classifier:
    """Penalised logistic regression by Newton steps; without both classes there is no evidence."""
    width = shapes.shape[1] if len(shapes) else len(shape(""))
    if len(set(good.tolist())) < 2:
        return Classifier(np.zeros(width), np.ones(width), np.zeros(width), 0.0)
    centre, scale = shapes.mean(axis=0), shapes.std(axis=0) + 1e-6
    x = np.column_stack([(shapes - centre) / scale, np.ones(len(shapes))])
    w = np.zeros(width + 1)
    ridge = np.diag([penalty] * width + [1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (good - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    # Evidence is relative to the share of good documents that the classifier was fitted on.
    offset = w[-1] - _logit(np.clip(good.mean(), 1e-6, 1 - 1e-6))
    centre = centre - scale * (offset * w[:-1] / max(1e-12, (w[:-1] ** 2).sum()))
    return Classifier(centre, scale, w[:-1], float(w[-1]))


def _training(docs: DataFrame, labels: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Shapes and labels of at most about ``most`` labelled documents, chosen by a hash of their id."""
    labels = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
    labels = labels.groupBy(F.col("doc_id").alias("__id")).agg(F.max("quality").alias("__good"))
    count = labels.count()
    share = min(1.0, most / max(1, count)) * _HASH_RANGE
    chosen = labels.filter(F.pmod(F.xxhash64("__id"), F.lit(_HASH_RANGE)) < share)

    def shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shape(text.as_py()).tolist() for text in batch.column(1)]
            columns = [batch.column(0), pa.array(found, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["good", "shape"])

    # ``chosen`` has about ``most`` rows of two numbers whatever the size of the table.
    texts = docs.join(F.broadcast(chosen), docs["doc_id"] == F.col("__id"))
    texts = texts.select(F.col("__good").cast("int").alias("good"), F.col("text").cast("string"))
    found = texts.mapInArrow(shapes, "good int, shape array<double>").toArrow()
    width = len(shape(""))
    matrix = found["shape"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    return matrix, found["good"].to_numpy().astype(np.float64)


def _pull(sites: DataFrame) -> float:
    """Documents that a prior counts for, by the method of moments over sites (n, total).

    Sites that differ by no more than chance pull with all they can, sites that differ much with little.
    """
    told = sites.filter("n >= 2").agg(
        F.sum("n").alias("n"),
        F.sum("total").alias("total"),
        F.count(F.lit(1)).alias("sites"),
        F.sum(F.col("total") * F.col("total") / F.col("n")).alias("squares"),
        F.sum(F.col("n") * F.col("n")).alias("n_squares"),
    ).first()
    if not told["sites"] or told["sites"] < 2:
        return MOST_PULL
    n, mean = float(told["n"]), told["total"] / told["n"]
    between = told["squares"] - n * mean * mean
    within = mean * (1 - mean)
    effective = n - float(told["n_squares"]) / n
    variance = (between - (told["sites"] - 1) * within) / max(effective, 1e-9)
    if variance <= 0 or within <= 0:
        return MOST_PULL
    return float(np.clip(within / variance - 1, LEAST_PULL, MOST_PULL))


def rated(
    docs: DataFrame, labels: DataFrame, host: Column, path: Column, train_labels: int = TRAIN_LABELS
) -> DataFrame:
    """doc_id, evidence, host_quality, path_quality, quality and kept for every row of docs.

    ``labels`` has doc_id and quality (0 or 1). A NULL host or path is a site of its own. ``host_quality``
    and ``path_quality`` are posteriors from all other documents of the site. NULL and empty texts are
    rated by their shape like any other; without labels of both classes nothing is evidence. Rows
    with equal ids are rows of their own; an empty table gives no rows; other columns are left out.
    """
    classifier = fit(*_training(docs.select("doc_id", "text"), labels, train_labels))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([classifier.evidence(text.as_py()) for text in batch.column(3)], pa.float64())
            columns = [*batch.columns[:3], found]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "host", "path", "evidence"])

    def named(site: Column) -> Column:
        return F.coalesce(F.concat(F.lit("="), site.cast("string")), F.lit(""))

    rows = docs.select(
        F.col("doc_id").cast("long"), named(host).alias("host"), named(path).alias("path"), F.col("text").cast("string")
    )
    weighed = checkpointed(rows.mapInArrow(weigh, "doc_id long, host string, path string, evidence double"))

    base = _share_good(labels)
    own = 1 / (1 + F.exp(-(F.col("evidence") + float(_logit(base)))))
    weighed = weighed.withColumn("own", own)
    sums = [F.count(F.lit(1)).alias("n"), F.sum("own").alias("total")]
    paths = checkpointed(weighed.groupBy("host", "path").agg(*sums))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    told = hosts.agg(F.sum("total") / F.sum("n")).first()[0]
    mean = float(np.clip(told if told is not None else base, 1e-4, 1 - 1e-4))
    host_pull, path_pull = _pull(hosts), _pull(paths)

    hosts = hosts.select("host", F.col("n").alias("host_n"), F.col("total").alias("host_total"))
    sites = paths.join(hosts, "host")
    joined = weighed.join(sites, ["host", "path"])
    host_quality = (F.col("host_total") - F.col("own") + host_pull * mean) / (F.col("host_n") - 1 + host_pull)
    joined = joined.withColumn("host_quality", host_quality)
    path_quality = (F.col("total") - F.col("own") + path_pull * F.col("host_quality")) / (F.col("n") - 1 + path_pull)
    joined = joined.withColumn("path_quality", path_quality)
    prior = F.log(F.col("path_quality") / (1 - F.col("path_quality")))
    quality = 1 / (1 + F.exp(-(F.col("evidence") + prior)))
    return joined.select(
        "doc_id", "evidence", "host_quality", "path_quality", quality.alias("quality"), (quality >= KEEP).alias("kept")
    )


def _share_good(labels: DataFrame) -> float:
    share = labels.agg(F.avg(F.col("quality").cast("double"))).first()[0]
    return float(np.clip(0.5 if share is None else share, 1e-4, 1 - 1e-4))
