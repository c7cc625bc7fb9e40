"""Quality classifier: hashed word n-gram logistic regression, trained by FTRL.

A document's features are its word n-grams (1 to ``n`` words, whole text),
hashed into 2**bits places; a place's value is log(1 + occurrences), and a
document's values have length one. A word is a run of bytes other than space
and \\x09-\\x0D, in its own case. The score is the logistic function of a sparse
dot product of these values with the weights, plus a bias.

Weights come from follow-the-regularised-leader updates (per-coordinate rates,
L1 and L2): every training document in turn moves the sums z and n of its own
places, and a weight is read off them when it is needed, so it is zero while
|z| is at most the L1 strength. Targets are labels of 0 and 1; of several
labels of a document the mean counts.

The classifier is fitted on a bounded sample: the ``sample`` labelled
documents whose ids have the least hashes, each seen ``epochs`` times in that order,
streamed through one task (2**bits sums are its memory). Their features are
made by all tasks. Weights (2**bits numbers, bounded) go to the tasks that
score; scoring reads every text once, without a shuffle.

Cases. A null or empty text, or one of blanks only, has no features and
gets the bias's score. Labels with a null doc_id or quality teach nothing; without
any label every score is 0.5. A null doc_id is in no fold (held_out false) and can't match a label.
Repeated rows of documents are scored each, and each teaches if its id is in the sample.
An empty table gives no rows. Very long texts are slices of their own. Columns
that clash with the added ones are replaced; others are carried along.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from augur.llm.scratch import stored
from augur.llm.words import find_words, gram_hashes, mix, slices

BITS, GRAMS = 18, 2
SAMPLE, EPOCHS = 8192, 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.05, 0.1
THRESHOLD = 0.7
FOLDS, HELD_OUT = 4, 2  # the contract's fold: crc32(doc_id as text) mod 4 is 2
ADDED = ("score", "predicted")


# -- features -----------------------------------------------------------------


def features(texts: pa.Array, n: int = GRAMS, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row bounds, places, values) of the texts: row r has the places and
    values bounds[r]:bounds[r + 1], places rising, values of length one."""
    words = find_words(texts)
    rows = len(words.row) - 1
    hashes = words.hashes()
    of = np.repeat(np.arange(rows, dtype=np.uint64), np.diff(words.row))
    at, last = np.arange(len(hashes)), words.last
    keys = []
    for size in range(1, n + 1):
        whole = at + size <= last
        places = mix(gram_hashes(hashes, size)[whole] + np.uint64(size)) >> np.uint64(64 - bits)
        keys.append(of[whole] << np.uint64(bits) | places)
    found, counts = np.unique(np.concatenate(keys), return_counts=True)
    row = (found >> np.uint64(bits)).astype(np.int64)
    # by the distinct counts: vector code may round a number differently from place to place
    distinct, at_count = np.unique(counts, return_inverse=True)
    values = np.array([math.log1p(c) for c in distinct.tolist()] or [0.0])[at_count] if len(counts) else counts.astype(np.float64)
    length = np.sqrt(np.bincount(row, weights=values * values, minlength=rows))
    values = values / length[row] if len(row) else values
    bounds = np.searchsorted(row, np.arange(rows + 1))
    return bounds, (found & np.uint64((1 << bits) - 1)).astype(np.int32), values.astype(np.float32)


def _features(n: int, bits: int):
    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            bounds, places, values = features(part.column("text"), n, bits)
            bounds = pa.array(bounds.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("target"),
                    pa.ListArray.from_arrays(bounds, pa.array(places)),
                    pa.ListArray.from_arrays(bounds, pa.array(values)),
                ],
                names=["doc_id", "target", "places", "parts"],
            )

    return scan


# -- training -----------------------------------------------------------------


@dataclass
class Leader:
    """Sums of the regularised leader; the last place is the bias, which has
    no L1 penalty."""

    size: int
    alpha: float = ALPHA
    beta: float = BETA
    l1: float = L1
    l2: float = L2

    def __post_init__(self):
        self.z = np.zeros(self.size + 1)
        self.n = np.zeros(self.size + 1)

    def weights(self, at) -> np.ndarray:
        z = self.z[at]
        l1 = np.where(np.asarray(at) == self.size, 0.0, self.l1)
        rate = (self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / rate)

    def learn(self, places: np.ndarray, values: np.ndarray, target: float) -> None:
        """One update; ``places`` has each place once and the bias last."""
        w = self.weights(places)
        g = (logistic(float(w @ values)) - target) * values
        n = self.n[places]
        grown = n + g * g
        self.z[places] += g - (np.sqrt(grown) - np.sqrt(n)) / self.alpha * w
        self.n[places] = grown


def logistic(x: float) -> float:
    return 0.5 * (1 + math.tanh(0.5 * x))


def _train(size: int, alpha: float, beta: float, l1: float, l2: float):
    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader = Leader(size, alpha, beta, l1, l2)
        for batch in batches:
            targets = batch.column("target").to_numpy()
            places, parts = batch.column("places"), batch.column("parts")
            for r, target in enumerate(targets.tolist()):
                at = np.append(places[r].values.to_numpy(), size)
                leader.learn(at, np.append(parts[r].values.to_numpy(), 1.0), target)
        weights = leader.weights(np.arange(size + 1))
        used = np.flatnonzero(weights)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(weights[used])], names=["place", "weight"])

    return scan


def fit(
    docs: DataFrame,
    labels: DataFrame,
    n: int = GRAMS,
    bits: int = BITS,
    sample: int = SAMPLE,
    epochs: int = EPOCHS,
    alpha: float = ALPHA,
    beta: float = BETA,
    l1: float = L1,
    l2: float = L2,
) -> np.ndarray:
    """Weights by place, the bias last. ``docs`` has doc_id and text,
    ``labels`` doc_id and quality; both are filtered to training rows before."""
    chosen = (
        labels.filter("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg(F.avg("quality").cast("double").alias("target"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = stored(
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")  # at most `sample` rows of two numbers
        .mapInArrow(_features(n, bits), f"doc_id {id_type}, target double, places array<int>, parts array<float>"),
        "quality_features",
    )
    turns = rows.withColumn("turn", F.explode(F.sequence(F.lit(1), F.lit(epochs))))
    # the bounded sample goes through one task, in the order of the turns
    streamed = turns.repartition(1).sortWithinPartitions("turn", F.xxhash64("doc_id"), "doc_id", "places", "parts")
    learned = streamed.select("target", "places", "parts").mapInArrow(
        _train(1 << bits, alpha, beta, l1, l2), "place long, weight double"
    )
    weights = np.zeros((1 << bits) + 1)
    for r in learned.collect():  # 2**bits + 1 rows at most
        weights[r["place"]] = r["weight"]
    return weights


# -- scoring ------------------------------------------------------------------


def _score(weights: np.ndarray, n: int, threshold: float):
    bits = (len(weights) - 1).bit_length() - 1

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            bounds, places, values = features(part.column("text"), n, bits)
            products = np.append(weights[places] * values, 0.0)  # the last stands for rows without features
            dots = np.where(np.diff(bounds) > 0, np.add.reduceat(products, bounds[:-1]), 0.0)
            score = np.array([logistic(d) for d in (dots + weights[-1]).tolist()])
            carried = [c for c in part.schema.names if c not in ADDED]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in carried), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                names=[*carried, *ADDED],
            )

    return scan


def score_quality(docs: DataFrame, weights: np.ndarray, n: int = GRAMS, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (1 from ``threshold`` on)."""
    rest = docs.select([c for c in docs.columns if c not in ADDED])
    fields = ", ".join(f"`{c}` {rest.schema[c].dataType.simpleString()}" for c in rest.columns)
    return rest.mapInArrow(_score(weights, n, threshold), f"{fields}, score double, predicted int")


def held_out(doc_id: str = "doc_id", folds: int = FOLDS, fold: int = HELD_OUT) -> Column:
    rest = F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds
    return F.coalesce(rest == fold, F.lit(False))


def op12_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """Contract query over whole ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    weights = fit(docs, labels.filter(~held_out()))
    scored = score_quality(docs.withColumn("held_out", held_out()), weights)
    return scored.select("doc_id", "held_out", "score", "predicted")
