"""Toxicity of documents by a factorization machine over hashed terms.

A document is the set of its hashed terms: words, and how longer words begin, so
that inflected forms are met. The machine adds a weight per word
and, through a short vector per word, a term for each pair of words, so that a
pair such as an insult with the mention of a group can count for more than its
words. It is fitted on a bounded sample of labelled documents; every whole text
is then scored where it is.

Defined results: a null text has no words, like an empty one; both get the
score of a document without words. Labels that are null, and labels whose id
has no document, teach nothing. Without labels of both kinds every score is 0.
Repeated rows get equal results, and a repeated label counts as often as it is
there. An empty table gives no rows. Columns other than the id, the text and the
label are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.words import ALNUM, byte_texts, chunks

BUCKETS = 1 << 20
STEM_BYTES = 4


@dataclass(frozen=True)
class Machine:
    """Bias, and weight and vector of each bucket that was learned."""

    bias: float
    buckets: np.ndarray
    weights: np.ndarray
    vectors: np.ndarray

    def scores(self, documents: list[np.ndarray]) -> np.ndarray:
        """Probabilities of documents given as arrays of distinct buckets."""
        counts = np.array([len(d) for d in documents])
        place = np.searchsorted(self.buckets, np.concatenate([*documents, np.empty(0, np.int64)]))
        place = np.minimum(place, len(self.buckets) - 1)
        known = self.buckets[place] == np.concatenate([*documents, np.empty(0, np.int64)])
        rows = np.repeat(np.arange(len(documents)), counts)[known]
        return _sigmoid(
            self.bias + _pooled(rows, place[known], len(documents), self.weights, self.vectors)[0]
        )


def terms(text: bytes) -> np.ndarray:
    """Sorted distinct buckets of the terms of a text in UTF-8."""
    found = set(ALNUM.findall(text.lower()))
    found.update([word[:STEM_BYTES] + b"-" for word in found if len(word) > STEM_BYTES])
    return np.unique(np.fromiter(map(crc32, found), np.int64, len(found)) % BUCKETS)


def learn(
    docs: DataFrame, labels: DataFrame, per_class: int = 5000, rank: int = 4, rounds: int = 12
) -> Machine | None:
    """Fit on at most ``per_class`` labelled documents of each class, chosen by a hash of the id."""
    known = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").select(
        F.col("doc_id").alias("label_id"), F.col("toxic").cast("int").alias("toxic")
    )
    counts = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return None
    order = F.xxhash64("label_id")
    chosen = [known.where(F.col("toxic") == c).orderBy(order, "label_id").limit(per_class) for c in (0, 1)]
    sample = F.broadcast(chosen[0].union(chosen[1]))  # at most twice ``per_class`` rows
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = (
        texts.join(sample, F.col("doc_id") == F.col("label_id"))
        .select("doc_id", "text", "toxic")
        .mapInArrow(_featurise, "doc_id long, toxic int, terms array<int>")
        .toPandas()
        .sort_values("doc_id", kind="stable")
    )
    if rows["toxic"].nunique() < 2:
        return None
    documents = [np.asarray(t, np.int64) for t in rows["terms"]]
    toxic = rows["toxic"].to_numpy(np.float64)
    # The sample may hold other shares of the classes than the labels; rows are weighed back.
    share = {c: counts[c] / (toxic == c).sum() for c in (0, 1)}
    weight = np.where(toxic == 1, share[1], share[0])
    return fit(documents, toxic, weight / weight.mean(), rank, rounds)


def fit(
    documents: list[np.ndarray],
    toxic: np.ndarray,
    importance: np.ndarray,
    rank: int,
    rounds: int,
    rate: float = 0.1,
    decay: float = 1e-3,
) -> Machine:
    """Adaptive gradient steps over batches, for the buckets that tell the classes apart."""
    buckets = _telling(documents, toxic)
    rng = np.random.default_rng(5)
    weights = np.zeros(len(buckets))
    vectors = rng.normal(0, 0.02, (len(buckets), rank))
    weight_squares, vector_squares = np.full(len(buckets), 1e-2), np.full(vectors.shape, 1e-2)
    base = float(np.clip((toxic * importance).sum() / importance.sum(), 1e-3, 1 - 1e-3))
    bias = float(np.log(base / (1 - base)))
    for _ in range(rounds):
        order = rng.permutation(len(documents))
        for start in range(0, len(order), 128):
            batch = order[start : start + 128]
            own = [documents[i] for i in batch]
            place = np.searchsorted(buckets, np.concatenate(own))
            place = np.minimum(place, len(buckets) - 1)
            hit = buckets[place] == np.concatenate(own)
            rows = np.repeat(np.arange(len(batch)), [len(d) for d in own])[hit]
            place = place[hit]
            scores, sums = _pooled(rows, place, len(batch), weights, vectors)
            error = (_sigmoid(bias + scores) - toxic[batch]) * importance[batch]
            used, inverse = np.unique(place, return_inverse=True)
            by_weight = np.bincount(inverse, error[rows], len(used)) + decay * weights[used]
            pulls = error[rows, None] * (sums[rows] - vectors[place])
            by_vector = np.stack([np.bincount(inverse, pulls[:, f], len(used)) for f in range(rank)], axis=1)
            by_vector += decay * vectors[used]
            weight_squares[used] += by_weight**2
            vector_squares[used] += by_vector**2
            weights[used] -= rate * by_weight / np.sqrt(weight_squares[used])
            vectors[used] -= 0.2 * rate * by_vector / np.sqrt(vector_squares[used])
            bias -= 0.01 * error.mean()
    return Machine(bias, buckets, weights, vectors)


def _telling(documents: list[np.ndarray], toxic: np.ndarray, least: float = 3.0) -> np.ndarray:
    """Buckets whose documents are of one class ``least`` standard deviations more than chance."""
    every, inverse = np.unique(np.concatenate(documents), return_inverse=True)
    counts = np.bincount(inverse, minlength=len(every))
    in_toxic = np.bincount(inverse, np.repeat(toxic, [len(d) for d in documents]), len(every))
    share = toxic.mean()
    deviation = np.abs(in_toxic - counts * share) / np.sqrt(counts * share * (1 - share) + 1)
    chosen = every[deviation >= least]
    return chosen if len(chosen) else np.zeros(1, np.int64)


def _pooled(
    rows: np.ndarray, place: np.ndarray, count: int, weights: np.ndarray, vectors: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Sum of weights and of all pairs' products per row, and the rows' sums of vectors.

    The sum over pairs is half of the squared sum less the sum of squares.
    """
    linear = np.bincount(rows, weights[place], count)
    own = vectors[place]
    sums = np.stack([np.bincount(rows, own[:, f], count) for f in range(own.shape[1])], axis=1)
    squares = np.bincount(rows, (own**2).sum(axis=1), count)
    return linear + 0.5 * ((sums**2).sum(axis=1) - squares), sums


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (piece for whole in batches for piece in chunks([whole], "text")):
        own = [terms(text).astype(np.int32) for text in byte_texts(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("toxic"), pa.array(own, pa.list_(pa.int32()))],
            names=["doc_id", "toxic", "terms"],
        )


def score(docs: DataFrame, machine: Machine | None) -> DataFrame:
    """``doc_id, score`` of every row, from its text alone."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(_score(machine), f"doc_id {kind}, score double")


def _score(machine: Machine | None):
    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for whole in batches for piece in chunks([whole], "text")):
            texts = byte_texts(batch.column("text"))
            scores = machine.scores([terms(t) for t in texts]) if machine else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores)], names=["doc_id", "score"]
            )

    return rate
