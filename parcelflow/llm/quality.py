"""Quality of documents by supervised embeddings of words and their parts.

Every word of a document, every run of 3 to 5 bytes in a word with its ends marked,
and whether the word repeats the one before, is a term and hashed to a bucket.
Buckets have short learned vectors; a document is the mean of the vectors of all its
terms, and a softmax over that mean gives the classes. Vectors and output are
trained together here by stochastic gradient descent on a bounded sample of labelled
documents. Bytes are taken as they are: case and punctuation tell qualities apart.

Texts are cut, hashed and averaged in whole arrays: hashes of runs are differences
of one running polynomial sum, so no word is touched on its own. A text is taken in
pieces of about a megabyte that end at a space, so memory is bounded unless a word is
longer than that; whether a word repeats the one before is not asked at these ends.

Defined results: a null text is like an empty one, without words; both get the share
of the better class among the labels, as every text does when labels of one kind
only, or none, could be learned. Labels that are null, or whose id has no document,
teach nothing. Repeated rows get equal results; rows without an id are scored too.
An empty table gives no rows. Columns other than the id, the text and the label are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.words import byte_texts, chunks

BUCKET_BITS = 16
PARTS = (3, 4, 5)
# Bytes of text whose terms are taken at once.
PIECE_BYTES = 1 << 20
# What stands before and behind each word.
SPACE = 32
_SPACES = np.isin(np.arange(256), [9, 10, 11, 12, 13, SPACE])
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


@dataclass(frozen=True)
class Classifier:
    """Vector of each bucket, and weights and bias of each class; share of the better class."""

    vectors: np.ndarray
    output: np.ndarray
    bias: np.ndarray
    share: float

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Probability of the better class of each text."""
        means = np.zeros((len(texts), self.vectors.shape[1]))
        counts = np.zeros(len(texts), np.int64)
        for owner, bucket in features(texts):
            counts += np.bincount(owner, minlength=len(texts))
            # Features come text after text, so the sum of each is one run.
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            if len(starts):
                means[owner[starts]] += np.add.reduceat(self.vectors[bucket], starts, axis=0)
        known = counts > 0
        means[known] /= counts[known, None]
        return np.where(known, _softmax(means @ self.output + self.bias)[:, 1], self.share)


def features(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Number of the text and bucket of all terms, in arrays with texts in their order."""
    group, size = [], 0
    for number, text in enumerate(texts):
        for piece in _pieces(text):
            if group and size + len(piece) > PIECE_BYTES:
                yield from _terms(group)
                group, size = [], 0
            group.append((number, piece))
            size += len(piece)
    if group:
        yield from _terms(group)


def _pieces(text: bytes) -> Iterator[bytes]:
    start = 0
    while len(text) - start > PIECE_BYTES:
        end = text.rfind(b" ", start, start + PIECE_BYTES)
        if end <= start:
            end = text.find(b" ", start + PIECE_BYTES)
        if end < 0:
            break
        yield text[start:end]
        start = end
    yield text[start:]


def _terms(pieces: list[tuple[int, bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Terms of pieces with the numbers of their texts: words, repeats, then parts of each length."""
    # Each piece has a space before and behind it.
    data = np.frombuffer(b" " + b" ".join(piece for _, piece in pieces) + b" ", np.uint8)
    is_space = _SPACES[data]
    ends = np.cumsum([len(piece) + 1 for _, piece in pieces])
    numbers = np.array([number for number, _ in pieces])
    powers, inverses = _powers(len(data))
    with np.errstate(over="ignore"):
        marked = np.where(is_space, SPACE, data).astype(np.uint64) + np.uint64(1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(marked * powers[: len(data)])])

    def hashed(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        with np.errstate(over="ignore"):
            value = (sums[last] - sums[first]) * inverses[first]
            value = (value ^ (value >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        owner = np.searchsorted(ends, first, side="right")
        return owner, (value >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)

    inside = np.flatnonzero(~is_space)
    first = inside[is_space[inside - 1]]
    last = inside[is_space[inside + 1]]
    # A word takes both of its ends with it.
    owner, word = hashed(first - 1, last + 2)
    yield numbers[owner], word
    again = (word[1:] == word[:-1]) & (last[1:] - first[1:] == last[:-1] - first[:-1])
    follows = owner[1:] == owner[:-1]
    yield numbers[owner[1:][follows]], again[follows].astype(np.int32)
    spaces = np.cumsum(is_space)
    for size in PARTS:
        start = np.arange(max(0, len(data) - size + 1))
        # No space but at the ends, and a part that is a whole word with its ends is that word.
        between = spaces[start + size - 2] - spaces[start]
        both = is_space[start] & is_space[start + size - 1]
        owner, part = hashed(start := start[(between == 0) & ~both], start + size)
        yield numbers[owner], part


@lru_cache(maxsize=1)
def _longest_powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        return tuple(
            np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, base, np.uint64)]))
            for base in (_BASE, _BASE_INVERSE)
        )


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    return _longest_powers(1 << max(20, int(size - 1).bit_length()))


def learn(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    per_class: int = 1000,
    size: int = 8,
    rounds: int = 15,
) -> Classifier | None:
    """Train on at most ``per_class`` labelled documents of each class, chosen by a hash of the id.

    Of rows that repeat an id, no more than twice ``per_class`` rows in all are taken.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).select(
        F.col("doc_id").alias("label_id"), F.col(label).cast("int").alias("is_better")
    )
    counts = {r.is_better: r["count"] for r in known.groupBy("is_better").count().collect()}
    order = F.xxhash64("label_id")
    chosen = [known.where(F.col("is_better") == c).orderBy(order, "label_id").limit(per_class) for c in (0, 1)]
    sample = F.broadcast(chosen[0].union(chosen[1]))  # at most twice ``per_class`` rows
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = (
        texts.join(sample, F.col("doc_id") == F.col("label_id"))
        .select(F.xxhash64("label_id").alias("order"), F.xxhash64("text").alias("content"), "text", "is_better")
        .mapInArrow(_featurise, "order long, content long, is_better int, buckets array<int>, times array<int>")
        .orderBy("order", "content", "is_better")
        .limit(2 * per_class)
        .toPandas()
    )
    if rows["is_better"].nunique() < 2:
        share = counts.get(1, 0) / max(1, sum(counts.values()))
        return Classifier(np.zeros((1 << BUCKET_BITS, 1)), np.zeros((1, 2)), _log_shares(share), share) if counts else None
    better = rows["is_better"].to_numpy(np.int64)
    # The sample may hold other shares of the classes than the labels; rows are weighed back.
    weight = np.array([counts[c] / (better == c).sum() for c in (0, 1)])[better]
    documents = [
        (np.asarray(b, np.int64), np.asarray(t, np.float32)) for b, t in zip(rows["buckets"], rows["times"])
    ]
    return fit(documents, better, weight / weight.mean(), size, rounds)


def fit(
    documents: list[tuple[np.ndarray, np.ndarray]],
    classes: np.ndarray,
    importance: np.ndarray,
    size: int,
    rounds: int,
    rate: float = 2.0,
    batch: int = 16,
) -> Classifier:
    """Stochastic gradient descent with a falling rate; documents are buckets and how often they occur."""
    rng = np.random.default_rng(12)
    vectors = rng.uniform(-1 / size, 1 / size, (1 << BUCKET_BITS, size))
    share = float(np.clip((classes * importance).sum() / importance.sum(), 1e-3, 1 - 1e-3))
    output, bias = np.zeros((size, 2)), _log_shares(share)
    shares = [times / max(1.0, times.sum()) for _, times in documents]
    steps, step = rounds * -(-len(documents) // batch), 0
    for _ in range(rounds):
        order = rng.permutation(len(documents))
        for start in range(0, len(order), batch):
            own = order[start : start + batch]
            means = np.stack([shares[i] @ vectors[documents[i][0]] for i in own])
            error = _softmax(means @ output + bias)
            error[np.arange(len(own)), classes[own]] -= 1
            error *= importance[own, None] * (rate * (1 - step / steps) / len(own))
            pulls = error @ output.T
            output -= means.T @ error
            bias -= error.sum(axis=0)
            for i, pull in zip(own, pulls):
                # Buckets of a document are distinct, and the mean is divided by its length.
                vectors[documents[i][0]] -= (shares[i] * len(shares[i]) ** 0.5)[:, None] * pull
            step += 1
    return Classifier(vectors.astype(np.float32), output, bias, share)


def _log_shares(share: float) -> np.ndarray:
    share = min(max(share, 1e-3), 1 - 1e-3)
    return np.log(np.array([1 - share, share]))


def _softmax(scores: np.ndarray) -> np.ndarray:
    powers = np.exp(scores - scores.max(axis=1, keepdims=True))
    return powers / powers.sum(axis=1, keepdims=True)


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (piece for whole in batches for piece in chunks([whole], "text")):
        buckets, times = [], []
        for text in byte_texts(batch.column("text")):
            own, n = np.unique(np.concatenate([bucket for _, bucket in features([text])]), return_counts=True)
            buckets.append(own.astype(np.int32))
            times.append(n.astype(np.int32))
        names = ["order", "content", "is_better"]
        lists = [pa.array(column, pa.list_(pa.int32())) for column in (buckets, times)]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(n) for n in names], *lists], names=[*names, "buckets", "times"]
        )


def score(docs: DataFrame, classifier: Classifier | None) -> DataFrame:
    """``doc_id, score`` of every row, from its text alone."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(_score(classifier), f"doc_id {kind}, score double")


def _score(classifier: Classifier | None):
    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for whole in batches for piece in chunks([whole], "text")):
            texts = byte_texts(batch.column("text"))
            scores = classifier.scores(texts) if classifier else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"]
            )

    return rate
