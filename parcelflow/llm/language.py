"""Language of each document by a bidirectional gated recurrent network over bytes.

The network reads windows of consecutive bytes in both directions and gives
each position a probability per language; a document has the mean over all of
its positions. Weights are trained here by backpropagation through time on a
bounded sample of windows and travel to the tasks that label whole texts.

Defined results: a null text or one without a letter is `und` with score 0, and
so is every text when nothing could be learned. Repeated rows get equal
results. An empty table gives no rows. Columns other than the id, the text and
the language are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.llm.words import byte_texts, chunks
from parcelflow.sources import keep

UNKNOWN = "und"
WINDOW = 64
# Known runs that every text is given, so that a few unknown ones of a short text do not decide.
BENEFIT, MARGIN = 20, 0.05
# Steps that shares are counted in, so that their quantile needs no sort.
STEPS = 100_000
# Number that stands for all documents where runs are counted, and runs that a task holds before it hands them on.
ALL, HELD_RUNS = -1, 1 << 20
# ASCII letters in lower case and all bytes of longer characters; anything else is zero.
_LETTERS = bytes(b if b >= 0x80 or 97 <= b <= 122 else 0 for b in range(256))
# Windows that go through the network side by side.
SIDE_BY_SIDE = 2048


@dataclass(frozen=True)
class Direction:
    """Byte inputs (3h x 256) and recurrent weights (3h x h) of update, reset and new state."""

    inputs: np.ndarray
    recurrent: np.ndarray

    @property
    def hidden(self) -> int:
        return self.recurrent.shape[1]


@dataclass(frozen=True)
class Network:
    languages: list[str]
    forward: Direction
    backward: Direction
    output: np.ndarray
    bias: np.ndarray


def learn(
    docs: DataFrame,
    docs_per_language: int = 400,
    windows_per_doc: int = 6,
    hidden: int = 8,
    steps: int = 500,
) -> Network | None:
    """Train on windows of at most ``docs_per_language`` documents of each known language."""
    sample = (
        _sample(docs, docs_per_language)
        .select("lang", "text")
        .mapInArrow(_cut(windows_per_doc), "lang string, window binary")
        .orderBy("lang", "window")
        .toPandas()
    )
    return train(sample, hidden, steps) if len(sample) else None


def _sample(docs: DataFrame, docs_per_language: int) -> DataFrame:
    """``lang, text, place`` of at most so many documents of a language, the first by a hash.

    A bound on the hash, from the number of different documents of the language, leaves about twice
    as many before anything is shuffled, so that does not grow with the table, nor with a language.
    """
    order = F.xxhash64("doc_id", "text").alias("order")
    known = docs.where("lang IS NOT NULL AND length(text) > 0").select("lang", "text", order)
    counts = known.groupBy("lang").agg(F.approx_count_distinct("order").alias("n"))
    share = F.least(F.lit(2.0 * docs_per_language) / F.col("n"), F.lit(1.0))
    upto = F.lit(-(2.0**63)) + share * F.lit(2.0**64)
    # One row per language.
    bounds = F.broadcast(counts.select(F.col("lang").alias("bound_lang"), upto.alias("upto")))
    near = known.join(bounds, F.col("lang") == F.col("bound_lang")).where(F.col("order") <= F.col("upto"))
    # Rows that repeat id and text are one document.
    single = near.groupBy("lang", "order").agg(F.min("text").alias("text"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("order"))
    return single.select("lang", "text", place.alias("place")).where(F.col("place") <= docs_per_language)


@dataclass(frozen=True)
class Familiar:
    """Three-byte runs of letters that are known of any language, and the least share of them a text needs.

    There is a bit for each run. ``own_runs`` and ``own_least`` have the same for each language alone.
    """

    bits: np.ndarray
    least: float
    own_runs: dict[str, np.ndarray]
    own_least: dict[str, float]

    def shares(self, texts: list[str], languages: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Shares of the runs of each text that any and that its language knows, with ``BENEFIT`` known ones added.

        Of a language without known runs the second share is 1.
        """
        own = {lang: _bits(self.own_runs[lang]) for lang in set(languages) & set(self.own_runs)}
        runs = [_runs(text) for text in texts]
        return (
            np.array([_share(self.bits, found) for found in runs]),
            np.array([_share(own[g], found) if g in own else 1.0 for g, found in zip(languages, runs, strict=True)]),
        )


def learn_familiar(docs: DataFrame, rarest: int = 400) -> Familiar | None:
    """What texts of the known languages consist of, and how far a new text of them can depart.

    All labelled rows are counted. A run is known of a language if at least one of ``rarest`` of its
    documents has it. The documents of one half, by a hash, are held against the runs known from the
    other, of any language and of their own: each bound lies below the shares of all but a few of a
    thousand, and further by ``MARGIN``.
    """
    half = F.pmod(F.xxhash64("doc_id", "text"), F.lit(2)).cast("int").alias("half")
    known = docs.where("lang IS NOT NULL AND length(text) > 0").select("lang", "text", half)
    counted = known.mapInArrow(_count_runs, "lang string, half int, run int, n long")
    counts = keep(counted.groupBy("lang", "half", "run").agg(F.sum("n").alias("n")), "runs")
    whole = _frequent(counts.groupBy("lang", "run").agg(F.sum("n").alias("n")), rarest)
    if not whole:
        return None
    first = _frequent(counts.where("half = 0"), rarest)
    halved = Familiar(_bits(*first.values()), 0.0, first, {})
    steps = known.where("half = 1").select("lang", "text").mapInArrow(_held_shares(halved), "lang string, step int, n long")
    held = steps.groupBy("lang", "step").agg(F.sum("n").alias("n")).toPandas()  # at most STEPS + 1 of a language
    least = {lang: _least(held[held["lang"] == lang]) for lang in whole}
    return Familiar(_bits(*whole.values()), _least(held[held["lang"].isna()]), whole, least)


def _frequent(counts: DataFrame, rarest: int) -> dict[str, np.ndarray]:
    """Runs that one of ``rarest`` documents of a language has, of each language that has any."""
    totals = counts.where(F.col("run") == ALL).select(F.col("lang").alias("of"), F.col("n").alias("total"))
    # One row per language.
    rows = counts.where(F.col("run") != ALL).join(F.broadcast(totals), F.col("lang") == F.col("of"))
    runs = rows.where(F.col("n") * rarest >= F.col("total")).select("lang", "run").toPandas()  # at most 2^24 of a language
    return {lang: own["run"].to_numpy() for lang, own in runs.groupby("lang")}


def _bits(*runs: np.ndarray) -> np.ndarray:
    bits = np.zeros(1 << 21, np.uint8)
    for some in runs:
        np.bitwise_or.at(bits, some >> 3, (0x80 >> (some & 7)).astype(np.uint8))
    return bits


def _least(held: pd.DataFrame) -> float:
    """Bound below shares that were counted in steps."""
    held = held.sort_values("step")
    return _quantile(held["step"].to_numpy(), held["n"].to_numpy(), 0.002) / STEPS - MARGIN if len(held) else 0.0


def _quantile(values: np.ndarray, counts: np.ndarray, share: float) -> float:
    """Quantile, between neighbours in proportion, of ascending values that occur so often each."""
    upto = np.cumsum(counts)
    place = share * (upto[-1] - 1)
    low, high = (int(values[np.searchsorted(upto, at, side="right")]) for at in (int(place), int(np.ceil(place))))
    return low + (high - low) * (place - int(place))


def unfamiliar(told: DataFrame, familiar: Familiar | None) -> Column:
    """Whether a text of ``told`` is not like those of any known language, or not like those of the language told."""
    if familiar is None:
        return F.lit(False)
    return (F.col("share") < familiar.least) | _below("own_share", familiar.own_least)


def _below(measure: str, least: dict[str, float]) -> Column:
    """Whether a measure lies below the bound of the language told, if that has one."""
    if not least:
        return F.lit(False)
    bounds = F.create_map(*[F.lit(x) for bound in least.items() for x in bound])
    return F.coalesce(F.col(measure) < bounds[F.col("lang_pred")], F.lit(False))


def _runs(text: str) -> np.ndarray:
    """Numbers of all runs of three bytes within words, in lower case."""
    data = np.frombuffer(text.lower().encode().translate(_LETTERS), np.uint8).astype(np.int32)
    if len(data) < 3:
        return np.empty(0, np.int32)
    inside = (data[:-2] > 0) & (data[1:-1] > 0) & (data[2:] > 0)
    return ((data[:-2] << 16) | (data[1:-1] << 8) | data[2:])[inside]


def _share(bits: np.ndarray, runs: np.ndarray) -> float:
    known = np.count_nonzero(bits[runs >> 3] & (0x80 >> (runs & 7)).astype(np.uint8))
    return (known + BENEFIT) / (len(runs) + BENEFIT)


def _count_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with each run by language and half, and under ``ALL`` their number."""
    held: dict[tuple[str, int], tuple[np.ndarray, np.ndarray]] = {}
    for batch in (piece for whole in batches for piece in chunks([whole], "text")):
        own = defaultdict(list)
        columns = (batch.column(name).to_pylist() for name in ("lang", "half", "text"))
        for lang, half, text in zip(*columns, strict=True):
            own[lang, half] += [np.unique(_runs(text)), np.array([ALL], np.int32)]
        for key, found in own.items():
            runs, counts = np.unique(np.concatenate(found), return_counts=True)
            if key in held:
                runs, places = np.unique(np.concatenate([held[key][0], runs]), return_inverse=True)
                counts = np.bincount(places, np.concatenate([held[key][1], counts])).astype(np.int64)
            held[key] = runs, counts
        if sum(len(runs) for runs, _ in held.values()) > HELD_RUNS:
            yield _run_rows(held)
            held.clear()
    if held:
        yield _run_rows(held)


def _run_rows(held: dict[tuple[str, int], tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    sizes = [len(runs) for runs, _ in held.values()]
    owner = pa.array(np.repeat(np.arange(len(sizes)), sizes))
    languages, halves = zip(*held, strict=True)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(languages, pa.string()).take(owner),
            pa.array(halves, pa.int32()).take(owner),
            pa.array(np.concatenate([runs for runs, _ in held.values()]).astype(np.int32)),
            pa.array(np.concatenate([counts for _, counts in held.values()]).astype(np.int64)),
        ],
        names=["lang", "half", "run", "n"],
    )


def _held_shares(familiar: Familiar):
    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """How many texts of each language have each share of runs known of it, in steps; without a language, of any."""
        for batch in (piece for whole in batches for piece in chunks([whole], "text")):
            languages = batch.column("lang").to_pylist()
            of_any, of_own = familiar.shares(batch.column("text").to_pylist(), languages)
            of = np.array(languages)
            held = [(None, of_any), *((lang, of_own[of == lang]) for lang in set(languages))]
            for lang, shares in held:
                steps, counts = np.unique(np.floor(shares * STEPS).astype(np.int32), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(steps), pa.string()), pa.array(steps), pa.array(counts.astype(np.int64))],
                    names=["lang", "step", "n"],
                )

    return share


def _cut(count: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Windows at even distances over the whole text."""
        for batch in batches:
            languages, windows = [], []
            for lang, text in zip(
                batch.column("lang").to_pylist(), byte_texts(batch.column("text")), strict=True
            ):
                for start in np.unique(np.linspace(0, max(0, len(text) - WINDOW), count).astype(int)):
                    languages.append(lang)
                    windows.append(text[start : start + WINDOW])
            yield pa.RecordBatch.from_arrays(
                [pa.array(languages, pa.string()), pa.array(windows, pa.binary())], names=["lang", "window"]
            )

    return cut


def train(sample: pd.DataFrame, hidden: int, steps: int, batch: int = 192, rate: float = 0.01) -> Network:
    """Adam over batches with as many windows of each language, from a fixed start."""
    rng = np.random.default_rng(11)
    languages = sorted(sample["lang"].unique())
    windows = np.zeros((len(sample), WINDOW), np.uint8)
    lengths = np.array([len(w) for w in sample["window"]])
    for row, window in enumerate(sample["window"]):
        windows[row, : len(window)] = np.frombuffer(window, np.uint8)
    own = [np.flatnonzero(sample["lang"] == lang) for lang in languages]

    def start(*shape: int) -> np.ndarray:
        return rng.normal(0, 0.3, shape).astype(np.float32)

    weights = [
        start(3 * hidden, 256), start(3 * hidden, hidden),
        start(3 * hidden, 256), start(3 * hidden, hidden),
        start(len(languages), 2 * hidden), np.zeros((len(languages), 1), np.float32),
    ]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    for step in range(1, steps + 1):
        labels = rng.integers(0, len(languages), batch)
        rows = np.array([rng.choice(own[label]) for label in labels])
        gradients = _gradients(weights, windows[rows].T.astype(np.intp), lengths[rows], labels)
        pace = rate * (1 - step / (steps + 1))
        for weight, gradient, (mean, square) in zip(weights, gradients, moments, strict=True):
            mean += 0.1 * (gradient - mean)
            square += 0.01 * (gradient**2 - square)
            weight -= pace * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return Network(languages, Direction(*weights[:2]), Direction(*weights[2:4]), *weights[4:])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _gradients(
    weights: list[np.ndarray], windows: np.ndarray, lengths: np.ndarray, labels: np.ndarray
) -> list[np.ndarray]:
    """Gradients of the mean cross entropy of all positions, through time in both directions."""
    inside = (np.arange(len(windows))[:, None] < lengths).astype(np.float32)
    passes = [
        _remembered(weights[0], weights[1], windows, inside, range(len(windows))),
        _remembered(weights[2], weights[3], windows, inside, range(len(windows) - 1, -1, -1)),
    ]
    states = np.concatenate([p["state"] for p in passes], axis=1)
    scores = np.matmul(weights[4], states) + weights[5]
    scores -= scores.max(axis=1, keepdims=True)
    errors = np.exp(scores)
    errors /= errors.sum(axis=1, keepdims=True)
    errors[:, labels, np.arange(len(labels))] -= 1
    errors *= (inside / inside.sum())[:, None, :]
    by_state = np.matmul(weights[4].T, errors)
    hidden = weights[1].shape[1]
    result = []
    for p, recurrent, own in zip(
        passes, (weights[1], weights[3]), (by_state[:, :hidden], by_state[:, hidden:]), strict=True
    ):
        result += _through_time(p, recurrent, own, windows, inside)
    return [
        *result,
        np.einsum("tcb,thb->ch", errors, states),
        errors.sum(axis=(0, 2))[:, None],
    ]


def _remembered(
    inputs: np.ndarray, recurrent: np.ndarray, windows: np.ndarray, inside: np.ndarray, order: range
) -> dict:
    """One direction over all steps, with what its gradients need."""
    hidden, (steps, batch) = recurrent.shape[1], windows.shape
    kept = {k: np.empty((steps, hidden, batch), np.float32) for k in ("state", "before", "update", "reset", "new", "pulled")}
    state = np.zeros((hidden, batch), np.float32)
    for t in order:
        given, pulled = inputs[:, windows[t]], recurrent @ state
        gates = _sigmoid(given[: 2 * hidden] + pulled[: 2 * hidden])
        update, reset = gates[:hidden], gates[hidden:]
        new = np.tanh(given[2 * hidden :] + reset * pulled[2 * hidden :])
        kept["before"][t], kept["update"][t], kept["reset"][t] = state, update, reset
        kept["new"][t], kept["pulled"][t] = new, pulled[2 * hidden :]
        # Places behind the end of a text keep the state of a start.
        state = (new + update * (state - new)) * inside[t]
        kept["state"][t] = state
    return kept | {"order": order}


def _through_time(
    p: dict, recurrent: np.ndarray, by_state: np.ndarray, windows: np.ndarray, inside: np.ndarray
) -> list[np.ndarray]:
    hidden = recurrent.shape[1]
    by_input = np.empty((len(windows), 3 * hidden, windows.shape[1]), np.float32)
    by_recurrent = np.zeros_like(recurrent)
    carried = np.zeros_like(by_state[0])
    for t in reversed(p["order"]):
        flow = (carried + by_state[t]) * inside[t]
        update, reset, new = p["update"][t], p["reset"][t], p["new"][t]
        by_new = flow * (1 - update) * (1 - new**2)
        by_update = flow * (p["before"][t] - new) * update * (1 - update)
        by_reset = by_new * p["pulled"][t] * reset * (1 - reset)
        by_input[t] = np.concatenate([by_update, by_reset, by_new])
        pulled = np.concatenate([by_update, by_reset, by_new * reset])
        by_recurrent += pulled @ p["before"][t].T
        carried = flow * update + recurrent.T @ pulled
    places = windows.ravel()
    by_table = [
        np.bincount(places, by_input[:, row].ravel(), 256) for row in range(3 * hidden)
    ]
    return [np.array(by_table, np.float32), by_recurrent]


class Labeller:
    """Position probabilities with weights scaled for one exponential per gate.

    sigmoid(x) is 1 / (1 + exp(-x)) and tanh(x) is 2 sigmoid(2x) - 1, so inputs
    and recurrent weights are stored times -1, and times -2 for the new state.
    """

    def __init__(self, network: Network) -> None:
        self.network = network
        hidden = network.forward.hidden
        scale = np.repeat(np.array([-1, -1, -2], np.float32), hidden)[:, None]
        self.directions = [
            (np.ascontiguousarray(d.inputs * scale), np.ascontiguousarray(d.recurrent * scale))
            for d in (network.forward, network.backward)
        ]

    def pooled(self, windows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Sum of the probabilities of all places of each window (rows), per language."""
        sums = np.empty((len(windows), len(self.network.languages)), np.float32)
        for start in range(0, len(windows), SIDE_BY_SIDE):
            part = slice(start, start + SIDE_BY_SIDE)
            sums[part] = self._sums(windows[part].T.astype(np.intp), lengths[part])
        return sums

    def _sums(self, windows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        steps = range(int(lengths.max()))
        short = lengths.min() < len(steps)
        inside = (np.arange(len(steps))[:, None] < lengths).astype(np.float32) if short else None
        hidden = self.network.forward.hidden
        with np.errstate(over="ignore"):
            ahead = self._states(0, windows, inside, steps)
            back = self._states(1, windows, inside, steps[::-1])
            scores = np.matmul(self.network.output[:, :hidden], ahead)
            scores += np.matmul(self.network.output[:, hidden:], back)
        scores += self.network.bias
        scores -= scores.max(axis=1, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=1, keepdims=True)
        if short:
            scores *= inside[:, None, :]
        return scores.sum(axis=0).T

    def _states(self, direction: int, windows: np.ndarray, inside: np.ndarray | None, order: range) -> np.ndarray:
        inputs, recurrent = self.directions[direction]
        hidden, batch = recurrent.shape[1], windows.shape[1]
        states = np.empty((len(order), hidden, batch), np.float32)
        given, pulled = (np.empty((3 * hidden, batch), np.float32) for _ in range(2))
        state = np.zeros((hidden, batch), np.float32)
        gates, new = given[: 2 * hidden], given[2 * hidden :]
        for t in order:
            np.take(inputs, windows[t], axis=1, out=given, mode="clip")
            np.matmul(recurrent, state, out=pulled)
            gates += pulled[: 2 * hidden]
            np.exp(gates, out=gates)
            gates += 1
            np.reciprocal(gates, out=gates)
            pulled[2 * hidden :] *= gates[hidden:]
            new += pulled[2 * hidden :]
            np.exp(new, out=new)
            new += 1
            np.divide(2, new, out=new)
            new -= 1
            state -= new
            state *= gates[:hidden]
            state += new
            if inside is not None:
                state *= inside[t]
            states[t] = state
        return states

    def documents(self, texts: list[bytes]) -> np.ndarray:
        """Mean probabilities of whole texts that are not empty, per language."""
        counts = np.array([-(-len(t) // WINDOW) for t in texts])
        joined = b"".join(t + bytes(-len(t) % WINDOW) for t in texts)
        windows = np.frombuffer(joined, np.uint8).reshape(-1, WINDOW)
        lengths = np.full(len(windows), WINDOW)
        ends = np.cumsum(counts)
        sizes = np.array([len(t) for t in texts])
        lengths[ends - 1] = sizes - (counts - 1) * WINDOW
        full = lengths == WINDOW
        sums = np.empty((len(windows), len(self.network.languages)), np.float32)
        for those in (np.flatnonzero(full), np.flatnonzero(~full)):
            if len(those):
                sums[those] = self.pooled(windows[those], lengths[those])
        return np.add.reduceat(sums, ends - counts, axis=0) / sizes[:, None]


def identify(
    docs: DataFrame, network: Network | None, familiar: Familiar | None = None, also: Sequence[str] = ()
) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row, from its text alone, and its columns ``also`` as they are.

    With ``familiar`` there are ``share, own_share`` too: the shares of its runs that any language and
    that the language told knows.
    """
    kinds = {c: f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in ["doc_id", *also]}
    lettered = F.when(F.col("text").rlike(r"\p{L}"), F.col("text"))
    rows = docs.select("doc_id", lettered.alias("text"), *[f"`{c}`" for c in also])
    shares = ["share double", "own_share double"] if familiar else []
    schema = [kinds["doc_id"], "lang_pred string", "score double", *shares, *[kinds[c] for c in also]]
    return rows.mapInArrow(_label(network, familiar, also), ", ".join(schema))


def doubtful(told: DataFrame) -> Column:
    """Whether the network scores a row of ``told`` lower than almost all texts that it takes for the same language.

    All labelled rows that it is right about are counted: the bound lies below the scores of all but
    a few of a thousand of them, and further by ``MARGIN``.
    """
    right = told.where(F.col("lang_pred") == F.col("lang"))
    steps = right.groupBy("lang_pred", F.floor(F.col("score") * STEPS).alias("step")).agg(F.count("*").alias("n"))
    counts = steps.toPandas()  # at most STEPS + 1 of a language
    return _below("score", {lang: _least(own) for lang, own in counts.groupby("lang_pred")})


def _label(network: Network | None, familiar: Familiar | None, also: Sequence[str]):
    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(network) if network else None
        for batch in (piece for whole in batches for piece in chunks([whole], "text")):
            texts = byte_texts(batch.column("text"))
            languages, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            rows = [row for row, text in enumerate(texts) if text]
            if labeller and rows:
                means = labeller.documents([texts[row] for row in rows])
                for row, best, score in zip(rows, means.argmax(axis=1), means.max(axis=1), strict=True):
                    languages[row], scores[row] = network.languages[best], min(1.0, float(score))
            found = {"doc_id": batch.column("doc_id"), "lang_pred": pa.array(languages, pa.string()), "score": pa.array(scores)}
            if familiar:
                shares = familiar.shares([text or "" for text in batch.column("text").to_pylist()], languages)
                found |= {"share": pa.array(shares[0]), "own_share": pa.array(shares[1])}
            found |= {c: batch.column(c) for c in also}
            yield pa.RecordBatch.from_arrays(list(found.values()), names=list(found))

    return label
