"""Licence texts in documents by a generalised suffix automaton of licence words.

The automaton holds every run of words of every template. A document's words
are streamed through it, which gives at each place the longest run ending there
that some template has. Long runs of a template that follow each other in the
template as in the document are chained into a span, and a template is found
where a span covers enough of it. A short template (a name, a tag) is found only
whole, where the run that ends at a place has it at its end. Of spans that overlap, the
one with the most words of its template stays, so a licence that quotes another or
differs from it by a clause or a version gets its own label only. Set phrases are
found on the side.

Defined results: a null or empty text has no words and no labels, and its score
is 0. Labels are the set phrases' and the found templates'; the score is the
largest covered share of a found template, or 1 with a set phrase. Repeated rows
get equal results. An empty table gives no rows. Columns other than the id and
the text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.license_texts import catalogue
from parcelflow.llm.words import ALNUM, byte_texts, chunks

# Phrases and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
@dataclass
class State:
    length: int
    link: int
    after: dict[int, int] = field(default_factory=dict)
    # Template and place of the prefixes that end here.
    own: list[tuple[int, int]] = field(default_factory=list)
    # All ends of the automaton, of which those from ``first`` to ``last`` are this state's.
    order: list[tuple[int, int]] = field(default_factory=list, repr=False)
    first: int = 0
    last: int = 0

    @property
    def ends(self) -> list[tuple[int, int]]:
        """Template and place at which the runs of this state end."""
        return self.order[self.first : self.last]


class Automaton:
    """Suffix automaton of several sequences of word numbers."""

    def __init__(self, sequences: list[list[int]]) -> None:
        self.states = [State(0, -1)]
        for number, sequence in enumerate(sequences):
            last = 0
            for place, word in enumerate(sequence):
                last = self._append(last, word)
                self.states[last].own.append((number, place))
        self._order_ends()

    def _order_ends(self) -> None:
        """Walk the tree of links: the ends of a state and of all below it lie one after the other."""
        below: list[list[int]] = [[] for _ in self.states]
        for number, state in enumerate(self.states[1:], 1):
            below[state.link].append(number)
        order: list[tuple[int, int]] = []
        waiting = [(0, False)]
        while waiting:
            number, left = waiting.pop()
            state = self.states[number]
            if left:
                state.last = len(order)
                continue
            state.first, state.order = len(order), order
            order += state.own
            waiting.append((number, True))
            waiting += [(child, False) for child in below[number]]

    def _append(self, last: int, word: int) -> int:
        states = self.states
        if word in states[last].after:
            reached = states[last].after[word]
            if states[reached].length == states[last].length + 1:
                return reached
            return self._split(last, word, reached)
        states.append(State(states[last].length + 1, 0))
        new, at = len(states) - 1, last
        while at >= 0 and word not in states[at].after:
            states[at].after[word] = new
            at = states[at].link
        if at >= 0:
            reached = states[at].after[word]
            whole = states[reached].length == states[at].length + 1
            states[new].link = reached if whole else self._split(at, word, reached)
        return new

    def _split(self, at: int, word: int, reached: int) -> int:
        """A state for the runs of ``reached`` that are no longer than from ``at``."""
        states = self.states
        old = states[reached]
        states.append(State(states[at].length + 1, old.link, dict(old.after)))
        short = len(states) - 1
        old.link = short
        while at >= 0 and states[at].after.get(word) == reached:
            states[at].after[word] = short
            at = states[at].link
        return short

    def reached(self, sequence: list[int]) -> int:
        """State of a run that some sequence has."""
        state = 0
        for word in sequence:
            state = self.states[state].after[word]
        return state

    def stream(self, words: list[int]) -> Iterator[tuple[int, int]]:
        """State and length of the longest run that ends at each place."""
        states, state, length = self.states, 0, 0
        for word in words:
            while state and word not in states[state].after:
                state = states[state].link
                length = states[state].length
            following = states[state].after.get(word)
            state, length = (following, length + 1) if following is not None else (0, 0)
            yield state, length

    def runs(self, words: list[int], least: int) -> list[tuple[int, int, int]]:
        """``end, length, state`` of the longest run at each place where it cannot go on."""
        return long_runs(list(self.stream(words)), least)


def long_runs(streamed: list[tuple[int, int]], least: int) -> list[tuple[int, int, int]]:
    found, before, before_state = [], 0, 0
    for place, (state, length) in enumerate([*streamed, (0, 0)]):
        if length <= before >= least:
            found.append((place - 1, before, before_state))
        before, before_state = length, state
    return found


@dataclass(frozen=True)
class Span:
    """Words ``start`` to ``end`` of a text that have ``words`` of a template, the share ``covered`` of it."""

    label: str
    start: int
    end: int
    covered: float
    words: int


class Scanner:
    """Phrases and templates over numbered words; word 0 is any other.

    Templates of at most ``short`` words are found whole, others by chains of runs of at
    least ``least_run`` words with at most ``gap`` other words between.
    """

    def __init__(
        self,
        templates: Mapping[str, tuple[str, ...]] | None = None,
        phrases: Mapping[str, str] = PHRASES,
        least_run: int = 3,
        least_covered: float = 0.6,
        gap: int = 6,
        short: int = 12,
    ) -> None:
        known = catalogue() if templates is None else templates
        owned = sorted({(label, tuple(words_of(text))) for label, texts in known.items() for text in texts})
        owned = [(label, words) for label, words in owned if words]
        words = {w for _, text in owned for w in text} | {w for p in phrases for w in words_of(p)}
        self.number = {word: i for i, word in enumerate(sorted(words), 1)}
        self.labels = [label for label, _ in owned]
        self.lengths = [len(text) for _, text in owned]
        numbers = [[self.number[w] for w in text] for _, text in owned]
        self.automaton = Automaton(numbers)
        self.phrases = [([self.number[w] for w in words_of(p)], label) for p, label in phrases.items()]
        self.least_run, self.least_covered, self.gap, self.short = least_run, least_covered, gap, short
        self.least_length = min([least_run, *self.lengths])
        self._find_whole(numbers)

    def _find_whole(self, numbers: list[list[int]]) -> None:
        """Short templates by the state their last word leads to, and the nearest such state on each way of links."""
        states = self.automaton.states
        self.whole: dict[int, list[int]] = {}
        for template, sequence in enumerate(numbers):
            if len(sequence) <= self.short:
                self.whole.setdefault(self.automaton.reached(sequence), []).append(template)
        self.nearest = [0] * len(states)
        for state in sorted(range(1, len(states)), key=lambda s: states[s].length):
            self.nearest[state] = state if state in self.whole else self.nearest[states[state].link]

    def numbered(self, text: bytes) -> np.ndarray:
        words = ALNUM.findall(text.lower())
        get = self.number.get
        return np.fromiter((get(w, 0) for w in words), np.int32, len(words))

    def phrase_places(self, words: np.ndarray) -> list[tuple[int, str]]:
        places = []
        for phrase, label in self.phrases:
            last = len(words) - len(phrase) + 1
            if last > 0:
                hit = np.logical_and.reduce([words[i : i + last] == w for i, w in enumerate(phrase)])
                places += [(int(start), label) for start in np.flatnonzero(hit)]
        return places

    def spans(self, words: np.ndarray) -> list[Span]:
        """Best of the short templates and chains of long runs, none of which overlaps another."""
        known = np.concatenate([[0], words > 0, [0]]).astype(np.int8)
        edges = np.flatnonzero(np.diff(known))
        found: list[Span] = []
        runs: dict[int, list[tuple[int, int, int]]] = {}
        # Any other word leads the automaton back to its start, so only known stretches are streamed.
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if end - start < self.least_length:
                continue
            streamed = list(self.automaton.stream(words[start:end].tolist()))
            for place, (state, length) in enumerate(streamed, start):
                if self.nearest[state]:
                    found += self._whole_at(place, state, length)
            for last, length, state in long_runs(streamed, self.least_run):
                for template, place in self.automaton.states[state].ends:
                    if self.lengths[template] > self.short:
                        runs.setdefault(template, []).append((start + last, place, length))
        for template, own in runs.items():
            found += self._chained(template, sorted(own))
        return _apart(found, len(words))

    def _whole_at(self, place: int, state: int, length: int) -> Iterator[Span]:
        state = self.nearest[state]
        while state:
            for template in self.whole[state]:
                size = self.lengths[template]
                if size <= length:
                    yield Span(self.labels[template], place - size + 1, place, 1.0, size)
            state = self.nearest[self.automaton.states[state].link]

    def _chained(self, template: int, runs: list[tuple[int, int, int]]) -> list[Span]:
        """Chains of runs ``(text end, template end, length)`` that rise in both, with short gaps."""
        spans: list[Span] = []
        open_chains: list[list[int]] = []  # text start, text end, template end, words covered
        for last, place, length in runs:
            first = last - length + 1
            # Later runs start later, so what is too far from this one is too far from all.
            open_chains = [c for c in open_chains if first - c[1] <= self.gap + 1]
            best = None
            for chain in open_chains:
                if chain[2] < place and chain[1] < last and (best is None or chain[3] > best[3]):
                    best = chain
            new = min(length, last - best[1], place - best[2]) if best else length
            chain = [best[0], last, place, best[3] + new] if best else [first, last, place, length]
            open_chains.append(chain)
            share = chain[3] / self.lengths[template]
            if share >= self.least_covered:
                spans.append(Span(self.labels[template], chain[0], chain[1], share, chain[3]))
        return spans


def words_of(text: str) -> list[bytes]:
    return ALNUM.findall(text.encode().lower())


def _apart(found: list[Span], n_words: int) -> list[Span]:
    """Spans in the order of their words, without those that overlap one before them."""
    taken, kept = bytearray(n_words), []
    for span in sorted(found, key=lambda s: (-s.words, -s.covered, s.label, s.start)):
        if taken.find(1, span.start, span.end + 1) < 0:
            taken[span.start : span.end + 1] = b"\1" * (span.end + 1 - span.start)
            kept.append(span)
    return sorted(kept, key=lambda s: s.start)


def scan(docs: DataFrame, scanner: Scanner | None = None) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` per row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    schema = (
        f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long,"
        " base_labels string, labels string, score double"
    )
    return texts.mapInArrow(_digest(scanner or Scanner()), schema)


def spans(docs: DataFrame, scanner: Scanner | None = None) -> DataFrame:
    """``doc_id, label, start, end, covered``: spans of words that cover a template."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    schema = f"doc_id {kind}, label string, start long, end long, covered double"
    return texts.mapInArrow(_spans(scanner or Scanner()), schema)


def _digest(scanner: Scanner):
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for whole in batches for piece in chunks([whole], "text")):
            rows = [_digested(scanner, text) for text in byte_texts(batch.column("text"))]
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            names = "doc_id n_words n_base first_word last_word base_labels labels score".split()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=names)

    return digest


def _digested(scanner: Scanner, text: bytes) -> tuple:
    words = scanner.numbered(text)
    places = scanner.phrase_places(words)
    found = scanner.spans(words)
    base = {label for _, label in places}
    starts = [start for start, _ in places]
    return (
        len(words),
        len(places),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted(base)),
        ",".join(sorted(base | {span.label for span in found})),
        max([1.0 if base else 0.0, *(span.covered for span in found)]),
    )


def _spans(scanner: Scanner):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for whole in batches for piece in chunks([whole], "text")):
            found = [
                (row, span)
                for row, text in enumerate(byte_texts(batch.column("text")))
                for span in scanner.spans(scanner.numbered(text))
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array([row for row, _ in found], pa.int64())),
                    pa.array([s.label for _, s in found], pa.string()),
                    pa.array([s.start for _, s in found], pa.int64()),
                    pa.array([s.end for _, s in found], pa.int64()),
                    pa.array([s.covered for _, s in found], pa.float64()),
                ],
                names=["doc_id", "label", "start", "end", "covered"],
            )

    return find
