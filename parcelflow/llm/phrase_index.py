"""Benchmark passages in documents, by a positional inverted index.

The index stores, for terms of the test items, the places at which each
document has them, in segments sorted by term. Of every window of consecutive item words
the rarest terms over all documents are looked up, their lists are shifted by
the terms' offsets in the window and intersected, and where they agree the
whole phrase is compared. Lists that agree only within a slop are candidates of
proximity matches: a window's words in their order, with at most as many other words
between them as the slop. As none of its terms is shifted by more than that, no such match is lost.

Items are taken in batches of a bounded size, so a batch's windows fit on the
driver and in a broadcast however large the benchmark is.

Defined results: null and empty texts have no words, and an item without words
or without an id takes no part. An item shorter than a window is one window. A
document is an id with its text, so repeated rows get equal results. Empty
tables give no matches. Columns other than the ids and texts are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.llm.words import ALNUM, byte_texts, chunks
from parcelflow.operators.joins import BROADCAST_BYTES
from parcelflow.sources import keep, stage

# Bytes of item text in one batch.
ITEM_BYTES = 4 << 20
# Anchors that one number of 64 bits can tell apart; more would not change what is found in full.
MOST_ANCHORS = 64
_DOC = ("doc_id", "content")


@dataclass(frozen=True)
class Windows:
    """Distinct windows of a batch of items, each with the items that have it."""

    words: list[tuple[bytes, ...]]
    items: list[list[str]]

    @property
    def vocabulary(self) -> set[bytes]:
        return {word for window in self.words for word in window}


def windows_of(items: list[tuple[str, bytes]], length: int) -> Windows:
    found: dict[tuple[bytes, ...], list[str]] = {}
    for item_id, text in items:
        words = ALNUM.findall(text.lower())
        for start in range(max(1, len(words) - length + 1) if words else 0):
            owners = found.setdefault(tuple(words[start : start + length]), [])
            if not owners or owners[-1] != item_id:
                owners.append(item_id)
    return Windows(list(found), list(found.values()))


def identified(docs: DataFrame) -> DataFrame:
    """Id, hash of the text and text."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.xxhash64(text).alias("content"), text.alias("text"))


def phrase_matches(
    docs: DataFrame, items: DataFrame, length: int = 10, anchors: int = 2
) -> DataFrame:
    """``doc_id, content, item_id, start, end``: spans of words covered by windows of an item."""
    return matches(docs, items, length, anchors).where("exact").drop("exact")


def matches(
    docs: DataFrame, items: DataFrame, length: int = 10, anchors: int = 2, slop: int = 0
) -> DataFrame:
    """Spans as of ``phrase_matches`` where ``exact``, and others that hold a window with up to ``slop`` more words."""
    parts = [
        _verified(docs, windows, _agreeing(_shifted(docs, windows, min(anchors, MOST_ANCHORS)), slop), slop)
        for windows in _batches(items, length)
    ]
    schema = "doc_id {}, content long, item_id string, start int, end int, exact boolean"
    return _union(docs, parts, schema)


def proximity_matches(
    docs: DataFrame, items: DataFrame, length: int = 10, anchors: int = 2, slop: int = 5
) -> DataFrame:
    """``doc_id, content, item_id, start``: places where the rarest terms of a window stand nearly right.

    Each term may be off by words, as long as the starts that the terms point to
    lie within ``slop`` words of each other.
    """
    parts = []
    for windows in _batches(items, length):
        shifted = _shifted(docs, windows, anchors)
        near = Window.partitionBy(*_DOC, "window").orderBy("start").rangeBetween(0, slop)
        together = shifted.withColumn("seen", F.size(F.collect_set("anchor").over(near)))
        owners = docs.sparkSession.createDataFrame(
            [(w, item) for w, own in enumerate(windows.items) for item in own], "window int, item_id string"
        )
        parts.append(
            together.where(F.col("seen") == F.col("n_anchors"))
            .join(F.broadcast(owners), "window")
            .select(*_DOC, "item_id", "start")
            .distinct()
        )
    return _union(docs, parts, "doc_id {}, content long, item_id string, start int")


def contamination(docs: DataFrame, items: DataFrame, length: int = 10, slop: int = 0) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, n_near, items_sha256, contaminated`` for every row.

    ``n_near`` counts the items with exact or proximity matches; only exact ones contaminate.
    """
    places = F.flatten(F.collect_list(F.when(F.col("exact"), F.sequence(F.col("start"), F.col("end") - 1))))
    found = stage(
        matches(docs, items, length, slop=slop).groupBy(*_DOC).agg(
            F.size(F.array_distinct(places)).cast("long").alias("n_hit"),
            F.sort_array(F.collect_set(F.when(F.col("exact"), F.col("item_id")))).alias("item_ids"),
            F.size(F.collect_set("item_id")).cast("long").alias("n_near"),
        ).select(
            F.col("doc_id").alias("id"),
            F.col("content").alias("hash"),
            "n_hit",
            "n_near",
            F.size("item_ids").cast("long").alias("n_items"),
            F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        ),
        "contaminated",
    )
    side = F.broadcast(found.df) if found.bytes <= BROADCAST_BYTES else found.df
    counted = identified(docs).mapInArrow(_count_words, f"{_doc_schema(docs)}, n_words long")
    hits = F.coalesce("n_hit", F.lit(0)).cast("long")
    return counted.join(
        side, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("content") == F.col("hash")), "left"
    ).select(
        *_DOC,
        "n_words",
        hits.alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        (hits > 0).alias("contaminated"),
    )


def _doc_schema(docs: DataFrame) -> str:
    return f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, content long"


def _union(docs: DataFrame, parts: list[DataFrame], schema: str) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()
    result = docs.sparkSession.createDataFrame([], schema.format(kind))
    for part in parts:
        result = result.unionByName(part)
    return result


def _batches(items: DataFrame, length: int) -> Iterator[Windows]:
    rows = items.select(F.col("item_id").cast("string"), F.col("text").cast("binary")).dropna()
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-total // ITEM_BYTES)
    for batch in range(count):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == batch)
        windows = windows_of([(r.item_id, bytes(r.text)) for r in part.orderBy("item_id", "text").collect()], length)
        if windows.words:
            yield windows


def _shifted(docs: DataFrame, windows: Windows, anchors: int) -> DataFrame:
    """Starts of windows that the places of their rarest terms point to."""
    texts, spark = identified(docs), docs.sparkSession
    counts = (
        texts.mapInArrow(_count_terms(windows.vocabulary), "term string, n long")
        .groupBy("term")
        .agg(F.sum("n").alias("n"))
    )
    known = {r.term.encode(): r.n for r in counts.collect()}  # terms of this batch only
    wanted, rows = set(), []
    for number, words in enumerate(windows.words):
        rarest = sorted(set(words), key=lambda w: (known.get(w, 0), w))[:anchors]
        if all(known.get(w) for w in words):
            wanted.update(rarest)
            rows += [
                (number, place, len(rarest), word.decode(), words.index(word))
                for place, word in enumerate(rarest)
            ]
    postings = texts.mapInArrow(_post(wanted), f"term string, {_doc_schema(docs)}, places array<int>")
    order = ("term", *_DOC)
    # Each task writes a segment of its own, sorted by term; the texts are read once and nothing is shuffled.
    index = keep(postings.sortWithinPartitions(*order), "postings")
    lookups = spark.createDataFrame(
        rows, "window int, anchor int, n_anchors int, term string, offset int"
    )
    start = F.explode(F.transform("places", lambda p: p - F.col("offset"))).alias("start")
    return (
        index.join(F.broadcast(lookups), "term")
        .select(*_DOC, "window", "anchor", "n_anchors", start)
        .where("start >= 0")
    )


def _agreeing(shifted: DataFrame, slop: int) -> DataFrame:
    """Ranges of starts that all anchors point to, each anchor counted once however often the row is repeated.

    Starts within ``slop`` of each other lie in one stretch of ``slop + 1`` starts or in two that
    follow each other, so each start is put with its own stretch and with the one before.
    """
    stretch = F.col("start") if not slop else F.floor(F.col("start") / (slop + 1)).cast("int")
    both = F.array(stretch) if not slop else F.array(stretch - 1, stretch)
    return (
        shifted.withColumn("stretch", F.explode(both))
        .groupBy(*_DOC, "window", "stretch")
        .agg(
            F.bit_or(F.expr("shiftleft(1L, anchor)")).alias("seen"),
            F.first("n_anchors").alias("n_anchors"),
            F.min("start").alias("low"),
            F.max("start").alias("high"),
        )
        .where("bit_count(seen) = n_anchors")
        .groupBy(*_DOC)
        .agg(F.collect_list(F.struct("window", "low", "high")).alias("candidates"))
    )


def _verified(docs: DataFrame, windows: Windows, candidates: DataFrame, slop: int) -> DataFrame:
    known = keep(candidates, "candidates").withColumnsRenamed({"doc_id": "id", "content": "hash"})
    size = known.agg(F.sum(64 + 24 * F.size("candidates"))).first()[0] or 0
    side = F.broadcast(known) if size <= BROADCAST_BYTES else known.hint("shuffle_hash")
    texts = identified(docs).join(
        side, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("content") == F.col("hash"))
    )
    schema = f"{_doc_schema(docs)}, item_id string, start int, end int, exact boolean"
    return texts.select(*_DOC, "text", "candidates").mapInArrow(_compare(windows, slop), schema).distinct()


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = [len(ALNUM.findall(t.lower())) for t in byte_texts(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("content"), pa.array(counts, pa.int64())],
            names=[*_DOC, "n_words"],
        )


def _count_terms(vocabulary: set[bytes]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """How many documents of this task have each term."""
        seen = dict.fromkeys(vocabulary, 0)
        for batch in batches:
            for text in byte_texts(batch.column("text")):
                for term in vocabulary.intersection(ALNUM.findall(text.lower())):
                    seen[term] += 1
        found = {term: n for term, n in seen.items() if n}
        terms = pa.array([t.decode() for t in found], pa.string())
        yield pa.RecordBatch.from_arrays([terms, pa.array(list(found.values()), pa.int64())], names=["term", "n"])

    return count


def _post(wanted: set[bytes]):
    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Places of the wanted terms in each document."""
        for batch in (piece for whole in batches for piece in chunks([whole], "text")):
            terms, rows, places = [], [], []
            for row, text in enumerate(byte_texts(batch.column("text"))):
                found: dict[bytes, list[int]] = {}
                for place, word in enumerate(ALNUM.findall(text.lower())):
                    if word in wanted:
                        found.setdefault(word, []).append(place)
                terms += [t.decode() for t in found]
                rows += [row] * len(found)
                places += found.values()
            taken = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(terms, pa.string()),
                    batch.column("doc_id").take(taken),
                    batch.column("content").take(taken),
                    pa.array(places, pa.list_(pa.int32())),
                ],
                names=["term", *_DOC, "places"],
            )

    return post


def near_end(words: list[bytes], phrase: tuple[bytes, ...], start: int, slop: int) -> int | None:
    """End of the shortest stretch from ``start`` that holds the phrase in order, if no longer than ``slop`` more."""
    place, end = start, min(len(words), start + len(phrase) + slop)
    for word in phrase:
        while place < end and words[place] != word:
            place += 1
        if place >= end:
            return None
        place += 1
    return place


def _compare(windows: Windows, slop: int):
    def found_in(words: list[bytes], candidates: list[dict]) -> Iterator[tuple[str, int, int, bool]]:
        starts: dict[int, set[int]] = {}
        for candidate in candidates:
            first = windows.words[candidate["window"]][0]
            least, most = max(0, candidate["low"] - slop), min(len(words) - 1, candidate["high"])
            own = [s for s in range(least, most + 1) if words[s] == first]
            starts.setdefault(candidate["window"], set()).update(own)
        spans: dict[str, list[list[int]]] = {}
        near: dict[str, tuple[int, int]] = {}
        for start, window in sorted((s, w) for w, own in starts.items() for s in own):
            phrase = windows.words[window]
            end = near_end(words, phrase, start, slop)
            if end is None:
                continue
            for item in windows.items[window]:
                if end > start + len(phrase):
                    near.setdefault(item, (start, end))
                    continue
                own = spans.setdefault(item, [])
                if own and start <= own[-1][1]:
                    own[-1][1] = max(own[-1][1], end)
                else:
                    own.append([start, end])
        yield from ((item, *span, True) for item, own in spans.items() for span in own)
        yield from ((item, *span, False) for item, span in near.items() if item not in spans)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, candidates = byte_texts(batch.column("text")), batch.column("candidates").to_pylist()
            rows = [
                (row, *match)
                for row, (text, own) in enumerate(zip(texts, candidates, strict=True))
                for match in found_in(ALNUM.findall(text.lower()), own)
            ]
            row, item, start, end, exact = zip(*rows, strict=True) if rows else ((),) * 5
            taken = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(taken),
                    batch.column("content").take(taken),
                    pa.array(item, pa.string()),
                    pa.array(start, pa.int32()),
                    pa.array(end, pa.int32()),
                    pa.array(exact, pa.bool_()),
                ],
                names=[*_DOC, "item_id", "start", "end", "exact"],
            )

    return compare
