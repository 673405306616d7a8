"""Spelling variants: words one edit apart, found by dense prefix-suffix tiling.

Two words are one edit apart if the lengths of their common prefix and common
suffix together reach the longer length minus one. That is asked of whole blocks:
words stand as rows of a padded matrix of code points, left-aligned and reversed,
and a block is compared with the block of its partners cell by cell.

Only words of one tile are compared. The places at which the edit of a pair can be
are cut into tiles; for an edit in the tile from ``lo`` to ``hi`` both words have
their first ``lo`` code points and those behind the tile in common, so that prefix
and suffix are the key of the tile. A pair counts in the tile that holds the first
place its edit can be at, so it counts once. A tile whose key has more than ``block``
words is cut into smaller tiles, whose keys are longer; with one place left a key
has at most two words for each letter. No task gets more, and nothing is left out.

Each block returns one row per word, with the number of near words and the best of
them, never a pair.

Defined results: a null text has no words, a null id counts as an empty one.
Repeated rows count as often as they are there. Words below ``min_length`` or
``min_count``, and empty tables, give no rows. Columns other than the id and the
text are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.operators.joins import BROADCAST_BYTES, dimension_join
from parcelflow.sources import discard, fresh_dir, keep, stage

# Words of a key that are compared with each other; more are cut into smaller tiles.
BLOCK = 1024
# Tiles that the places of an edit are first cut into, and that a crowded tile is cut into.
TILES = 3
# Different words a task counts before it hands the counts on.
COUNTED_WORDS = 300_000
# Cells of a matrix of code points, and pairs compared at once.
CELLS, PAIRS = 8 << 20, 1 << 16

# Letters are A-Z, a-z and U+00C0 to U+00FF, which Latin-1 holds as one byte each.
_LETTERS = bytes(
    byte + 32 if 65 <= byte <= 90 else byte if 97 <= byte <= 122 or byte >= 0xC0 else 32
    for byte in range(256)
)


def counted_words(
    docs: DataFrame, doc_id: str = "doc_id", one_in: int = 97, min_length: int = 5, min_count: int = 3
) -> DataFrame:
    """``word, n``: runs of letters in lower case, some of them without one letter.

    A run loses the code point ``h % length`` if ``one_in`` divides ``h``, the crc32 of
    ``<id>:<run>``.
    """
    texts = docs.select(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.coalesce("text", F.lit("")).alias("text")
    )
    counts = texts.mapInArrow(_count(one_in, min_length), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def variants(words: DataFrame, ratio: int = 2, block: int = BLOCK) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every row of ``words`` (``word, n``; each word once).

    The form of a word is its near word of largest ``n``, the first in the order of code
    points among equals, if that ``n`` is at least ``ratio`` times the word's. Since ``n``
    grows along forms, following them ends; the root is the word they end in.
    """
    spark, passing = words.sparkSession, fresh_dir(words.sparkSession, "spelling")
    counted = keep(words.select("word", "n"), "words", base=passing)
    near = keep(_near_words(counted, block, passing), "near", base=passing)
    best = near.groupBy(F.col("word").alias("near_word")).agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct("turned", "best")).alias("best")
    )
    is_form = F.col("best.turned") * -1 >= F.col("n") * ratio
    known = keep(
        counted.join(best, F.col("word") == F.col("near_word"), "left").select(
            "word",
            F.when(is_form, F.col("best.best")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(is_form, F.col("best.turned") * -1).alias("form_n"),
        ),
        "variants",
    )
    roots = _roots(known.where("form IS NOT NULL").select("word", F.col("form").alias("root")), passing)
    discard(spark, passing)
    rooted = known.join(roots.withColumnRenamed("word", "rooted"), F.col("word") == F.col("rooted"), "left")
    return rooted.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _count(one_in: int, min_length: int):
    def tables(counts: Counter) -> Iterator[pa.RecordBatch]:
        kept = [word for word in counts if len(word) >= min_length]
        for start in range(0, len(kept), 50_000):
            part = kept[start : start + 50_000]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([word.decode("latin-1") for word in part], pa.string()),
                    pa.array([counts[word] for word in part], pa.int64()),
                ],
                names=["word", "n"],
            )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for doc_id, text in zip(
                batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True
            ):
                # What Latin-1 lacks becomes a question mark, which parts runs as well.
                runs = Counter(text.encode("latin-1", "replace").translate(_LETTERS).split())
                start = crc32(f"{doc_id}:".encode())
                for run, n in runs.items():
                    h = crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
                    if not h % one_in:
                        gone = h % len(run)
                        run = run[:gone] + run[gone + 1 :]
                    counts[run] += n
                if len(counts) >= COUNTED_WORDS:
                    yield from tables(counts)
                    counts.clear()
        yield from tables(counts)

    return count


def _near_words(counted: DataFrame, block: int, passing: str) -> DataFrame:
    """``word, n_near, turned, best``: near words of a word in each tile, the best with its ``-n``."""
    rows, found, level = _first_tiles(counted), [], 0
    while True:
        tiles = keep(_keyed(rows), "tiles", base=f"{passing}/{level}")
        members = tiles.groupBy("key").agg(F.count(F.lit(1)).alias("members"))
        crowded = stage(members.where(F.col("members") > block).select("key"), "crowded", f"{passing}/{level}")
        side = F.broadcast(crowded.df) if crowded.bytes <= BROADCAST_BYTES else crowded.df
        # One place more cannot be cut; its keys have few words as it is.
        is_cut = F.col("hi") - F.col("lo") > 1
        small = tiles.join(side, "key", "left_anti") if crowded.rows else tiles
        whole = [small]
        if crowded.rows:
            large = tiles.join(side, "key", "left_semi")
            whole.append(large.where(~is_cut))
        compared = whole[0] if len(whole) == 1 else whole[0].unionByName(whole[1])
        ordered = compared.repartition("key").sortWithinPartitions("reach", "uneven", "lo", "hi", "key")
        found.append(ordered.mapInArrow(_compare_tiles, "word string, n_near long, turned long, best string"))
        if not crowded.rows:
            break
        rows, level = _smaller_tiles(large.where(is_cut)), level + 1
    result = found[0]
    for frame in found[1:]:
        result = result.unionByName(frame)
    return result


def _first_tiles(counted: DataFrame) -> DataFrame:
    """Tiles of each word for partners as long, one longer and one shorter."""
    length = F.length("word")
    kinds = F.array(
        F.struct(F.lit(0).alias("uneven"), (length - 1).alias("reach")),
        F.struct(F.lit(1).alias("uneven"), length.alias("reach")),
        F.struct(F.lit(1).alias("uneven"), (length - 1).alias("reach")),
    )
    rows = counted.select("word", "n", F.explode(kinds).alias("kind")).select("word", "n", "kind.*")
    return _cut(rows, F.lit(0), F.col("reach") + 1)


def _smaller_tiles(tiles: DataFrame) -> DataFrame:
    return _cut(tiles, F.col("lo"), F.col("hi"))


def _cut(rows: DataFrame, first: Column, last: Column) -> DataFrame:
    """Rows once for each part of their places."""
    bounds = [first + F.floor((last - first) * part / TILES).cast("int") for part in range(TILES + 1)]
    parts = F.array(
        *[F.struct(a.alias("lo"), b.alias("hi")) for a, b in zip(bounds, bounds[1:])]
    )
    cut = rows.select("word", "n", "uneven", "reach", F.explode(parts).alias("part"))
    return cut.select("word", "n", "uneven", "reach", "part.*").where("lo < hi")


def _keyed(tiles: DataFrame) -> DataFrame:
    """Add a hash of the kind of a tile, and of the word before and behind it."""
    return tiles.withColumn(
        "key",
        F.xxhash64(
            "uneven", "reach", "lo", "hi", F.expr("left(word, lo)"), F.expr("right(word, reach + 1 - hi)")
        ),
    )


def _compare_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words within each run of rows of one key; a run may go on in the next batch."""
    rest: pa.RecordBatch | None = None
    for batch in batches:
        rows = batch if rest is None else _joined(rest, batch)
        keys = rows.column("key").to_numpy()
        # Keys are not in order, but rows of one key are neighbours.
        changes = np.flatnonzero(keys[1:] != keys[:-1])
        end = int(changes[-1]) + 1 if len(changes) else 0
        if end:
            yield from _compare_runs(rows.slice(0, end))
        rest = rows.slice(end)
    if rest is not None and rest.num_rows:
        yield from _compare_runs(rest)


def _joined(one: pa.RecordBatch, other: pa.RecordBatch) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.concat_arrays([a, b]) for a, b in zip(one.columns, other.columns)], schema=other.schema
    )


def _compare_runs(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Cut rows into blocks of whole runs whose matrix is not too large."""
    keys = rows.column("key").to_numpy()
    starts = np.append(np.flatnonzero(np.diff(keys, prepend=~keys[:1])), len(keys))
    # A word alone with its key has no partner.
    alone = np.diff(starts) == 1
    widths = rows.column("reach").to_numpy() + 1
    first = 0
    while first < len(starts) - 1:
        last = first + 1
        while last < len(starts) - 1 and (starts[last + 1] - starts[first]) * int(widths[starts[last]]) <= CELLS:
            last += 1
        block = np.arange(starts[first], starts[last])[~np.repeat(alone[first:last], np.diff(starts[first : last + 1]))]
        if len(block):
            yield from _near_in_block(rows.take(pa.array(block)))
        first = last


def _near_in_block(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    words = [word.encode("latin-1") for word in rows.column("word").to_pylist()]
    keys, n = rows.column("key").to_numpy(), rows.column("n").to_numpy()
    uneven, reach, lo, hi = (rows.column(c).to_numpy() for c in ("uneven", "reach", "lo", "hi"))
    lengths = np.array([len(word) for word in words])
    width = int(lengths.max())
    forward, backward = _matrix(words, width), _matrix([word[::-1] for word in words], width)
    # Of two near words the one of more occurrences is better, then the first in order.
    text = np.array(words)
    by_text = np.argsort(np.argsort(text, kind="stable"), kind="stable")
    order = np.lexsort((-by_text, n))
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    near, best = np.zeros(len(words), np.int64), np.full(len(words), -1, np.int64)
    shift = 1
    while len(both := np.flatnonzero(keys[:-shift] == keys[shift:])):
        for start in range(0, len(both), max(1, min(PAIRS, CELLS // width))):
            one = both[start : start + max(1, min(PAIRS, CELLS // width))]
            other = one + shift
            prefix = _common(forward[one], forward[other])
            suffix = _common(backward[one], backward[other])
            place = np.maximum(reach[one] - suffix, 0)
            found = (
                (prefix + suffix >= reach[one])
                & ((lengths[one] != lengths[other]) == (uneven[one] == 1))
                & (lo[one] <= place)
                & (place < hi[one])
            )
            one, other = one[found], other[found]
            near += np.bincount(one, minlength=len(near)) + np.bincount(other, minlength=len(near))
            np.maximum.at(best, one, rank[other])
            np.maximum.at(best, other, rank[one])
        shift += 1
        if shift >= len(keys):
            break
    met = np.flatnonzero(near)
    if len(met):
        choice = order[best[met]]
        column = rows.column("word")
        yield pa.RecordBatch.from_arrays(
            [
                column.take(pa.array(met)),
                pa.array(near[met]),
                pa.array(-n[choice]),
                column.take(pa.array(choice)),
            ],
            names=["word", "n_near", "turned", "best"],
        )


def _matrix(words: list[bytes], width: int) -> np.ndarray:
    """One row of code points per word, padded with zeros."""
    return np.frombuffer(b"".join(word.ljust(width, b"\0") for word in words), np.uint8).reshape(-1, width)


def _common(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Length of the common beginning of each pair of rows."""
    differs = one != other
    first = differs.argmax(axis=1)
    return np.where(differs[np.arange(len(differs)), first], first, one.shape[1])


def _roots(links: DataFrame, passing: str) -> DataFrame:
    """``word, root`` at the end of the links of each word; each round doubles how far they reach."""
    links, number = stage(links, "links", f"{passing}/roots-0"), 0
    while True:
        number += 1
        further = links.df.select(F.col("word").alias("root"), F.col("root").alias("further"))
        jumped = dimension_join(links.df, further, ["root"], "left", dim_bytes=links.bytes)
        moved = stage(
            jumped.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
            "links",
            f"{passing}/roots-{number}",
        )
        if moved.df.where("moved").isEmpty():
            return keep(moved.df.select("word", "root"), "roots")
        links = stage(moved.df.select("word", "root"), "jumped", f"{passing}/roots-{number}")
