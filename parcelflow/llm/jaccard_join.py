"""Jaccard join of documents on word n-grams with PartEnum signatures.

Sets are taken in bands of sizes, so that similar sets lie in the same or in
neighbouring bands. Within a pair of bands similar sets differ in at most K
elements. The domain of element hashes is cut into more than K parts; whatever
K elements differ, the two sets are equal on some part, so each subset of one
part, with its number and band, is a signature, and similar sets share one.

Some parts of a set may be empty. The domain has ``spare`` parts beyond K + 1,
so a set with at most ``spare`` empty parts needs no signature of an empty one:
of the parts on which it equals a similar set at least one is not empty. A set
with more empty parts has those signatures too.

Sets that share a signature are candidates. They are not compared all with all:
each is first compared with the most central set of the groups it is in, then only
sets that are not yet connected and differ from it in like ways. Every link between sets of
different components has then been looked for, so the components are exact. Before the
texts of a pair meet, the counts of their elements by ranges of hashes do: sets differ in
at least as many elements as these counts do, which tells most unrelated sets apart.

Defined results: null texts and texts without words have empty sets and no
links. A text shorter than an n-gram is one n-gram. A row without an id has no
component. Ids are whole numbers; others fail. Rows of one id are one document that has
every link any of its texts has. Empty tables give no rows; columns other than the id
and the text are ignored.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from parcelflow.llm.components import components, relabelled
from parcelflow.llm.words import SPACED, byte_texts, chunks, free_name
from parcelflow.operators.joins import BROADCAST_BYTES
from parcelflow.sources import Staged, discard, fresh_dir, keep, stage, within_scope

# Sets of a task whose copies are not signed again.
SEEN_SETS = 200_000
# Bits of a signature: two that are equal by chance only bring a candidate more, and fewer bits are shuffled.
SIGNATURE_BITS = 48
# Counts by the upper bits of elements decide which are frequent.
BUCKET_BITS = 18
BUCKETS = 1 << BUCKET_BITS
# Ranges of hashes whose elements are counted for each set, as a power of two.
LEAST_TALLY_BITS = 7
_ODD = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Similarity:
    """``percent * union <= 100 * intersection`` of sets of ``words``-grams."""

    words: int = 4
    percent: int = 85

    def linked(self, one: np.ndarray, other: np.ndarray) -> bool:
        small, large = sorted((len(one), len(other)))
        if not small or self.percent * large > 100 * small:
            return False
        common = len(np.intersect1d(one, other, assume_unique=True))
        return self.percent * (small + large - common) <= 100 * common

    def largest_partner(self, size: int) -> int:
        return 100 * size // self.percent

    def bands(self, most: int) -> tuple[int, ...]:
        """First size of each band until ``most`` is covered; a partner is in the band or the next."""
        firsts = [1]
        while firsts[-1] <= most:
            firsts.append(self.largest_partner(firsts[-1]) + 1)
        return (*firsts, self.largest_partner(firsts[-1]) + 1)

    def most_difference(self, one: int, other: int) -> int:
        """Most elements in which linked sets of these sizes differ."""
        return (one + other) * (100 - self.percent) // (100 + self.percent)

    def differing(self, last_size: int) -> int:
        """Most elements in which linked sets differ when the smaller has at most ``last_size``."""
        return self.most_difference(last_size, self.largest_partner(last_size))


def ngrams(text: bytes, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-grams of a text in UTF-8."""
    tokens = SPACED.findall(text.lower())
    if not tokens:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxh64_intdigest, tokens), np.uint64, len(tokens))
    width = min(words, len(hashes))
    grams = np.full(len(hashes) - width + 1, width, np.uint64)
    with np.errstate(over="ignore"):
        for place in range(width):
            grams = _mixed(grams * _ODD + hashes[place : place + len(grams)])
    return np.unique(grams)


def _mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers over all of their bits."""
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(29))


def signatures(grams: np.ndarray, similarity: Similarity) -> np.ndarray:
    """Signatures of a set in its own band and as the larger partner in the band before."""
    size = len(grams)
    if not size:
        return np.empty(0, np.uint64)
    firsts = similarity.bands(size)
    own = bisect_right(firsts, size) - 1
    return np.concatenate(
        [
            _in_band(grams, band, similarity.differing(firsts[band + 1] - 1))
            for band in (own, own - 1)
            if band >= 0
        ]
    )


def _in_band(grams: np.ndarray, band: int, differing: int) -> np.ndarray:
    spare = max(1, (differing + 1) // 16) if differing else 0
    parts = differing + 1 + spare
    # The upper bits choose the part, so a sorted set has its parts one after the other.
    part = (grams >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
    starts = np.flatnonzero(np.diff(part, prepend=np.uint64(parts)))
    with np.errstate(over="ignore"):
        sums = np.add.reduceat(_mixed(grams), starts)
        numbers = part[starts]
        if parts - len(starts) > spare:
            empty = np.setdiff1d(np.arange(parts, dtype=np.uint64), numbers)
            numbers, sums = np.append(numbers, empty), np.append(sums, np.zeros(len(empty), np.uint64))
        place = _mixed(numbers * _ODD + np.uint64(band))
        return _mixed(_mixed(sums + place) * _ODD + place) >> np.uint64(64 - SIGNATURE_BITS)


def linked_documents(
    docs: DataFrame, similarity: Similarity = Similarity(), doc_id: str = "doc_id"
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row.

    What is written on the way is deleted, each table as soon as it is used up.
    """
    texts = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    return within_scope(docs.sparkSession, "linked", lambda: _linked(texts, similarity))


def _linked(texts: DataFrame, similarity: Similarity) -> DataFrame:
    spark, passing = texts.sparkSession, fresh_dir(texts.sparkSession, "jaccard")
    sets = keep(
        texts.mapInArrow(
            _measure_sets(similarity),
            "doc_id long, n_shingles long, print1 long, print2 long, tallies binary",
        ),
        "sets",
    )
    full = sets.where("n_shingles > 0 AND doc_id IS NOT NULL")
    first = full.groupBy("print1", "print2").agg(F.min("doc_id").alias("label"))
    copies = keep(
        full.select("doc_id", "print1", "print2")
        .join(first, ["print1", "print2"])
        .where("doc_id > label")
        .select("doc_id", "label"),
        "copies",
    )
    # An id with several texts is signed whole: only one of its texts is the copy.
    several = full.groupBy("doc_id").agg(
        (F.min("print1") < F.max("print1")).alias("first"), (F.min("print2") < F.max("print2")).alias("second")
    ).where("first OR second")
    gone = stage(copies.join(several, "doc_id", "left_anti").select("doc_id").distinct(), "signed-elsewhere")
    to_sign = texts.where("doc_id IS NOT NULL").join(_small(gone), "doc_id", "left_anti")
    shared = _shared_signatures(to_sign, similarity, passing)
    edges = [copies.select(F.col("doc_id").alias("one"), F.col("label").alias("other"))]
    labels, tested = copies, None
    remaining = partial(_remaining_pairs, texts=texts, passing=passing)
    for number, choice in enumerate((_central_pairs, _leader_pairs, remaining)):
        base = f"{passing}/{number}"
        pairs = keep(_untested(choice(relabelled(shared, labels), similarity), tested), "pairs", base=base)
        near = keep(_near_pairs(full, pairs, similarity), "near", base=base)
        found = keep(_verified(texts, near, similarity, base), "links", base=base)
        discard(spark, f"{base}/texts")
        edges.append(found)
        tested = pairs if tested is None else tested.unionByName(pairs)
        labels = components(_all(edges))
    return sets.join(labels, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("label", "doc_id").alias("component_id")
    )


def first_of_each(docs: DataFrame, similarity: Similarity = Similarity()) -> DataFrame:
    """One document of each component, with all its columns: that with the smallest id.

    Ids are of any type that has an order; rows without one come after all others. Of rows that
    repeat id and text, the first in the order of their JSON stays. Documents without words stay.
    """
    row, gone, again = (free_name(docs, name) for name in ("__row", "__gone", "__again"))
    keyed = docs.withColumn(row, F.xxhash64("doc_id", "text"))
    linked = keep(linked_documents(keyed.select(row, "text"), similarity, row).distinct(), "linked")
    owners = keyed.select(F.col(row).alias("owner"), "doc_id")
    rank = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "owner")
    worded = linked.where("n_shingles > 0").select(F.col("doc_id").alias("key"), "component_id")
    best = (
        worded.join(owners, F.col("key") == F.col("owner"))
        .groupBy("component_id")
        .agg(F.min(rank).alias("best"))
    )
    not_first = worded.join(best, "component_id").where(F.col("key") != F.col("best.owner"))
    others = stage(not_first.select(F.col("key").alias(gone)), "others")
    left = keyed.join(_small(others), F.col(row) == F.col(gone), "left_anti")
    # Rows that repeat id and text are one document as well.
    counts = keyed.groupBy(F.col(row).alias(again)).count().where("count > 1").select(again)
    repeated = stage(counts.join(worded, F.col(again) == F.col("key"), "left_semi"), "repeated")
    if not repeated.rows:
        return left.drop(row)
    several = left.join(_small(repeated), F.col(row) == F.col(again), "left_semi").drop(row)
    columns = F.struct(*[f"`{c}`" for c in docs.columns])
    single = several.groupBy("doc_id", "text").agg(F.min_by(columns, F.to_json(columns)).alias("row"))
    once = left.join(_small(repeated), F.col(row) == F.col(again), "left_anti").drop(row)
    return once.unionByName(single.select("row.*"))


def _small(table: Staged) -> DataFrame:
    """The table, broadcast if it is small enough."""
    return F.broadcast(table.df) if table.bytes <= BROADCAST_BYTES else table.df


def _all(frames: list[DataFrame]) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def _shared_signatures(texts: DataFrame, similarity: Similarity, passing: str) -> DataFrame:
    """``signature, doc_id, size, members, weight`` of those that two or more documents have.

    ``weight`` adds up the members of all groups of a document: the set in the
    middle of many near copies has the largest. Signatures are shuffled once; all that is asked of
    their groups is asked where they have come together.
    """
    signed = texts.mapInArrow(_sign(similarity), "signature long, doc_id long, size int")
    group = Window.partitionBy("signature")
    met = (
        signed.withColumns({"least": F.min("doc_id").over(group), "most": F.max("doc_id").over(group)})
        .where("least < most")
        .select("signature", "doc_id", "size")
        # Rows that repeat an id and a text may have been signed in several tasks.
        .distinct()
    )
    counted = keep(met.withColumn("members", F.count(F.lit(1)).over(group)), "groups", base=passing)
    weights = counted.groupBy("doc_id").agg(F.sum("members").alias("weight"))
    weighed = keep(counted.join(weights, "doc_id"), "weighed", base=passing)
    discard(texts.sparkSession, f"{passing}/groups")
    return weighed


def _leaders(labelled: DataFrame) -> DataFrame:
    """The most central document of each group that is not yet in one component."""
    central = F.struct("weight", (-F.col("doc_id")).alias("turned"), "doc_id", "label", "size")
    return (
        labelled.groupBy("signature")
        .agg(F.max(central).alias("leader"), F.min("label").alias("low"), F.max("label").alias("high"))
        .where("low < high")
    )


def _with_leaders(labelled: DataFrame, similarity: Similarity) -> DataFrame:
    return labelled.join(_leaders(labelled), "signature").where(
        (F.col("leader.label") != F.col("label"))
        & _near_size(F.col("size"), F.col("leader.size"), similarity)
    )


def _near_size(one, other, similarity: Similarity):
    return F.greatest(one, other) * similarity.percent <= F.least(one, other) * 100


def _pair(one, other):
    return [F.least(one, other).alias("one"), F.greatest(one, other).alias("other")]


def _central_pairs(labelled: DataFrame, similarity: Similarity) -> DataFrame:
    """Each document with the most central of its leaders."""
    led = _with_leaders(labelled, similarity)
    best = led.groupBy("doc_id").agg(F.max("leader").alias("leader"))
    return best.select(*_pair(F.col("doc_id"), F.col("leader.doc_id"))).distinct()


def _leader_pairs(labelled: DataFrame, similarity: Similarity) -> DataFrame:
    """Each document with all of its leaders in other components."""
    led = _with_leaders(labelled, similarity)
    return led.select(*_pair(F.col("doc_id"), F.col("leader.doc_id"))).distinct()


def _remaining_pairs(
    labelled: DataFrame, similarity: Similarity, texts: DataFrame, passing: str
) -> DataFrame:
    """Documents of different components that share a group and enough differences to its leader.

    Both have been compared with the leader of the group. The difference of two
    sets is what only one of their differences to the leader holds, so linked
    sets of other components have at least ``need`` differences in common, and
    one of these is early enough in both when differences are put in any one
    order. Elements that the leader does not have come first: those of unrelated
    sets that share a passage with it are their own, whereas what they lack of the
    leader is the same for all. Of the former, and of the latter, those come first that
    few open documents have, so that other frequent passages come late as well.

    A cell is a hash of a leader and one difference to it; two that collide
    only add a pair that is then found not to be linked. Leaders are taken in batches, so that
    what is shuffled and written at once grows with the sets, not with the pairs of sets and leaders.
    """
    spark = texts.sparkSession
    leaders = _leaders(labelled).select("signature", F.col("leader.doc_id").alias("leader"))
    group = Window.partitionBy("signature")
    # All pairs with the leader are done: a group is open if its other members are not in one component.
    others = (
        labelled.join(leaders, "signature")
        .where("doc_id <> leader")
        .withColumns({"low": F.min("label").over(group), "high": F.max("label").over(group)})
        .where("low < high")
    )
    members = keep(others.select("leader", "doc_id", "label", "size").distinct(), "members", base=passing)
    known = _needed_texts(texts, members.select(F.explode(F.array("leader", "doc_id"))), passing)
    reduced = keep(known.mapInArrow(_reduce(similarity), "known_id long, values binary"), "reduced", base=passing)
    counts = np.zeros(BUCKETS, np.int64)
    tallied = reduced.mapInArrow(_count_values, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for row in keep(tallied, "tallied", base=passing).collect():  # at most BUCKETS rows
        counts[row.bucket] = row.n
    discard(spark, f"{passing}/texts")
    batches = _leader_batches(members, reduced)
    held, central = _with_own_leaders(members, reduced, passing)
    discard(spark, f"{passing}/reduced")
    rows = _all([
        _met_places(held, central, similarity, counts, (number, batches), passing) for number in range(batches)
    ])
    discard(spark, f"{passing}/held")
    partners = rows.select(
        "cell", *[F.col(c).alias(f"other_{c}") for c in ("doc_id", "label", "size", "differing", "place")]
    )
    most = F.floor(
        (F.col("size") + F.col("other_size")) * (100 - similarity.percent) / (100 + similarity.percent)
    )
    need = F.greatest(
        F.lit(1), F.ceil((F.col("differing") + F.col("other_differing") - most) / 2)
    )
    return (
        rows.join(partners, "cell")
        .where(
            (F.col("doc_id") < F.col("other_doc_id"))
            & (F.col("label") != F.col("other_label"))
            & _near_size(F.col("size"), F.col("other_size"), similarity)
            & (F.col("place") <= F.col("differing") - need + 1)
            & (F.col("other_place") <= F.col("other_differing") - need + 1)
        )
        .select(F.col("doc_id").alias("one"), F.col("other_doc_id").alias("other"))
        .distinct()
    )


def _leader_batches(members: DataFrame, reduced: DataFrame) -> int:
    """So many batches of leaders that one takes about as many elements as there are in all sets.

    A set is looked at once for each of its leaders, and sets of larger tables have more of them.
    """
    asked = members.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first().n
    known = reduced.agg(F.coalesce(F.sum(F.octet_length("values")), F.lit(0)).alias("n")).first().n // 4
    return max(1, -(-asked // max(1, known)))


def _with_own_leaders(members: DataFrame, reduced: DataFrame, base: str) -> tuple[DataFrame, DataFrame]:
    """``doc_id, leaders, values`` of each member, and ``leader, leader_values``.

    A set has no more leaders than signatures, so they fit in its row.
    """
    known = F.struct("leader", "label", "size")
    led = members.groupBy("doc_id").agg(F.collect_list(known).alias("leaders"))
    own = reduced.select(F.col("known_id").alias("doc_id"), "values")
    central = reduced.join(
        members.select(F.col("leader").alias("known_id")).distinct(), "known_id", "left_semi"
    ).select(F.col("known_id").alias("leader"), F.col("values").alias("leader_values"))
    return keep(led.join(own, "doc_id"), "held", base=base), keep(central, "central", base=base)


def _met_places(
    held: DataFrame,
    central: DataFrame,
    similarity: Similarity,
    counts: np.ndarray,
    batch: tuple[int, int],
    base: str,
) -> DataFrame:
    """Differences of one batch of leaders that sets of several components have.

    Cells hold one leader each, so those of different batches never meet.
    """
    number, batches = batch

    def in_batch(leader):
        return F.pmod(F.xxhash64(leader), F.lit(batches)) == number

    mine = F.filter("leaders", lambda led: in_batch(led["leader"]))
    members = held.select("doc_id", "values", F.explode(mine).alias("led")).select("doc_id", "values", "led.*")
    placed = keep(
        members.join(central.where(in_batch("leader")), "leader").mapInArrow(
            _in_order(similarity, counts),
            "leader long, value long, doc_id long, label long, size int, differing int, place int",
        ).select(F.xxhash64("leader", "value").alias("cell"), "doc_id", "label", "size", "differing", "place"),
        "places",
        base=base,
    )
    labels = placed.groupBy("cell").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    met = stage(labels.where("low < high").select("cell"), f"met-{number}", base)
    rows = keep(placed.join(_small(met), "cell", "left_semi"), f"met-places-{number}", base=base)
    discard(held.sparkSession, f"{base}/places")
    discard(held.sparkSession, f"{base}/met-{number}")
    return rows


def _untested(pairs: DataFrame, tested: DataFrame | None) -> DataFrame:
    return pairs if tested is None else pairs.join(tested, ["one", "other"], "left_anti")


def _needed_texts(texts: DataFrame, ids: DataFrame, base: str) -> DataFrame:
    """``known_id, text`` of the documents whose ids are in the one column of ``ids``."""
    needed = stage(ids.toDF("needed").distinct(), "needed", base)
    rows = texts.join(_small(needed), F.col("doc_id") == F.col("needed"), "left_semi")
    return keep(rows.select(F.col("doc_id").alias("known_id"), "text"), "texts", base=base)


def _near_pairs(sets: DataFrame, pairs: DataFrame, similarity: Similarity) -> DataFrame:
    """The pairs whose tallies do not show that they differ in too many elements."""
    one, other = (
        sets.select(*[F.col(c).alias(f"{side}{c}") for c in ("doc_id", "n_shingles", "tallies")])
        for side in ("one_", "other_")
    )
    known = pairs.join(one, F.col("one") == F.col("one_doc_id")).join(other, F.col("other") == F.col("other_doc_id"))
    asked = known.select("one", "other", "one_n_shingles", "other_n_shingles", "one_tallies", "other_tallies")
    return asked.mapInArrow(_close(similarity), "one long, other long").distinct()


def _verified(texts: DataFrame, pairs: DataFrame, similarity: Similarity, base: str) -> DataFrame:
    """The pairs that are linked, by comparing their sets."""
    known = _needed_texts(texts, pairs.select(F.explode(F.array("one", "other"))), base)
    one = known.select(F.col("known_id").alias("one"), F.col("text").alias("one_text"))
    other = known.select(F.col("known_id").alias("other"), F.col("text").alias("other_text"))
    compared = pairs.join(other, "other").join(one, "one")
    return compared.mapInArrow(_compare(similarity), "one long, other long").distinct()


def _measure_sets(similarity: Similarity):
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, prints, tallies = [], [], []
            for text in byte_texts(batch.column("text")):
                grams = ngrams(text, similarity.words)
                sizes.append(len(grams))
                prints.append(_fingerprint(grams))
                tallies.append(_tallies(grams).tobytes())
            columns = np.array(prints, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(columns[:, 0]),
                    pa.array(columns[:, 1]),
                    pa.array(tallies, pa.binary()),
                ],
                names=["doc_id", "n_shingles", "print1", "print2", "tallies"],
            )

    return measure


def _fingerprint(grams: np.ndarray) -> tuple[int, int]:
    raw = grams.tobytes()
    return xxh64_intdigest(raw, 1), xxh64_intdigest(raw, 2)


def _sign(similarity: Similarity):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in (piece for whole in batches for piece in chunks([whole], "text")):
            ids, signed, sizes, counts = [], [], [], []
            for doc_id, text in zip(
                batch.column("doc_id").to_pylist(), byte_texts(batch.column("text")), strict=True
            ):
                grams = ngrams(text, similarity.words)
                own = _fingerprint(grams)
                if not len(grams) or own in seen:
                    continue
                if len(seen) >= SEEN_SETS:
                    seen.clear()
                seen.add(own)
                signed.append(signatures(grams, similarity))
                ids.append(doc_id)
                sizes.append(len(grams))
                counts.append(len(signed[-1]))
            if ids:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(signed).view(np.int64)),
                        pa.array(np.repeat(np.array(ids, np.int64), counts)),
                        pa.array(np.repeat(np.array(sizes, np.int32), counts)),
                    ],
                    names=["signature", "doc_id", "size"],
                )

    return sign


def _tallies(grams: np.ndarray) -> np.ndarray:
    """Number of elements in each of equal ranges of hashes, 255 at most; larger sets have more ranges."""
    bits = max(LEAST_TALLY_BITS, (len(grams) // 4).bit_length())
    counts = np.bincount((grams >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return np.minimum(counts, 255).astype(np.uint8)


def least_difference(one: np.ndarray, other: np.ndarray) -> int:
    """Elements in which sets with these tallies differ at the least."""
    small, large = sorted((one.astype(np.int64), other.astype(np.int64)), key=len)
    if len(small) < len(large):
        # A full count may stand for more, so a range that holds one says nothing.
        parts = large.reshape(len(small), -1)
        sums, full = parts.sum(axis=1), (parts == 255).any(axis=1) | (small == 255)
        return int(np.abs(sums - small)[~full].sum())
    return int(np.abs(large - small).sum())


def _close(similarity: Similarity):
    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [batch.column(c).to_pylist() for c in ("one_n_shingles", "other_n_shingles")]
            tallies = [batch.column(c).to_pylist() for c in ("one_tallies", "other_tallies")]
            kept = [
                least_difference(np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8))
                <= similarity.most_difference(m, n)
                for m, n, a, b in zip(*sizes, *tallies, strict=True)
            ]
            yield batch.select(["one", "other"]).filter(pa.array(kept, pa.bool_()))

    return close


def _reduce(similarity: Similarity):
    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for whole in batches for piece in chunks([whole], "text")):
            values = [
                np.unique((ngrams(text, similarity.words) >> np.uint64(32)).astype(np.uint32)).tobytes()
                for text in byte_texts(batch.column("text"))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("known_id"), pa.array(values, pa.binary())], names=["known_id", "values"]
            )

    return reduce


def _bucket(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint32(32 - BUCKET_BITS)).astype(np.int64)


def _count_values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many sets of a task have elements of each bucket."""
    counts = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for values in batch.column("values").to_pylist():
            np.add.at(counts, _bucket(np.frombuffer(values, np.uint32)), 1)
    seen = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(seen.astype(np.int32)), pa.array(counts[seen])], names=["bucket", "n"]
    )


def _in_order(similarity: Similarity, counts: np.ndarray):
    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The differences to the leader that can be early enough for a partner, own and rare elements first."""
        # Each row becomes many, so few are taken at once.
        for batch in (whole.slice(start, 500) for whole in batches for start in range(0, whole.num_rows, 500)):
            chosen, places, taken, totals = [], [], [], []
            sets = (batch.column(c).to_pylist() for c in ("size", "values", "leader_values"))
            for size, *values in zip(*sets, strict=True):
                own, leader = (np.frombuffer(v, np.uint32) for v in values)
                extra, lacked = (np.setdiff1d(a, b, assume_unique=True) for a, b in ((own, leader), (leader, own)))
                first = np.concatenate(
                    [part[np.lexsort((part, counts[_bucket(part)]))] for part in (extra, lacked)]
                )[: similarity.differing(size) + 1]
                chosen.append(first.astype(np.int64))
                places.append(np.arange(1, len(first) + 1, dtype=np.int32))
                taken.append(len(first))
                totals.append(len(extra) + len(lacked))
            rows = pa.array(np.repeat(np.arange(len(taken)), taken))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("leader").take(rows),
                    pa.array(np.concatenate([*chosen, np.empty(0, np.int64)])),
                    *[batch.column(n).take(rows) for n in ("doc_id", "label", "size")],
                    pa.array(np.array(totals, np.int32)).take(rows),
                    pa.array(np.concatenate([*places, np.empty(0, np.int32)])),
                ],
                names=["leader", "value", "doc_id", "label", "size", "differing", "place"],
            )

    return order


def _compare(similarity: Similarity):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_id, last = None, np.empty(0, np.uint64)
        for batch in batches:
            linked = []
            rows = zip(
                batch.column("one").to_pylist(),
                byte_texts(batch.column("one_text")),
                byte_texts(batch.column("other_text")),
                strict=True,
            )
            for one, text, other in rows:
                if (one, text) != last_id:
                    last_id, last = (one, text), ngrams(text, similarity.words)
                linked.append(similarity.linked(last, ngrams(other, similarity.words)))
            kept = batch.select(["one", "other"]).filter(pa.array(linked, pa.bool_()))
            yield kept

    return compare
