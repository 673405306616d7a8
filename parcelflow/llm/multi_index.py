"""Nearest neighbours by largest inner product with an inverted multi-index.

Vectors are cut into two halves and each half is quantised on its own, so a
pair of centroids names a cell. A query walks the cells in the order of the
summed inner products of its halves with the centroids, best pair first, until
the cells hold a share of all entries, and every entry there is reranked. The
share is found on the sample that the centroids are fitted on: there the nearest
are known, and so is how far a walk must go to meet a stated part of them.

Defined results: vectors that are null, zero, of another length than most, or
that hold null or non-finite components take no part, and neither do rows with
a null id. A repeated row counts once. Equal vectors are one entry of the index
with their smallest ids, which loses nothing: no more can be among the nearest.
An id that asks with several vectors has the nearest of all of them. An id that is
there with several vectors counts once, by the best of them.
Empty tables give no rows, and columns other than the two named are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.operators.ordered import surrogate_key
from parcelflow.sources import keep

# Rows of one side that meet in one group; larger cells are cut into blocks of about this size.
BLOCK_ROWS = 4096
# Centroids of a half at most, and vectors of the sample that ask to find the share.
MOST_CENTROIDS, ASKING = 256, 300
_RESULT = "query_id long, rank int, vec_id long, score double"


@dataclass(frozen=True)
class Codebook:
    """Centroids of both halves."""

    first: np.ndarray
    second: np.ndarray

    @property
    def half(self) -> int:
        return self.first.shape[1]


def nearest(
    entries: DataFrame,
    queries: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    k: int = 20,
    centroids: int | None = None,
    share: float | None = None,
    sample_rows: int = 20_000,
    recall: float = 0.95,
) -> DataFrame:
    """The ``k`` entries found for each query, nearest first, ties to the smaller id.

    Both frames have the columns ``vec_id`` and ``vector``; a query never finds
    its own id. The codebook is fitted on at most ``sample_rows`` vectors,
    every vector is indexed, and each query scans the cells that hold at least
    ``share`` of the distinct vectors; by default as many as ``recall`` takes on the
    sample. The number of centroids grows with the table, up to ``MOST_CENTROIDS``.
    """
    spark = entries.sparkSession
    classes = keep(_classes(_usable(entries, vec_id, vector), k + 1), "vectors")
    asked = keep(_usable(queries, vec_id, vector).distinct(), "queries")
    sample = classes.orderBy(F.xxhash64("vec"), "vec").limit(sample_rows).select("vec").toPandas()
    if sample.empty:
        return spark.createDataFrame([], _RESULT)
    lengths = sample["vec"].map(len)
    dims = int(lengths.mode().iloc[0])
    classes, asked = (df.where(F.size("vec") == dims) for df in (classes, asked))
    if centroids is None:
        # About a dozen entries a cell.
        centroids = int(np.clip(round((classes.count() / 12) ** 0.5), 8, MOST_CENTROIDS))
    vectors = np.stack(sample["vec"][lengths == dims].to_list())
    codebook = fit(vectors, centroids)
    if share is None:
        share = needed_share(codebook, vectors, k, recall)

    index = keep(classes.mapInPandas(_cells(codebook), f"{_columns(classes)}, c1 int, c2 int"), "index")
    # At most the square of ``MOST_CENTROIDS`` rows.
    sizes = {(r.c1, r.c2): r["count"] for r in index.groupBy("c1", "c2").count().collect()}
    enough = max(k + 1, share * sum(sizes.values()))

    # Each vector that asks has a number, whichever ids it belongs to.
    distinct = surrogate_key(asked.select("vec").distinct(), "probe", ["vec"])
    # Few bytes, but much work a row: a stated number of tasks is not merged by their bytes.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    probes = keep(
        distinct.select("probe", "vec").repartition(tasks, "probe").mapInPandas(
            _walk(codebook, sizes, enough), "probe long, vec array<double>, c1 int, cells array<int>"
        ),
        "probes",
    )
    asking = {r.c1: r["count"] for r in probes.groupBy("c1").count().collect()}
    held: dict[int, int] = {}
    for (c1, _), n in sizes.items():
        held[c1] = held.get(c1, 0) + n
    blocks = {c1: (_pieces(held.get(c1, 0)), _pieces(asking.get(c1, 0))) for c1 in range(centroids)}

    of_entries, of_probes = ([b[i] for b in blocks.values()] for i in (0, 1))
    left = _dealt(probes, "probe", ("probe_block", of_probes), ("entry_block", of_entries))
    right = _dealt(index, "vec", ("entry_block", of_entries), ("probe_block", of_probes))
    group = ("c1", "entry_block", "probe_block")
    found = (
        left.groupBy(*group)
        .cogroup(right.groupBy(*group))
        .applyInPandas(_score(k), "probe long, score double, ids array<long>")
    )
    # An id that several vectors have counts once, by the best of them.
    scored = found.select("probe", "score", F.explode("ids").alias("vec_id"))
    once = scored.groupBy("probe", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("probe").orderBy(F.desc("score"), "vec_id")
    first = once.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1)
    members = asked.join(distinct, "vec").select(F.col("id").alias("query_id"), "probe")
    nearest_first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        members.join(first, "probe")
        .where(F.col("vec_id") != F.col("query_id"))
        .groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(nearest_first))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def fit(vectors: np.ndarray, centroids: int, rounds: int = 12) -> Codebook:
    """Centroids of both halves of a bounded sample, by Lloyd's rounds from a fixed start."""
    half = (vectors.shape[1] + 1) // 2
    return Codebook(*(_lloyd(part, centroids, rounds) for part in (vectors[:, :half], vectors[:, half:])))


def needed_share(codebook: Codebook, sample: np.ndarray, k: int, recall: float) -> float:
    """Share of the entries that walks through the sample scan to meet ``recall`` of all nearest.

    Some vectors of the sample ask the others; how far a walk goes to the cell of one of their
    nearest is the part of the sample in cells that are no further down.
    """
    if len(sample) < 2:
        return 1.0
    asking = sample[:: max(1, len(sample) // ASKING)]
    own1 = _assign(sample[:, : codebook.half], codebook.first)
    own2 = _assign(sample[:, codebook.half :], codebook.second)
    near1 = asking[:, : codebook.half] @ codebook.first.T
    near2 = asking[:, codebook.half :] @ codebook.second.T
    shares = []
    for row, query in enumerate(asking):
        exact = sample @ query
        # The vector itself is among its own nearest, or not; both are asked for.
        nearest_ones = np.argpartition(-exact, min(k, len(sample) - 1))[: k + 1]
        cells = near1[row][own1] + near2[row][own2]
        shares.append((cells[None, :] >= cells[nearest_ones][:, None]).mean(axis=1))
    return float(np.quantile(np.concatenate(shares), recall))


def _lloyd(points: np.ndarray, centroids: int, rounds: int) -> np.ndarray:
    starts = np.unique(points, axis=0)
    rng = np.random.default_rng(7)
    centres = starts[rng.permutation(len(starts))[:centroids]]
    for _ in range(rounds):
        nearest_centre = _assign(points, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest_centre, points)
        counts = np.bincount(nearest_centre, minlength=len(centres))[:, None]
        centres = np.where(counts > 0, sums / np.maximum(counts, 1), centres)
    return centres


def _assign(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1) - 2 * points @ centres.T).argmin(axis=1)


def _usable(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    vec = F.col(vector).cast("array<double>")
    # NaN compares as the largest double, so one upper bound leaves it out too.
    finite = F.forall("vec", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return (
        df.select(F.col(vec_id).cast("long").alias("id"), vec.alias("vec"))
        .where(F.col("id").isNotNull() & finite & F.exists("vec", lambda x: x != 0))
    )


def _classes(usable: DataFrame, ids: int) -> DataFrame:
    """One row per distinct vector with its smallest ids in order."""
    place = F.dense_rank().over(Window.partitionBy("vec").orderBy("id"))
    first = usable.withColumn("place", place).where(F.col("place") <= ids)
    return first.groupBy("vec").agg(F.sort_array(F.collect_set("id")).alias("ids"))


def _columns(df: DataFrame) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in df.dtypes)


def _pieces(rows: int) -> int:
    return max(1, -(-rows // BLOCK_ROWS))


def _dealt(
    df: DataFrame, key: str, own: tuple[str, list[int]], other: tuple[str, list[int]]
) -> DataFrame:
    """Give each row its block, and one copy for every block of the other side."""

    def of(pieces: list[int]) -> Column:
        return F.element_at(F.array(*[F.lit(n) for n in pieces]), F.col("c1") + 1)

    return df.withColumns(
        {
            own[0]: F.pmod(F.xxhash64(key), of(own[1])).cast("int"),
            other[0]: F.explode(F.sequence(F.lit(0), of(other[1]) - 1)),
        }
    )


def _cells(codebook: Codebook):
    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                vectors = np.stack(batch["vec"].to_list())
                yield batch.assign(
                    c1=_assign(vectors[:, : codebook.half], codebook.first),
                    c2=_assign(vectors[:, codebook.half :], codebook.second),
                )

    return assign


def _walk(codebook: Codebook, sizes: dict[tuple[int, int], int], enough: float):
    width = -(-len(codebook.second) // 8)

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for probe, vector in zip(batch["probe"], batch["vec"], strict=True):
                for c1, bits in cells_in_order(codebook, sizes, enough, np.asarray(vector)).items():
                    data = np.frombuffer(bits.to_bytes(width, "little"), np.uint8)
                    cells = np.flatnonzero(np.unpackbits(data, bitorder="little")).tolist()
                    rows.append((probe, vector, c1, cells))
            yield pd.DataFrame(rows, columns=["probe", "vec", "c1", "cells"])

    return visit


def cells_in_order(
    codebook: Codebook, sizes: dict[tuple[int, int], int], enough: float, query: np.ndarray
) -> dict[int, int]:
    """The second centroids visited with each first one, a bit for each, best sums first.

    The heap holds, for each first centroid reached, its next pair: a pair is
    pushed when the one before it in its row or the head of the row before is
    taken, so pairs leave the heap in the order of their sums.
    """
    near1 = query[: codebook.half] @ codebook.first.T
    near2 = query[codebook.half :] @ codebook.second.T
    rows, columns = np.argsort(-near1, kind="stable"), np.argsort(-near2, kind="stable")
    heap = [(-(near1[rows[0]] + near2[columns[0]]), 0, 0)]
    visited: dict[int, int] = {}
    reached = 0
    while heap and reached < enough:
        _, i, j = heapq.heappop(heap)
        c1, c2 = int(rows[i]), int(columns[j])
        if held := sizes.get((c1, c2)):
            reached += held
            visited[c1] = visited.get(c1, 0) | 1 << c2
        if j + 1 < len(columns):
            heapq.heappush(heap, (-(near1[rows[i]] + near2[columns[j + 1]]), i, j + 1))
        if j == 0 and i + 1 < len(rows):
            heapq.heappush(heap, (-(near1[rows[i + 1]] + near2[columns[0]]), i + 1, 0))
    return visited


def _score(k: int):
    def score(_: tuple, probes: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(probes) and len(entries):
            entries = entries.sort_values("c2", kind="stable", ignore_index=True)
            points = np.stack(entries["vec"].to_list())
            ids = entries["ids"].to_list()
            first_id = np.array([own[0] for own in ids])
            c2 = entries["c2"].to_numpy()
            bounds = [(c, *np.searchsorted(c2, [c, c + 1])) for c in np.unique(c2)]
            for start in range(0, len(probes), 256):
                part = probes.iloc[start : start + 256]
                asked = np.stack(part["vec"].to_list())
                visited = [set(cells) for cells in part["cells"]]
                scores = np.full((len(part), len(points)), -np.inf)
                for c, low, high in bounds:
                    open_to = np.flatnonzero([int(c) in cells for cells in visited])
                    scores[open_to, low:high] = asked[open_to] @ points[low:high].T
                for probe, query, row in zip(part["probe"], asked, scores, strict=True):
                    for place, value in _best(row, query, points, first_id, ids, k + 1):
                        out.append((probe, value, ids[place]))
        return pd.DataFrame(out, columns=["probe", "score", "ids"])

    return score


def _best(
    row: np.ndarray, query: np.ndarray, points: np.ndarray, first_id: np.ndarray, ids: list[np.ndarray], k: int
) -> list[tuple[int, float]]:
    """First places by score and smallest id, until they have ``k`` ids among them.

    Products of a block may differ in their last bit from those of another
    block, so all that could be among the first are summed again one by one.
    """
    scanned, most = np.flatnonzero(row > -np.inf), k
    while True:
        seen = scanned
        if len(seen) > most:
            floor = -np.partition(-row[seen], most - 1)[most - 1]
            seen = seen[row[seen] >= floor - 1e-9 * (1 + abs(floor))]
        exact = (points[seen] * query).sum(axis=1)
        order = np.lexsort((first_id[seen], -exact))[:most]
        chosen = [(int(seen[i]), float(exact[i])) for i in order]
        if len(scanned) <= most or len({i for place, _ in chosen for i in ids[place]}) >= k:
            return chosen
        most *= 4
