"""Shards of near-equal size by longest-processing-time scheduling.

Groups of rows that must stay together go, largest first, to the shard with
the least load, which a heap yields. Groups of one size can change places, so the
schedule takes sizes with their numbers of groups: groups of a size that has many
go to the shards in one step, to which the heap would lead one by one. The groups
are numbered by size, each shard has a run of the numbers of every size, and rows
find their shard by the number of their group. The result is that of the heap over
all groups, whatever their number.

The driver holds one row per size that occurs. Different sizes add up, so there are
fewer of them than the square root of twice all bytes.

Defined results: a null text is as an empty one, without bytes and with crc 0. A group
larger than a shard's fair part fills a shard alone. Repeated rows are rows like others
and get slots of their own. An empty table gives no rows; columns other than the id and
the text are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.operators.joins import dimension_join
from parcelflow.operators.ordered import surrogate_key
from parcelflow.sources import keep, stage

# Groups of one size that the heap deals out one by one; more are dealt out in one step.
ONE_BY_ONE = 64
_GROUP = ["hash1", "hash2"]


def pack(sizes: Sequence[int], shards: int) -> list[int]:
    """Shard of every item, each in turn from the largest going to the least loaded one."""
    heap = [(0, shard) for shard in range(shards)]
    placed = [0] * len(sizes)
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        load, shard = heapq.heappop(heap)
        placed[item] = shard
        heapq.heappush(heap, (load + sizes[item], shard))
    return placed


def schedule(classes: Sequence[tuple[int, int]], shards: int) -> dict[int, list[int]]:
    """How many groups of each size every shard gets; ``classes`` has sizes and numbers of groups."""
    heap, places = [(0, shard) for shard in range(shards)], {}
    for size, groups in sorted(classes, reverse=True):
        given = [0] * shards
        if groups > ONE_BY_ONE:
            loads = [load for load, _ in sorted(heap, key=lambda x: x[1])]
            given = _in_one_step(loads, size, groups)
            heap = [(load + size * n, shard) for shard, (load, n) in enumerate(zip(loads, given))]
            heapq.heapify(heap)
        else:
            for _ in range(groups):
                load, shard = heapq.heappop(heap)
                given[shard] += 1
                heapq.heappush(heap, (load + size, shard))
        places[size] = given
    return places


def _in_one_step(loads: list[int], size: int, groups: int) -> list[int]:
    """What the heap would give each shard: groups go to the least of all loads that shards pass through."""

    def below(level: int) -> list[int]:
        return [max(0, -((load - level) // size)) for load in loads]

    low, high = min(loads), min(loads) + size * groups + 1
    while low < high:  # the highest level below which no more than ``groups`` loads are
        level = (low + high + 1) // 2
        low, high = (level, high) if sum(below(level)) <= groups else (low, level - 1)
    given = below(low)
    rest = groups - sum(given)
    for shard, load in enumerate(loads):
        if rest and load + given[shard] * size == low:
            given[shard] += 1
            rest -= 1
    return given


def assign_shards(docs: DataFrame, shards: int = 16, doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` per row; equal texts share a shard.

    The size of a row is the bytes of its text plus one. Slots number the rows
    of a shard from 0 in the order of group and id.
    """
    text = F.coalesce("text", F.lit(""))
    rows = keep(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).cast("long").alias("text_crc32"),
            F.xxhash64(text).alias("hash1"),
            F.xxhash64(F.octet_length(text), text).alias("hash2"),
        ),
        "sized",
    )
    groups = rows.groupBy(*_GROUP).agg(F.sum("size").alias("group_size"))
    numbered = keep(surrogate_key(groups, "number", ["group_size", *_GROUP]), "groups")
    classes = numbered.groupBy("group_size").agg(
        F.count(F.lit(1)).alias("groups"), F.min("number").alias("first")
    )
    known = classes.collect()  # one row per size
    places = schedule([(c.group_size, c.groups) for c in known], shards)
    # The first number of every shard but the first, and the size they belong to.
    runs = []
    for c in known:
        ends, number = [], c.first
        for n in places[c.group_size][:-1]:
            number += n
            ends.append(number)
        runs.append((c.group_size, ends))
    plan = rows.sparkSession.createDataFrame(runs, "group_size long, ends array<long>")
    dealt = dimension_join(numbered, plan, ["group_size"], "inner", dim_bytes=8 * (shards + 2) * len(runs))
    shard = F.size(F.filter("ends", lambda end: end <= F.col("number"))).cast("int")
    of_group = stage(dealt.select(*_GROUP, shard.alias("shard")), "dealt")
    placed = dimension_join(rows, of_group.df, _GROUP, "inner", dim_bytes=of_group.bytes).select(
        "doc_id", "size", "text_crc32", "shard", *_GROUP
    )
    ordered = surrogate_key(placed, "place", ["shard", *_GROUP, "doc_id"])
    starts = F.broadcast(ordered.groupBy("shard").agg(F.min("place").alias("start")))
    return ordered.join(starts, "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("place") - F.col("start")).cast("long").alias("slot")
    )
