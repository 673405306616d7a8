"""Connected components of a graph whose edges are a table.

Two steps alternate until the edges stay as they are: every node hangs its
larger neighbours on the least node among its neighbours and itself, then its
smaller ones. Both keep the components and shorten the paths, and end in stars
whose centres are the least nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.sources import keep, within_scope


def components(edges: DataFrame) -> DataFrame:
    """``doc_id, label``: each node above the least of its component, and that least one.

    ``edges`` has the columns ``one`` and ``other``; an edge to itself counts for nothing. The
    tables of the rounds are deleted, the result alone stays.
    """
    return within_scope(edges.sparkSession, "components", lambda: _stars(edges))


def _stars(edges: DataFrame) -> DataFrame:
    high, low = F.greatest("one", "other"), F.least("one", "other")
    stars = keep(edges.where("one <> other").select(high.alias("node"), low.alias("label")).distinct(), "edges")
    state = _state(stars)
    while True:
        stars = keep(_smaller(_larger(stars)), "edges")
        before, state = state, _state(stars)
        if state == before:
            return stars.select(F.col("node").alias("doc_id"), "label")


def relabelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Add the label of ``doc_id``, which is the id itself where no label is known."""
    known = labels.select(F.col("doc_id").alias("known_id"), F.col("label").alias("known_label"))
    return (
        rows.join(known, F.col("doc_id") == F.col("known_id"), "left")
        .withColumn("label", F.coalesce("known_label", "doc_id"))
        .drop("known_id", "known_label")
    )


def _larger(edges: DataFrame) -> DataFrame:
    both = edges.select("node", "label").union(edges.select("label", "node")).toDF("node", "near")
    least = both.groupBy("node").agg(F.least(F.min("near"), F.first("node")).alias("label"))
    return (
        both.join(least, "node")
        .where("near > node")
        .select(F.col("near").alias("node"), "label")
        .distinct()
    )


def _smaller(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("node").agg(F.min("label").alias("least"))
    moved = edges.join(least, "node").select(
        F.when(F.col("label") == F.col("least"), F.col("node")).otherwise(F.col("label")).alias("node"),
        F.col("least").alias("label"),
    )
    return moved.where("node <> label").distinct()


def _state(edges: DataFrame) -> tuple[int, int, int]:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.xxhash64("node", "label").cast("decimal(38,0)")), F.lit(0)).alias("hashes"),
        F.coalesce(F.bit_xor(F.xxhash64("label", "node")), F.lit(0)).alias("mixed"),
    ).first()
    return row.n, row.hashes, row.mixed
