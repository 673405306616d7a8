"""Mixing of sources to target weights by systematic sampling, on built-in functions.

Each source has a target in words, and every document of a source the same
expected number of copies. These are summed up in the order of sizes, one
offset per source is added, and a document is taken once per integer that its
sum crosses. Since neighbours in that order are of like size, the words taken
come near the target.

Defined results: a null or empty text has no words; it takes part in the sums
and adds nothing. A null source is a source of its own, the last one. Repeated
rows are rows like others. An empty table gives no rows. Columns other than the
id, the text and the source pass through ``mix`` and are ignored by
``taken_words``; names with two leading underscores are reserved.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.operators.joins import dimension_join
from parcelflow.operators.ordered import surrogate_key
from parcelflow.sources import keep, stage

WEIGHTS = (3, 1, 2)


def number_of(text: Column) -> Column:
    """A number of 60 bits from the MD5 sum of a text."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, budget: float = 1.5, most: int = 2
) -> DataFrame:
    """``source, source_size, target`` from rows of ``source, size``.

    Sources in the order of code points, null last, take the weights in turn
    and share ``budget`` times all sizes. A target stops at ``most`` times its
    source's size, and what is left is shared anew until none is above.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = surrogate_key(
        totals.withColumn("missing", F.col("source").isNull()), "place", ["missing", "source"]
    )
    turns = F.array(*[F.lit(w) for w in weights])
    weighed = keep(
        ordered.select(
            "source",
            "source_size",
            (F.col("source_size") * most).alias("cap"),
            F.element_at(turns, (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int")).alias("weight"),
        ),
        "weighed",
    )
    wanted = (weighed.agg(F.sum("source_size")).first()[0] or 0) * budget
    full, left, weight = F.lit(False), wanted, None
    while True:
        rest = weighed.agg(
            F.coalesce(F.sum(F.when(full, F.col("cap"))), F.lit(0)).alias("capped"),
            F.sum(F.when(~full, F.col("weight"))).alias("weight"),
        ).first()
        if rest.weight is None or (weight, left) == (rest.weight, wanted - rest.capped):
            break
        weight, left = rest.weight, wanted - rest.capped
        full = F.col("cap") * F.lit(weight) <= F.lit(float(left)) * F.col("weight")
    share = F.lit(float(left)) * F.col("weight") / F.lit(float(weight or 1))
    target = F.when(full, F.col("cap").cast("double")).otherwise(share)
    return weighed.select("source", "source_size", target.alias("target"))


def expected_copies() -> Column:
    return F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)


def with_copies(rows: DataFrame, targets: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Add ``source_size``, ``target`` and the copies taken to rows of id, source and size."""
    tied = rows.withColumns(
        {"missing": F.col("source").isNull(), "tie": number_of(F.col(doc_id).cast("string"))}
    )
    numbered = surrogate_key(tied, "place", ["missing", "source", "size", "tie", doc_id])
    starts = numbered.groupBy("source").agg(F.min("place").alias("start"))
    known = stage(
        targets.join(starts.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s"),
        "targets",
    )
    placed = dimension_join(numbered, known.df, ["source"], null_safe=True, dim_bytes=known.bytes)
    upto = (F.col("place") - F.col("start") + 1).cast("double")
    offset = number_of(F.coalesce("source", F.lit(""))) / F.lit(float(1 << 60))
    crossed = F.floor(upto * expected_copies() + offset) - F.floor(
        (upto - 1) * expected_copies() + offset
    )
    return placed.withColumn("copies", crossed).drop("missing", "tie", "place", "start")


def sized(docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Id, a hash of the content, source and number of words of each document."""
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        _content().alias("content"),
        "source",
        F.coalesce(words, F.lit(0)).cast("long").alias("size"),
    )


def _content() -> Column:
    return F.xxhash64("text", "source")


def taken_words(docs: DataFrame) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every document."""
    rows = keep(sized(docs), "sized")
    mixed = with_copies(rows, source_targets(rows))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def mix(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, budget: float = 1.5, most: int = 2
) -> DataFrame:
    """The documents taken, each as often as it is taken, with the columns they had.

    Rows that agree in id, text and source are taken equally often: the mean of
    their copies, rounded.
    """
    rows = keep(sized(docs), "sized")
    mixed = with_copies(rows, source_targets(rows, weights, budget, most))
    copies = mixed.groupBy("doc_id", "content").agg(F.round(F.avg("copies")).cast("int").alias("__copies"))
    known = stage(
        copies.where("__copies > 0").withColumnsRenamed({"doc_id": "__id", "content": "__content"}),
        "copies",
    )
    keyed = docs.withColumns({"__id": F.col("doc_id"), "__content": _content()})
    taken = dimension_join(
        keyed, known.df, ["__id", "__content"], "inner", null_safe=True, dim_bytes=known.bytes, grouped=True
    )
    repeated = F.explode(F.sequence(F.lit(1), F.col("__copies")))
    return taken.withColumn("__copy", repeated).drop("__id", "__content", "__copies", "__copy")
