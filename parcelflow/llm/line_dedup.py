"""Lines that many documents share, found without moving text, on built-in functions.

Hashes of the lines are range-partitioned and sorted by document and position.
The stream of a range tells the first occurrence of a line in each document,
and the first of all. What comes back per document is the bitmap of the lines
it keeps, as the 64-bit words in which a line goes; a document without such a
word keeps all its lines.

Defined results: a null or empty text is one empty line. A key of fewer code
points than ``min_chars`` stays. A document is an id with its text: rows that
repeat both count once and get the same result, and rows of one id with other
texts are other documents. An empty table gives no rows. Columns other than the
id and the text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.llm.words import lowered
from parcelflow.operators.joins import dimension_join
from parcelflow.sources import keep, stage

_DOC = ("doc_id", "content")
_LINE = ("hash1", "hash2")


def line_key(line: Column) -> Column:
    """The line without white space at both ends, A-Z in lower case."""
    return lowered(F.trim(line, F.lit(" \t\n\x0b\x0c\r")))


def keep_bitmaps(
    docs: DataFrame, min_docs: int = 10, min_chars: int = 1, policy: str = "none"
) -> DataFrame:
    """``doc_id, content, n_dropped, words`` of the documents that lose a line.

    ``policy`` says what remains of a line found in ``min_docs`` documents:
    'none', or the 'first' occurrence by id, content and position. ``words`` maps
    the number of a 64-bit word to its kept lines.
    """
    if policy not in ("none", "first"):
        raise ValueError("policy is 'none' or 'first'")
    ranges = [F.asc(c) for c in (*_LINE, *_DOC)]
    lines = keep(_placed_lines(docs, min_chars), "lines")
    # Ranges hold whole (line, document) pairs, so the window reads them where they are.
    in_doc = Window.partitionBy(*_LINE, *_DOC).orderBy("pos")
    ranged = lines.repartitionByRange(*ranges).sortWithinPartitions(*_LINE, *_DOC, "pos")
    streamed = ranged.withColumn("nth", F.row_number().over(in_doc))
    first_place = F.struct(*_DOC, "pos")
    counted = streamed.where("nth = 1").groupBy(*_LINE).agg(
        F.count(F.lit(1)).alias("n_docs"), F.min(first_place).alias("first")
    )
    shared = stage(counted.where(F.col("n_docs") >= min_docs).select(*_LINE, "first"), "shared-lines")
    gone = dimension_join(lines, shared.df, _LINE, "inner", dim_bytes=2 * shared.bytes)
    if policy == "first":
        gone = gone.where(~F.col("first").eqNullSafe(first_place))
    place = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("pos", F.lit(64)))
    words = gone.groupBy(*_DOC, F.shiftright("pos", 6).alias("word")).agg(F.bit_or(place).alias("gone"))
    entry = F.struct("word", F.bitwise_not("gone").alias("kept"))
    return words.groupBy(*_DOC).agg(
        F.sum(F.bit_count("gone").cast("long")).alias("n_dropped"),
        F.map_from_entries(F.collect_list(entry)).alias("words"),
    )


def _text() -> Column:
    return F.coalesce("text", F.lit(""))


def _lines() -> Column:
    return F.split(_text(), "\n", -1)


def _placed_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    return (
        docs.select("doc_id", F.xxhash64(_text()).alias("content"), F.posexplode(_lines()).alias("pos", "line"))
        .withColumn("key", line_key(F.col("line")))
        .where(F.char_length("key") >= min_chars)
        .select(F.xxhash64("key").alias("hash1"), F.hash("key").alias("hash2"), *_DOC, "pos")
    )


def without_shared_lines(docs: DataFrame, **options: object) -> DataFrame:
    """``doc_id, n_lines, n_dropped, text``: every document with the lines it keeps."""
    bitmaps = keep(keep_bitmaps(docs, **options), "bitmaps")
    # A word of a bitmap takes a number and its bits.
    size = bitmaps.agg(F.sum(40 + 16 * F.size("words"))).first()[0] or 0
    rows = docs.select("doc_id", F.xxhash64(_text()).alias("content"), _lines().alias("lines"))
    joined = dimension_join(rows, bitmaps, _DOC, null_safe=True, dim_bytes=size, grouped=True)

    def kept(_: Column, pos: Column) -> Column:
        word = F.element_at("words", F.shiftright(pos, 6))
        bit = F.call_function("shiftrightunsigned", word, F.pmod(pos, F.lit(64))).bitwiseAND(F.lit(1))
        return F.coalesce(bit == 1, F.lit(True))

    lines = F.when(F.col("words").isNull(), F.col("lines")).otherwise(F.filter("lines", kept))
    return joined.select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        F.array_join(lines, "\n").alias("text"),
    )
