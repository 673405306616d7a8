"""Words and windows of whole texts, in whole batches of UTF-8 bytes.

Every class of characters here is cut from ASCII, and each byte of a longer
UTF-8 sequence is 0x80 or above, so texts can be cut byte by byte.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# What stands between white space.
SPACED = re.compile(rb"[^\x20\x09-\x0D]+")
# Lower-case ASCII letters, digits and everything beyond ASCII; texts are lowered first.
ALNUM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
# Bytes of text handled at once by code that works on arrays.
CHUNK_BYTES = 4 << 20


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or one like it that no column of ``df`` has."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def lowered(text: Column) -> Column:
    """The text with A-Z in lower case and nothing else changed."""
    return F.translate(text, UPPER, LOWER)


def byte_texts(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """Texts as UTF-8 bytes."""
    return column.cast(pa.binary()).to_pylist()


def chunks(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """Pieces of batches with about ``CHUNK_BYTES`` of text; a longer text is alone."""
    for batch in batches:
        sizes = np.array(
            [len(t) if t else 0 for t in byte_texts(batch.column(text))], dtype=np.int64
        )
        ends = np.flatnonzero(np.diff(np.cumsum(sizes) // CHUNK_BYTES)) + 1
        start = 0
        for end in [*ends.tolist(), len(sizes)]:
            if end > start:
                yield batch.slice(start, end - start)
            start = end
