"""Delimited text extracts with a header line, every column read as text."""

from __future__ import annotations

import bz2
import gzip
import logging
import zlib
from collections import defaultdict
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from io import BytesIO

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

logger = logging.getLogger(__name__)

# Why something was rejected: another number of fields, no readable header, a compressed file that breaks off.
FIELDS, HEADER, BROKEN = "fields", "header", "broken"
CORRUPT = "_corrupt_record"
# Lines handed on at once when headers are read, and batches of them that are passed over.
HEADER_LINES, SHORT_BATCHES = 64, 64
# Files of more bytes have their headers read by a job each, so many side by side.
LARGE_FILE, AT_ONCE = 16 << 20, 8
# A line that is not blank.
_PRINTED = r"(?U)[^\s\x1C-\x1F]"
_DECOMPRESSORS = {".gz": gzip.open, ".bz2": bz2.open}


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str] | None = None,
    sep: str = "|",
    glob: str = "*.txt",
    source_column: str | None = None,
    source_pattern: str = r"(\d{4})[^/]*$",
) -> DataFrame:
    """One scan of files that share a header.

    ``columns`` is the header they must have, taken from the first file when
    it is not given. A file with another header fails the job: one file's
    header is never applied to the fields of another. ``source_column`` adds
    the part of the file's path that ``source_pattern`` captures.
    """
    reader = spark.read.option("sep", sep).option("header", True).option("pathGlobFilter", glob)
    if columns is None:
        columns = reader.csv(paths).columns
    schema = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    rows = reader.option("enforceSchema", False).schema(schema).csv(paths)
    if source_column is None:
        return rows
    path = F.col("_metadata.file_path")
    return rows.select("*", F.regexp_extract(path, source_pattern, 1).alias(source_column))


def read_extracts(
    spark: SparkSession,
    folder: str,
    sep: str = "|",
    glob: str = "*.txt",
    header_per: str = "file",
    skip_unreadable: bool = False,
    source_column: str | None = None,
    source_pattern: str = r"(\d{4})[^/]*$",
    left_out: list[str] | None = None,
) -> DataFrame:
    """All extracts below a folder, united by column name.

    Files are grouped by header and each group is one scan. The header lines of
    all files are read by one job, but large files have one each, or with ``header_per="directory"`` those of one
    file in every directory, for layouts that split each extract into many parts;
    the scan still checks the header of every part. Empty files hold nothing.
    Files that cannot be read fail the call or the scan; with ``skip_unreadable``
    those without a readable header, and compressed ones that break off, are logged
    and left out; their paths are then added to ``left_out``, if that is given.
    """
    groups, bad = _by_header(spark, folder, sep, glob, header_per, skip_unreadable)
    for path, reason in bad:
        logger.warning("%s: %s, left out", path, reason)
        if left_out is not None:
            left_out.append(path)
    scans = [
        read_delimited(spark, paths, columns, sep, glob, source_column, source_pattern)
        for columns, paths in groups.items()
    ]
    return union_years(scans)


def read_checked_extracts(
    spark: SparkSession,
    folder: str,
    sep: str = "|",
    glob: str = "*.txt",
    header_per: str = "file",
    source_column: str | None = None,
    source_pattern: str = r"(\d{4})[^/]*$",
) -> tuple[DataFrame, DataFrame]:
    """As ``read_extracts`` with ``skip_unreadable``, and what was rejected: ``path, record, reason``.

    A line with more or fewer fields than its header is rejected, as ``FIELDS``, instead of being
    filled up or cut. A file that is left out has a row without a record, as ``HEADER`` or ``BROKEN``.
    """
    groups, bad = _by_header(spark, folder, sep, glob, header_per, skip_unreadable=True)
    path = F.col("_metadata.file_path")
    rows, rejected = [], [spark.createDataFrame(bad, "path string, reason string")]
    for columns, paths in groups.items():
        fields = [T.StructField(name, T.StringType()) for name in (*columns, CORRUPT)]
        scan = (
            spark.read.option("sep", sep)
            .option("header", True)
            .option("pathGlobFilter", glob)
            .option("enforceSchema", False)
            .option("columnNameOfCorruptRecord", CORRUPT)
            # A line is checked against all columns, whatever is read of it.
            .option("columnPruning", False)
            .schema(T.StructType(fields))
            .csv(paths)
        )
        source = [] if source_column is None else [F.regexp_extract(path, source_pattern, 1).alias(source_column)]
        # Spark refuses a scan of the corrupt records alone; this condition holds for every row.
        asked = scan.where(F.coalesce(F.length(f"`{columns[0]}`"), F.lit(0)) >= 0)
        rows.append(asked.where(F.col(CORRUPT).isNull()).select(*[f"`{c}`" for c in columns], *source))
        broken = asked.where(F.col(CORRUPT).isNotNull())
        rejected.append(
            broken.select(path.alias("path"), F.col(CORRUPT).alias("record"), F.lit(FIELDS).alias("reason"))
        )
    return union_years(rows), union_years(rejected).select("path", "record", "reason")


def _by_header(
    spark: SparkSession, folder: str, sep: str, glob: str, header_per: str, skip_unreadable: bool
) -> tuple[dict[tuple[str, ...], list[str]], list[tuple[str, str]]]:
    """Files, or directories, by the columns of their header; and what cannot be read, with the reason."""
    if header_per not in ("file", "directory"):
        raise ValueError("header_per is 'file' or 'directory'")
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .load(folder)
        .select("path", F.col("_metadata.file_path").alias("uri"), "length")
    )
    # File names only: the same listing Spark itself keeps on the driver to plan a scan.
    found = listed.where("length > 0").collect()
    files = sorted((r["path"], r["uri"]) for r in found)
    large = {r["path"] for r in found if r["length"] > LARGE_FILE}
    bad: dict[str, str] = {}
    if skip_unreadable and (packed := [path for path, _ in files if path.endswith(tuple(_DECOMPRESSORS))]):
        bad |= {path: BROKEN for path in _broken(spark, packed)}
        files = [(path, uri) for path, uri in files if path not in bad]
    if header_per == "directory":
        # One file stands for its directory; broken ones are left out, so the others are named.
        first = {}
        for path, uri in files:
            first.setdefault(path.rsplit("/", 1)[0], (path, uri))
        heads = list(first.values())
    else:
        heads = files
    lines = {}
    if small := [path for path, _ in heads if path not in large]:
        lines |= _first_lines(spark, small, skip_unreadable)
    if long := [path for path, _ in heads if path in large]:
        lines |= _first_lines_alone(spark, long, skip_unreadable)
    reader = spark.read.option("sep", sep).option("header", True)
    columns: dict[str, tuple[str, ...]] = {}
    by_header: dict[tuple[str, ...], list[str]] = defaultdict(list)
    of_directory: dict[str, tuple[str, ...]] = {}
    for path, uri in heads:
        line = lines.get(uri)
        if line is None:
            if not skip_unreadable:
                raise OSError(f"no line could be read of {path}")
            bad[path] = HEADER
        elif line and line not in columns:
            try:
                columns[line] = tuple(reader.csv(path).columns)
            except (PySparkException, Py4JJavaError):
                if not skip_unreadable:
                    raise
                columns[line] = ()
                bad[path] = HEADER
        if columns.get(line):
            if header_per == "file":
                by_header[columns[line]].append(path)
            else:
                of_directory[path.rsplit("/", 1)[0]] = columns[line]
    if header_per == "directory":
        broken_in = {path.rsplit("/", 1)[0] for path in bad}
        for folder_of, found in of_directory.items():
            if folder_of not in broken_in:
                by_header[found].append(folder_of)
        for path, _ in files:
            if (folder_of := path.rsplit("/", 1)[0]) in broken_in and folder_of in of_directory:
                by_header[of_directory[folder_of]].append(path)
    if not by_header:
        raise FileNotFoundError(f"no extract matching {glob} under {folder}")
    return by_header, sorted(bad.items())


def _first_lines(spark: SparkSession, paths: list[str], skip_unreadable: bool) -> dict[str, str]:
    """First line that is not blank by the URI of the file, or an empty one; by one job.

    Every file is a task of its own, which ends after that line. A file that cannot be read has none.
    """
    session = _one_file_a_task(spark)
    texts = session.read.option("ignoreCorruptFiles", skip_unreadable).text(paths)
    found = texts.select(F.col("_metadata.file_path").alias("uri"), "value").mapInArrow(
        _first_line, "uri string, value string"
    )
    return {row["uri"]: row["value"] for row in found.collect()}  # one row a file


def _first_lines_alone(spark: SparkSession, paths: list[str], skip_unreadable: bool) -> dict[str, str]:
    """As ``_first_lines`` for large files, by a job each with a limit, which reads no more than it needs.

    A task that hands lines on to Python can read its whole file before Python ends.
    """
    reader = _one_file_a_task(spark).read.option("ignoreCorruptFiles", skip_unreadable)

    def first(path: str) -> tuple[str, str] | None:
        lines = reader.text(path).select(F.col("_metadata.file_path").alias("uri"), "value")
        if row := lines.where(F.col("value").rlike(_PRINTED)).limit(1).first():
            return row["uri"], row["value"]
        # Blank lines alone are no header; a file that cannot be read has no line at all.
        row = lines.limit(1).first()
        return row and (row["uri"], "")

    with ThreadPoolExecutor(AT_ONCE) as pool:
        return dict(filter(None, pool.map(inheritable_thread_target(spark)(first), paths)))


def _one_file_a_task(spark: SparkSession) -> SparkSession:
    """A session of the same application that gives each file a task, whatever its size."""
    session = spark.newSession()
    for name, value in {
        "spark.sql.files.maxPartitionBytes": 1 << 50,
        "spark.sql.files.openCostInBytes": 1 << 50,
        "spark.sql.execution.arrow.maxRecordsPerBatch": HEADER_LINES,
    }.items():
        session.conf.set(name, value)
    return session


def _first_line(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rest of a short file is passed over, so that the worker can go on with the next one."""
    found, number = None, 0
    for number, batch in enumerate(batches):
        if found is None or not found["value"]:
            lines = (row for row in batch.to_pylist() if row["value"].strip())
            found = next(lines, {"uri": batch.column("uri")[0].as_py(), "value": ""})
        if found["value"] and number >= SHORT_BATCHES:
            break
    if found is not None:
        yield pa.RecordBatch.from_pylist([found], batch.schema)


def _broken(spark: SparkSession, paths: list[str]) -> list[str]:
    """Compressed files that cannot be read to their end.

    No task could split such a file anyway. Its bytes are held in memory, and Spark refuses files
    beyond two gigabytes here.
    """
    session = _one_file_a_task(spark)
    session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1)
    contents = session.read.format("binaryFile").load(paths).select("path", "content")
    return [row["path"] for row in contents.mapInArrow(_unpack, "path string").collect()]


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            opened = _DECOMPRESSORS["." + row["path"].rsplit(".", 1)[1]](BytesIO(row["content"]))
            try:
                while opened.read(1 << 20):
                    pass
            except (OSError, EOFError, zlib.error):
                yield pa.RecordBatch.from_pylist([{"path": row["path"]}])


def union_years(frames: Sequence[DataFrame], by: str = "name") -> DataFrame:
    """Union of yearly frames, duplicates kept.

    By name, a column that a year lacks is NULL there. ``by="position"`` pairs
    columns by place and needs the same number of them in every frame.
    """
    if by == "name":
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    if by == "position":
        return reduce(DataFrame.union, frames)
    raise ValueError("by is 'name' or 'position'")
