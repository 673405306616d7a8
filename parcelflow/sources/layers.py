"""Parquet layers: a folder with named tables, rewritten in one step.

A write goes to a new folder beside the tables that readers use. A small manifest
names the folder of each table and is replaced by one rename when all tables of the
write are there, so a reader sees all of them or none, and a job that fails changes
nothing. The tables before the last write stay, for readers that are still at work
on them; those before that are deleted. Two writers at the same time are not
serialised: the manifest of the later one holds.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from threading import Lock
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

MANIFEST = "current.json"
# Spark's settings to delete the shuffle files of a query when the query ends, and to keep files of so
# many values of the partition columns open in a task, which then sorts no rows unless there are more.
_WRITE_SETTINGS = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}
_writes: dict[str, tuple[int, dict[str, str | None]]] = {}
_lock = Lock()


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), rebalance: bool = True
) -> None:
    """Overwrite a Parquet table.

    A partitioned table is rebalanced on its partition columns first: each
    directory gets files of the advisory size, and a value that holds a large
    share of the rows is split over several tasks. Without ``rebalance`` the rows are
    written where they are, a file for each task and value in it: for few values, or rows that
    lie by their value already, that saves a shuffle of the whole table.
    """
    sized = df.hint("rebalance", *partition_by) if partition_by and rebalance else df
    with write_settings(df.sparkSession):
        sized.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


@contextmanager
def write_settings(spark: SparkSession) -> Iterator[None]:
    """What the write shuffles is deleted at its end, not when the driver next collects garbage.

    Writes can run side by side; the settings are put back after the last of them.
    """
    session = spark._jsparkSession.sessionUUID()
    with _lock:
        running, before = _writes.get(session) or (0, {name: spark.conf.get(name, None) for name in _WRITE_SETTINGS})
        for name, value in _WRITE_SETTINGS.items():
            spark.conf.set(name, value)
        _writes[session] = running + 1, before
    try:
        yield
    finally:
        with _lock:
            running, before = _writes.pop(session)
            if running > 1:
                _writes[session] = running - 1, before
            else:
                for name, value in before.items():
                    spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@contextmanager
def new_version(spark: SparkSession, base: str) -> Iterator[str]:
    """A folder for new tables of a layer, which readers see when the block ends without an error.

    Tables of the layer that the block does not write stay as they are.
    """
    folder = f"version-{uuid4().hex}"
    path = f"{base}/{folder}"
    try:
        yield path
        before = _manifest(spark, base)
        written = {name: f"{folder}/{name}" for name in _children(spark, path)}
        _replace_file(
            spark,
            f"{base}/{MANIFEST}",
            json.dumps({"tables": {**before["tables"], **written}, "before": before["tables"]}),
        )
    except BaseException:
        delete(spark, path)
        raise
    used = {table.split("/")[0] for table in [*before["tables"].values(), folder]}
    for child in _children(spark, base):
        if child.startswith("version-") and child not in used:
            delete(spark, f"{base}/{child}")


def write_layer(
    tables: Mapping[str, DataFrame],
    base: str,
    partition_by: Mapping[str, Sequence[str]] | None = None,
    rebalance: bool = True,
) -> None:
    """Write tables of a layer, all of them visible at once."""
    if not tables:
        return
    with new_version(next(iter(tables.values())).sparkSession, base) as folder:
        for name, df in tables.items():
            write_table(df, f"{folder}/{name}", (partition_by or {}).get(name, ()), rebalance)


def read_layer(
    spark: SparkSession,
    base: str,
    names: Iterable[str],
    schemas: Mapping[str, StructType] | None = None,
) -> dict[str, DataFrame]:
    """Tables of a layer by name, all of one state of the layer.

    A table whose schema is given is read with it; types of partition columns
    are otherwise guessed from the names of folders. A layer without a manifest
    is a folder with one directory per table.
    """
    known, tables = _manifest(spark, base)["tables"], {}
    for name in names:
        schema = (schemas or {}).get(name)
        reader = spark.read if schema is None else spark.read.schema(schema)
        tables[name] = reader.parquet(f"{base}/{known.get(name, name)}")
    return tables


def layer_tables(spark: SparkSession, base: str) -> list[str]:
    """Names of the tables of a layer."""
    known = _manifest(spark, base)["tables"]
    return sorted(known or _children(spark, base))


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _manifest(spark: SparkSession, base: str) -> dict[str, dict[str, str]]:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{MANIFEST}")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return {"tables": {}}
    stream = files.open(path)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _children(spark: SparkSession, base: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    return [child.getPath().getName() for child in files.listStatus(path) if child.isDirectory()]


def _replace_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a file under another name and rename it over the one that is there."""
    fs, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    target, passing = fs.Path(path), fs.Path(f"{path}-{uuid4().hex}")
    stream = passing.getFileSystem(conf).create(passing)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    overwrite = spark.sparkContext._gateway.new_array(fs.Options.Rename, 1)
    overwrite[0] = fs.Options.Rename.OVERWRITE
    fs.FileContext.getFileContext(target.toUri(), conf).rename(passing, target, overwrite)
