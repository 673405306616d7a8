"""Written tables that cut lineage and survive the loss of executors.

A staged table is Parquet in the shared folder that the cluster names in
``spark.checkpoint.dir``. Its size is counted on what was written, so that
later steps can check what they would broadcast or send to one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass
from functools import cached_property
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.functions import row_bytes
from parcelflow.sources.layers import delete, write_table

_scope: ContextVar[str | None] = ContextVar("scope", default=None)


@dataclass(frozen=True)
class Staged:
    """A written table, and its size when somebody asks."""

    df: DataFrame

    @cached_property
    def rows(self) -> int:
        return self.df.count()

    @cached_property
    def bytes(self) -> int:
        return measure(self.df)


def shared_dir(spark: SparkSession) -> str:
    """Folder of this application inside the cluster's checkpoint folder, or else its warehouse."""
    base = (
        spark.conf.get("spark.checkpoint.dir", None)
        or spark.sparkContext.getCheckpointDir()
        or spark.conf.get("spark.sql.warehouse.dir")
    )
    return f"{base.rstrip('/')}/parcelflow/{spark.conf.get('spark.app.id')}"


def release(spark: SparkSession) -> None:
    """Delete everything that ``keep`` wrote for this application without a ``base``.

    Frames returned by operators are lazy and read these tables, so this is for
    the end of a session, when all results are written.
    """
    delete(spark, shared_dir(spark))


@contextmanager
def scope(spark: SparkSession, name: str = "scope") -> Iterator[None]:
    """Delete what is kept within the block without a ``base`` when it ends, also by an error.

    Frames made within it read those tables, so their results are written before its end. Scopes
    can be nested. A thread started within the block is in the scope if it runs in a copy of the
    context.
    """
    path = fresh_dir(spark, name)
    token = _scope.set(path)
    try:
        yield
    finally:
        _scope.reset(token)
        delete(spark, path)


def within_scope(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """What ``build`` returns, written to the surrounding scope; all else that it kept is deleted."""
    base = fresh_dir(spark, name)
    try:
        with scope(spark, name):
            return keep(build(), "result", base=base)
    except BaseException:
        delete(spark, base)
        raise


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new folder of the scope or the shared one; ``discard`` deletes it when it is used up."""
    return f"{_scope.get() or shared_dir(spark)}/{name}-{uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table or folder below the shared one; nothing that is still to run may read it."""
    if not path.startswith(f"{shared_dir(spark)}/"):
        raise ValueError(f"{path} is not below the shared folder")
    delete(spark, path)


def keep(
    df: DataFrame,
    name: str,
    partition_by: Sequence[str] = (),
    base: str | None = None,
    rebalance: bool = True,
) -> DataFrame:
    """Write ``df`` and return the table read back.

    It goes to a new folder of the innermost scope or the shared one, or replaces ``base/name``.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, name) if base is None else f"{base}/{name}"
    write_table(df, path, partition_by, rebalance)
    return spark.read.schema(df.schema).parquet(path).select(*[f"`{c}`" for c in df.columns])


def stage(df: DataFrame, name: str, base: str | None = None) -> Staged:
    """As ``keep``, for a table whose size matters."""
    return Staged(keep(df, name, base=base))


def measure(df: DataFrame) -> int:
    """Estimated bytes of ``df``, by one aggregate over it."""
    return df.agg(F.sum(row_bytes(df)).alias("bytes")).first()["bytes"] or 0
