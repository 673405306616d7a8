"""Lookup joins of a large table with a dimension of any size and any skew."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.sources.staging import Staged, measure, stage

# A dimension is broadcast only if its measured size stays below this.
BROADCAST_BYTES = 64 << 20
# A key with more rows than this is hot, and each of its salts gets about as many.
HOT_ROWS = 1_000_000
# So many bytes of a dimension fit in the hash table of a task without fail.
HASHED_BYTES = 16 << 20
# Groups of keys that are counted before the keys themselves.
KEY_GROUPS = 1 << 16


def dimension_join(
    facts: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    null_safe: bool = False,
    dim_bytes: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    counted: DataFrame | None = None,
    grouped: bool = False,
    hot: Staged | None = None,
    hot_rows: int = HOT_ROWS,
    row: str | None = None,
    hashed_bytes: int = 0,
) -> DataFrame:
    """Inner or left join of ``facts`` with ``dim`` on columns of the same name.

    ``dim`` has one row per key. A NULL key matches nothing unless
    ``null_safe``. A dimension of a small measured size is broadcast, which
    moves no fact. Otherwise both sides are shuffled on the keys, and the facts
    of every hot key are spread over salts, with that key's dimension row
    repeated once per salt.

    Keys with more than ``hot_rows`` rows are hot. They are given as ``hot``, or
    counted in ``counted``, a cheaper frame with at least the rows of ``facts``
    per key; which keys are taken as hot never changes the result. With
    ``grouped``, facts have been aggregated per key, so none is hot. ``row`` names a column
    with the ``row_hash`` of earlier columns: the salt comes from it then, and columns that
    nobody asks for are not shuffled for the sake of the hash. Without a hot key there are no salts.

    Shuffled sides are sorted and merged, unless the dimension has no more than ``hashed_bytes``
    per shuffle partition, as ``HASHED_BYTES``: then it is hashed there and nothing is sorted.
    """
    if how not in ("inner", "left"):
        raise ValueError("how is 'inner' or 'left'")
    size = measure(dim) if dim_bytes is None else dim_bytes
    if size <= broadcast_bytes:
        return _lookup(facts, F.broadcast(dim), keys, how, null_safe)
    if how == "inner" and not null_safe:
        facts = facts.dropna(subset=list(keys))
    partitions = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hashed = size <= hashed_bytes * partitions
    known = None
    if not grouped:
        known = hot or hot_keys(facts if counted is None else counted, keys, hot_rows, counted is not None)
    if known is None or not known.rows:
        return _lookup(facts, dim.hint("shuffle_hash") if hashed else dim, keys, how, null_safe)
    hot_table = F.broadcast(known.df) if known.bytes <= BROADCAST_BYTES else known.df
    spread_over = F.coalesce("__salts", F.lit(1))
    salted = _lookup(facts, hot_table, keys, "left", null_safe=True).withColumn(
        "__salt", F.pmod(row_hash(facts) if row is None else F.col(row), spread_over)
    )
    repeated = _lookup(dim, hot_table, keys, "left", null_safe=True).withColumn(
        "__salt", F.explode(F.sequence(F.lit(0).cast("bigint"), spread_over - 1))
    )
    repeated = repeated.drop("__salts")
    joined = _lookup(
        salted.drop("__salts"),
        repeated.hint("shuffle_hash") if hashed else repeated,
        [*keys, "__salt"],
        how,
        null_safe,
    )
    return joined.drop("__salt")


def row_hash(df: DataFrame) -> Column:
    """Number that tells rows apart, and copies of a row that different tasks hold.

    A task that runs again has the same input partition, so it repeats its numbers.
    """
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns], F.spark_partition_id())


def hot_keys(
    facts: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS, cheap: bool = False
) -> Staged:
    """Keys with more rows than one task should get, and the number of salts for each.

    Written, so that both sides of a join see the same salts. ``cheap`` facts may be read twice:
    keys are counted in groups first, and only those of groups with so many rows by themselves.
    """
    if cheap:
        facts = facts.withColumn("__group", F.pmod(F.xxhash64(*keys), F.lit(KEY_GROUPS)))
        groups = facts.groupBy("__group").agg(F.count(F.lit(1)).alias("__n"))
        many = groups.where(F.col("__n") > hot_rows).select("__group")
        facts = facts.join(F.broadcast(many), "__group", "left_semi")
    counts = facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    hot = counts.where(F.col("__n") > hot_rows)
    return stage(hot.select(*keys, F.ceil(F.col("__n") / hot_rows).alias("__salts")), "hot-keys")


def _lookup(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, null_safe: bool
) -> DataFrame:
    renamed = {key: f"__right_{key}" for key in keys}
    right = right.withColumnsRenamed(renamed)

    def same(key: str) -> Column:
        ours, theirs = F.col(key), F.col(renamed[key])
        return ours.eqNullSafe(theirs) if null_safe else ours == theirs

    condition = reduce(lambda a, b: a & b, [same(key) for key in keys])
    return left.join(right, condition, how).drop(*renamed.values())
