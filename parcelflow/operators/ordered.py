"""Numbering, ranking and carrying over one total order, without one big task.

A window without a partition column sends every row to one task. Here the rows
are range-partitioned and written once with the number of their range. Each
range is then scanned on its own, and what precedes it comes from a table with
one row per range (and group).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.operators.joins import dimension_join, row_hash
from parcelflow.sources.staging import keep, stage

_RANGE = "__range"


def with_total(df: DataFrame, total: str, counted: DataFrame | None = None) -> DataFrame:
    """Add the number of rows of ``df`` to each of them.

    The count is a scalar subquery over ``counted``, a cheaper frame with as
    many rows, or over ``df`` itself with its columns pruned.
    """
    rows = (df if counted is None else counted).agg(F.count(F.lit(1)))
    return df.withColumn(total, rows.scalar())


def top_k(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    ties: Sequence[str],
    k: int,
    pieces: Sequence[str] = (),
) -> DataFrame:
    """First ``k`` rows of every group, largest value first, then in the order of ``ties``.

    The limit is also applied before the shuffle. With ``pieces``, columns that
    cut each group into parts, rows that cannot be among the first are left out
    before anything is sorted: the k-th largest of the parts' maxima is a value
    that k rows reach, so smaller ones are no candidates.
    """
    order = [F.desc(value), *[F.asc(c) for c in ties]]
    if pieces:
        best = df.groupBy(*by, *pieces).agg(F.max(value).alias("__best"))
        floors = (
            _first_rows(best, by, [F.desc("__best")], k)
            .groupBy(*by)
            .agg(F.when(F.count("__best") == k, F.min("__best")).alias("__floor"))
        )
        known = stage(floors, "floors")
        df = dimension_join(df, known.df, by, "left", null_safe=True, dim_bytes=known.bytes)
        df = df.where(F.col("__floor").isNull() | (F.col(value) >= F.col("__floor")))
        df = df.drop("__floor")
    return _first_rows(df, by, order, k)


def _first_rows(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("__place", place).where(F.col("__place") <= k).drop("__place")


def surrogate_key(df: DataFrame, id_column: str, order: Sequence[str]) -> DataFrame:
    """Number the rows 1..n in a total order, NULLs first.

    Each range is sorted where it is, and the place of a row in its range is
    written with it. The rows themselves are shuffled once.
    """
    ascending = [F.col(c).asc() for c in order]
    ranged = df.repartitionByRange(*ascending).sortWithinPartitions(*ascending)
    # The upper bits of this number are the range, the lower 33 the place in it.
    place = F.monotonically_increasing_id()
    placed = keep(ranged.withColumn("__place", place), "numbered").withColumns(
        {
            _RANGE: F.shiftright("__place", 33),
            "__place": F.col("__place").bitwiseAND(F.lit((1 << 33) - 1)),
        }
    )
    sizes = placed.groupBy(_RANGE).agg(F.count(F.lit(1)).alias("__size"))
    earlier = Window.orderBy(_RANGE).rowsBetween(*_EARLIER)
    offsets = sizes.select(
        _RANGE, F.coalesce(F.sum("__size").over(earlier), F.lit(0)).alias("__offset")
    )
    # One row per range, so never more than there are shuffle partitions.
    numbered = placed.join(F.broadcast(offsets), _RANGE)
    number = F.col("__offset") + F.col("__place") + 1
    return numbered.select(*[f"`{c}`" for c in df.columns], number.alias(id_column))


def running_total(
    df: DataFrame,
    order: Sequence[Column],
    weight: Column,
    running: str,
    by: Sequence[str] = (),
) -> DataFrame:
    """Running sum of integer weights in a total order, per group of ``by``."""
    ranges = _in_ranges(df.withColumn("__weight", weight), by, order)
    sums = ranges.groupBy(_RANGE, *by).agg(F.sum("__weight").alias("__range_sum"))
    earlier = Window.partitionBy(*by).orderBy(_RANGE).rowsBetween(*_EARLIER)
    offsets = sums.select(
        _RANGE, *by, F.coalesce(F.sum("__range_sum").over(earlier), F.lit(0)).alias("__offset")
    )
    within = Window.partitionBy(_RANGE, *by).orderBy(*order).rowsBetween(*_SO_FAR)
    return (
        _with_range_row(ranges, offsets, by)
        .withColumn(running, F.sum("__weight").over(within) + F.col("__offset"))
        .drop("__weight", "__offset", _RANGE)
    )


def carry_last(
    df: DataFrame,
    column: str,
    order: Sequence[str],
    by: Sequence[str] = (),
) -> DataFrame:
    """Replace NULLs of a column by its last value in the order of the group.

    Rows that the order does not tell apart are kept apart by a hash, so that
    many of them, copies included, can be split over several ranges.
    """
    total_order = [*order, "__tie"]
    ascending = [F.col(c).asc() for c in total_order]
    ranges = _in_ranges(df.withColumn("__tie", row_hash(df)), by, ascending)
    # max_by skips the rows whose ordering value is NULL.
    place = F.when(F.col(column).isNotNull(), F.struct(*total_order))
    parts = ranges.groupBy(_RANGE, *by).agg(F.max_by(column, place).alias("__part"))
    earlier = Window.partitionBy(*by).orderBy(_RANGE).rowsBetween(*_EARLIER)
    carried = parts.withColumn("__carried", F.last("__part", ignorenulls=True).over(earlier))
    within = Window.partitionBy(_RANGE, *by).orderBy(*ascending).rowsBetween(*_SO_FAR)
    filled = F.coalesce(F.last(column, ignorenulls=True).over(within), F.col("__carried"))
    return (
        _with_range_row(ranges, carried.drop("__part"), by)
        .withColumn(column, filled)
        .drop("__carried", "__tie", _RANGE)
    )


def rank_over_all(df: DataFrame, ranks: Mapping[str, str]) -> DataFrame:
    """Add the rank of each row over the whole table, largest value first.

    ``ranks`` names the column ranked by each new column. Equal values share a
    rank and NULLs come last. The distinct values are ranked, weighted by how
    often they occur, and joined back.
    """
    ranked = keep(df, "ranked")
    result = ranked
    for name, value in ranks.items():
        values = ranked.groupBy(value).agg(F.count(F.lit(1)).alias("__n"))
        counted = running_total(values, [F.col(value).desc()], F.col("__n"), "__upto")
        place = (F.col("__upto") - F.col("__n") + 1).alias(name)
        places = stage(counted.select(value, place), "places")
        result = dimension_join(
            result, places.df, [value], null_safe=True, dim_bytes=places.bytes, counted=ranked
        )
    return result


def exact_median(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    median: str,
) -> DataFrame:
    """Median per group with linear interpolation, as ``percentile_cont(0.5)``.

    A first pass counts the values of each group per bucket of a logarithmic
    scale and finds the buckets that hold the middle. A second pass counts the
    distinct values of those buckets alone, which are then scanned in order.
    Neither pass shuffles the rows, and no task holds a whole group.
    """
    bucketed = df.select(*by, value, _bucket(F.col(value)).alias("__bucket"))
    per_bucket = bucketed.groupBy(*by, "__bucket").agg(F.count(value).alias("__n"))
    group = Window.partitionBy(*by)
    placed = per_bucket.withColumns(
        {
            "__upto": F.sum("__n").over(group.orderBy("__bucket").rowsBetween(*_SO_FAR)),
            "__all": F.sum("__n").over(group),
        }
    )
    holds_middle = F.expr(f"__upto >= {_LOW} AND __upto - __n < {_HIGH}")
    before = F.min(F.col("__upto") - F.col("__n")).over(group)
    middle = stage(
        placed.where(holds_middle).select(*by, "__bucket", "__all", before.alias("__before")),
        "middle-buckets",
    )
    near = dimension_join(
        bucketed, middle.df, [*by, "__bucket"], "inner", null_safe=True, dim_bytes=middle.bytes
    )
    counts = near.groupBy(*by, value, "__before", "__all").agg(F.count(value).alias("__n"))
    seen = running_total(counts, [F.col(value).asc()], F.col("__n"), "__seen", by)
    scanned = seen.withColumn("__upto", F.col("__before") + F.col("__seen"))

    def value_at(place: str) -> Column:
        reached = F.expr(f"__upto >= {place} AND __upto - __n < {place}")
        return F.max(F.when(reached, F.col(value)))

    ends = scanned.groupBy(*by).agg(value_at(_LOW).alias("__low"), value_at(_HIGH).alias("__high"))
    between = F.col("__low") + (F.col("__high") - F.col("__low")) * 0.5
    return ends.select(*by, between.alias(median))


# Places of the two middle values among the values of a group.
_LOW = "((__all + 1) div 2)"
_HIGH = "(__all div 2 + 1)"


def _bucket(value: Column) -> Column:
    """Number of a bucket about half a percent wide; never falls as the value grows."""
    return F.rint(F.signum(value) * F.log1p(F.abs(value)) * 200)


_SO_FAR = (Window.unboundedPreceding, Window.currentRow)
_EARLIER = (Window.unboundedPreceding, -1)


def _in_ranges(df: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Write ``df`` in ranges of the order, with the number of the range.

    Bounds of ranges come from a sample and may differ if a task runs again, so
    the number is fixed in the written table before anything depends on it.
    """
    ranged = df.repartitionByRange(*[F.col(c).asc() for c in by], *order)
    return keep(ranged.withColumn(_RANGE, F.spark_partition_id()), "ranges")


def _with_range_row(rows: DataFrame, per_range: DataFrame, by: Sequence[str]) -> DataFrame:
    """Join each row with the one row of its range and group."""
    renamed = {c: f"__of_{c}" for c in (_RANGE, *by)}
    per_range = per_range.withColumnsRenamed(renamed)
    same = [F.col(ours).eqNullSafe(F.col(theirs)) for ours, theirs in renamed.items()]
    return rows.join(per_range, reduce(lambda a, b: a & b, same)).drop(*renamed.values())
