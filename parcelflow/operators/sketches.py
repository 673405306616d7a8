"""Quantiles of groups by sketches that are stored, and merged instead of reading rows again.

A sketch keeps a bounded sample of its values, whose ranks are off by at most
``rank_error`` of the number of values in 99 of 100 cases. Sketches of small groups
merge into those of any coarser group, with the same error, so the rows are read once
and new ones only add sketches. Which values a sketch keeps is decided at random:
two runs can differ within the error. Groups of at most about ``accuracy`` values
are exact.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.operators.joins import dimension_join
from parcelflow.sources.staging import stage

# Values a sketch keeps at its widest; the error falls almost in proportion.
ACCURACY = 400


def rank_error(accuracy: int = ACCURACY) -> float:
    """Error of a rank as a share of the number of values, published for this kind of sketch."""
    return 2.296 / accuracy**0.9723


def sketch_values(
    df: DataFrame, by: Sequence[str], value: str, accuracy: int = ACCURACY
) -> DataFrame:
    """Group columns with ``n`` and ``sketch`` of the values that are not NULL.

    A group of NULLs only has none and is left out. Values are sketched before the shuffle.
    """
    known = df.where(F.col(value).isNotNull())
    sketch = F.kll_sketch_agg_double(F.col(value).cast("double"), accuracy)
    return known.groupBy(*by).agg(F.count(value).alias("n"), sketch.alias("sketch"))


def merge_sketches(
    sketches: DataFrame, by: Sequence[str], accuracy: int = ACCURACY
) -> DataFrame:
    """Sketches of coarser groups; rows of sketches can have any further columns."""
    merged = F.kll_merge_agg_double("sketch", accuracy)
    return sketches.groupBy(*by).agg(F.sum("n").alias("n"), merged.alias("sketch"))


def with_quantiles(sketches: DataFrame, shares: Mapping[str, float]) -> DataFrame:
    """Add the value at each share of the ranks, such as 0.5 for a median."""
    return sketches.withColumns(
        {name: F.kll_sketch_get_quantile_double("sketch", F.lit(share)) for name, share in shares.items()}
    )


def rank_errors(
    df: DataFrame, quantiles: DataFrame, by: Sequence[str], value: str, quantile: str, share: float
) -> DataFrame:
    """Group columns, ``n``, and how far the ranks of ``quantile`` among the values are from ``share``.

    A quantile that occurs several times has all of their ranks, and the nearest counts.
    """
    known = stage(quantiles.select(*by, F.col(quantile).alias("__quantile")), "quantiles")
    rows = df.where(F.col(value).isNotNull()).select(*by, F.col(value).alias("__value"))
    met = dimension_join(rows, known.df, by, "inner", null_safe=True, dim_bytes=known.bytes)
    n = F.count(F.lit(1))
    below = F.count_if(F.col("__value") < F.col("__quantile")) / n
    upto = F.count_if(F.col("__value") <= F.col("__quantile")) / n
    error = F.greatest(below - share, share - upto, F.lit(0.0))
    return met.groupBy(*by).agg(n.alias("n"), error.alias("error"))
