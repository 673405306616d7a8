"""Operators on DataFrames: joins, ordered scans, cleaning and the star schema."""

from parcelflow.operators.cleaning import (
    CleanSpec,
    carry_forward,
    clean,
    date_parts,
    dedup_rows,
    drop_columns,
    fill_sentinels,
    impute_mean,
    normalise_names,
    rebate_price,
    type_columns,
)
from parcelflow.operators.joins import dimension_join
from parcelflow.operators.ordered import (
    carry_last,
    exact_median,
    rank_over_all,
    running_total,
    surrogate_key,
    top_k,
    with_total,
)
from parcelflow.operators.sketches import (
    merge_sketches,
    rank_error,
    rank_errors,
    sketch_values,
    with_quantiles,
)
from parcelflow.operators.star import (
    DIMENSIONS,
    DimensionSpec,
    Star,
    attach_keys,
    build_dimension,
    build_dimensions,
    build_star,
    load_star,
    sketches_per_day,
    star_integrity,
)

__all__ = [
    "DIMENSIONS",
    "CleanSpec",
    "DimensionSpec",
    "Star",
    "attach_keys",
    "build_dimension",
    "build_dimensions",
    "build_star",
    "carry_forward",
    "carry_last",
    "clean",
    "date_parts",
    "dedup_rows",
    "dimension_join",
    "drop_columns",
    "exact_median",
    "fill_sentinels",
    "impute_mean",
    "load_star",
    "merge_sketches",
    "normalise_names",
    "rank_error",
    "rank_errors",
    "rank_over_all",
    "rebate_price",
    "running_total",
    "sketch_values",
    "sketches_per_day",
    "star_integrity",
    "surrogate_key",
    "top_k",
    "type_columns",
    "with_quantiles",
    "with_total",
]
