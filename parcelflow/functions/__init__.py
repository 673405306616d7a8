"""Column expressions: lenient casts, dates from parts, guarded ratios, exact sums."""

from parcelflow.functions.columns import (
    concat_date,
    date_from_parts,
    exact_sum,
    lenient_date,
    lenient_double,
    lenient_int,
    mean_of_partials,
    pad_with_case,
    pad_with_right,
    row_bytes,
    safe_ratio,
)

__all__ = [
    "concat_date",
    "date_from_parts",
    "exact_sum",
    "lenient_date",
    "lenient_double",
    "lenient_int",
    "mean_of_partials",
    "pad_with_case",
    "pad_with_right",
    "row_bytes",
    "safe_ratio",
]
