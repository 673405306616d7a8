"""Scalar and aggregate column expressions shared by the operators.

Everything here is a built-in Spark expression, so it stays inside whole-stage
codegen. ANSI mode is on by default, hence the ``try_`` forms.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Enough for the cents of a price and for means rounded to six decimals.
EXACT_TYPE = "decimal(20,6)"


def lenient_int(text: Column) -> Column:
    """Integer value of a text column, NULL where it is not a number.

    A fractional part is cut off ("12.7" gives 12), as a non-ANSI cast does. The
    pattern is tried only on text that is no whole number.
    """
    whole = F.regexp_replace(
        text, r"^\s*(?<sign>[+-]?)(?<digits>\d*)\.\d*\s*$", "${sign}0${digits}"
    )
    return F.coalesce(text.try_cast("int"), whole.try_cast("int"))


def lenient_double(text: Column, decimal_comma: bool = False) -> Column:
    """Double value of a text column, NULL where it is not a number."""
    plain = F.replace(text, F.lit(","), F.lit(".")) if decimal_comma else text
    return plain.try_cast("double")


def lenient_date(text: Column, pattern: str = "dd/MM/yyyy") -> Column:
    """Date value of a text column, NULL where it does not follow the pattern."""
    return F.try_to_date(text, pattern)


def date_from_parts(year: str, month: str, day: str) -> Column:
    """Date of three integer columns; NULL as soon as one part is NULL."""
    return F.make_date(F.col(year), F.col(month), F.col(day))


def pad_with_case(number: str) -> Column:
    """Two-digit text of a number: a leading zero below ten."""
    text = F.col(number).cast("string")
    return F.when(F.col(number) < 10, F.concat(F.lit("0"), text)).otherwise(text)


def pad_with_right(number: str, width: int = 2) -> Column:
    """Fixed-width text of a number: the last characters after zero padding."""
    zeros = F.lit("0" * width)
    return F.right(F.concat(zeros, F.col(number).cast("string")), F.lit(width))


def concat_date(year: Column, month: Column, day: Column) -> Column:
    """Date written as text parts, parsed; NULL when the text is no date."""
    return F.concat(year.cast("string"), F.lit("-"), month, F.lit("-"), day).try_cast("date")


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient that is NULL, not an error, over zero."""
    return numerator / F.nullif(denominator, F.lit(0))


def exact_sum(value: str) -> Column:
    """Sum that does not depend on the order of rows, so that ranks are stable."""
    return F.sum(F.col(value).cast(EXACT_TYPE))


def mean_of_partials(total: str, count: str) -> Column:
    """Mean of rows that were already summed and counted per finer key."""
    return safe_ratio(F.sum(total), F.sum(count).cast("double"))


def row_bytes(df: DataFrame) -> Column:
    """Estimated bytes of a row: text length, eight for any other column."""
    sizes = [
        F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0)) + 8
        if isinstance(field.dataType, T.StringType)
        else F.lit(8)
        for field in df.schema.fields
    ]
    return reduce(lambda left, right: left + right, sizes).cast("bigint")
