"""Cleaning of raw extracts: names, types, imputation, rebate, duplicates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.functions import lenient_date, lenient_double, lenient_int
from parcelflow.operators.joins import dimension_join
from parcelflow.operators.ordered import carry_last

# Columns left out, sentinels, departments with a rebate and its factor.
DROPPED_COLUMNS = (
    "No Volume",
    "1er lot",
    "Surface Carrez du 1er lot",
    "2eme lot",
    "Surface Carrez du 2eme lot",
    "3eme lot",
    "Surface Carrez du 3eme lot",
    "4eme lot",
    "Surface Carrez du 4eme lot",
    "5eme lot",
    "Surface Carrez du 5eme lot",
)
ADDED_COLUMNS = {"annee", "mois", "jour", "prix_a_payer"}
UNKNOWN_TEXT = "inconnu"
UNKNOWN_CODE = 0
REBATE_DEPARTMENTS = (11, 75, 77, 78, 91, 92, 93, 94, 95)
REBATE_FACTOR = 0.97


@dataclass(frozen=True)
class CleanSpec:
    """Columns and parameters of the cleaning job."""

    dropped: Sequence[str] = DROPPED_COLUMNS
    # Only these columns are kept when given; they all take part in deduplication.
    kept: Sequence[str] | None = None
    int_columns: Sequence[str] = (
        "nombre_pieces_principales",
        "code_departement",
        "code_commune",
        "nombre_de_lots",
        "code_postal",
    )
    double_columns: Sequence[str] = ("surface_reelle_bati", "surface_terrain")
    comma_columns: Sequence[str] = ("valeur_fonciere",)
    date_column: str = "date_mutation"
    date_pattern: str = "dd/MM/yyyy"
    sentinels: Mapping[str, int | str] = field(
        default_factory=lambda: {
            "code_departement": UNKNOWN_CODE,
            "code_postal": UNKNOWN_CODE,
            "code_commune": UNKNOWN_CODE,
            "commune": UNKNOWN_TEXT,
            "nature_mutation": UNKNOWN_TEXT,
        }
    )
    mean_columns: Sequence[str] = (
        "valeur_fonciere",
        "surface_reelle_bati",
        "surface_terrain",
        "nombre_pieces_principales",
    )
    # Decimals the means are rounded to before they are filled in; None keeps them whole.
    mean_decimals: int | None = None
    rebate_departments: Sequence[int] | DataFrame = REBATE_DEPARTMENTS
    rebate_factor: float = REBATE_FACTOR


def clean(raw: DataFrame, spec: CleanSpec = CleanSpec()) -> DataFrame:
    """The whole cleaning job, as one plan.

    Dates that are missing stay missing. Means are taken before duplicates are
    removed, so a repeated row weighs in them.
    """
    named = normalise_names(drop_columns(raw, spec.dropped))
    if spec.kept is not None:
        named = named.select(*spec.kept)
    typed = type_columns(named, spec)
    whole = impute_mean(
        fill_sentinels(typed, spec.sentinels), spec.mean_columns, spec.mean_decimals
    )

    def priced(df: DataFrame) -> DataFrame:
        dated = date_parts(df, spec.date_column)
        return rebate_price(dated, spec.rebate_departments, spec.rebate_factor)

    # Added columns come from others, so rows equal without them are equal with them, and they are not
    # shuffled; raw columns of these names are replaced before rows are compared.
    return dedup_rows(priced(whole)) if ADDED_COLUMNS & set(whole.columns) else priced(dedup_rows(whole))


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop columns; names that are not there are ignored."""
    return df.drop(*names)


def normalise_names(df: DataFrame) -> DataFrame:
    """Lower-case column names with underscores for spaces."""
    return df.toDF(*[name.lower().replace(" ", "_") for name in df.columns])


def type_columns(df: DataFrame, spec: CleanSpec = CleanSpec()) -> DataFrame:
    """Give the text columns their types; text that does not fit becomes NULL."""
    typed = {name: lenient_int(F.col(name)) for name in spec.int_columns}
    typed |= {name: lenient_double(F.col(name)) for name in spec.double_columns}
    typed |= {name: lenient_double(F.col(name), decimal_comma=True) for name in spec.comma_columns}
    typed[spec.date_column] = lenient_date(F.col(spec.date_column), spec.date_pattern)
    return df.withColumns(typed)


def fill_sentinels(df: DataFrame, sentinels: Mapping[str, int | str]) -> DataFrame:
    """Replace NULLs by a fixed value per column."""
    return df.fillna(dict(sentinels))


def impute_mean(df: DataFrame, columns: Sequence[str], decimals: int | None = None) -> DataFrame:
    """Replace NULLs by the mean of the column; a column of NULLs stays as it is.

    All means come from one aggregate, used as a scalar subquery.
    """
    means = [F.avg(c) if decimals is None else F.round(F.avg(c), decimals) for c in columns]
    row = df.agg(F.struct(*[m.alias(c) for m, c in zip(means, columns)]).alias("means")).scalar()
    return df.withColumns({c: F.coalesce(F.col(c), row[c]) for c in columns})


def date_parts(df: DataFrame, date_column: str = "date_mutation") -> DataFrame:
    """Add year, month and day of a date."""
    date = F.col(date_column)
    return df.withColumns(
        {"annee": F.year(date), "mois": F.month(date), "jour": F.dayofmonth(date)}
    )


def rebate_price(
    df: DataFrame,
    departments: Sequence[int] | DataFrame = REBATE_DEPARTMENTS,
    factor: float = REBATE_FACTOR,
) -> DataFrame:
    """Add the price to pay: the value, reduced in the listed departments.

    A list too long for an expression is a table, whose first column holds the
    departments; it is joined, and broadcast only if it is small enough.
    """
    value = F.col("valeur_fonciere")
    if isinstance(departments, DataFrame):
        codes = F.col(f"`{departments.columns[0]}`").alias("code_departement")
        listed = departments.select(codes, F.lit(True).alias("__listed")).dropna().distinct()
        priced = dimension_join(df, listed, ["code_departement"])
        reduced = F.col("__listed")
    else:
        priced, reduced = df, F.col("code_departement").isin(*departments)
    price = F.when(reduced, value * F.lit(factor)).otherwise(value)
    return priced.withColumn("prix_a_payer", price).drop("__listed")


def dedup_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Keep one of the rows that are equal in every column, or in ``subset``.

    Rows are dealt before any is compared: a hash table of whole rows in front of the shuffle
    would grow with the split that a task reads, up to its share of the memory.
    """
    keys = df.columns if subset is None else list(subset)
    return df.repartition(*[F.col(f"`{c}`") for c in keys]).dropDuplicates(keys)


def carry_forward(
    df: DataFrame,
    order_cols: Sequence[str],
    partition_cols: Sequence[str] = (),
    column: str = "date_mutation",
) -> DataFrame:
    """Replace missing dates by the last known one in an explicit order.

    Not part of ``clean``, which leaves missing dates missing.
    """
    return carry_last(df, column, order_cols, partition_cols)
