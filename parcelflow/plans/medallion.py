"""The batch run: text extracts to bronze, silver and gold Parquet."""

from __future__ import annotations

from pyspark.sql import SparkSession

from parcelflow.operators.cleaning import CleanSpec, clean
from parcelflow.operators.star import SKETCHES, Star, build_star, load_star, sketches_per_day
from parcelflow.sources.delimited import read_extracts
from parcelflow.sources.layers import new_version, read_layer, write_layer, write_table
from parcelflow.sources.staging import scope

BRONZE_TABLE = "extraits"
SILVER_TABLE = "all_real_estate"
SOURCE_COLUMN = "annee_source"


def run(
    spark: SparkSession,
    inputs: str,
    out: str,
    spec: CleanSpec = CleanSpec(),
    null_safe: bool = False,
    source_pattern: str = r"(\d{4})[^/]*$",
    header_per: str = "file",
) -> Star:
    """Write the three layers below ``out`` and return the star read from gold.

    Each layer is read back from Parquet by the next one. The text is parsed
    once, and the means need only their four columns of bronze. A layer is
    replaced in one step when all of its tables are written.
    """
    raw = read_extracts(
        spark,
        inputs,
        header_per=header_per,
        source_column=SOURCE_COLUMN,
        source_pattern=source_pattern,
    )
    bronze = f"{out}/bronze"
    write_layer({BRONZE_TABLE: raw}, bronze, {BRONZE_TABLE: [SOURCE_COLUMN]})
    raw_rows = read_layer(spark, bronze, [BRONZE_TABLE], {BRONZE_TABLE: raw.schema})[BRONZE_TABLE]

    silver = f"{out}/silver"
    cleaned = clean(raw_rows.drop(SOURCE_COLUMN), spec)
    write_layer({SILVER_TABLE: cleaned}, silver, {SILVER_TABLE: ["annee"]})
    known = {SILVER_TABLE: cleaned.schema}
    clean_rows = read_layer(spark, silver, [SILVER_TABLE], known)[SILVER_TABLE]

    gold = f"{out}/gold"
    with scope(spark, "gold"), new_version(spark, gold) as folder:
        built = build_star(clean_rows, null_safe, folder)
        write_table(sketches_per_day(built.facts), f"{folder}/{SKETCHES}")
    return load_star(spark, gold, schemas={name: df.schema for name, df in built.tables.items()})
