"""Property-sale layers derived from the order tables, for tests and benchmarks.

Each order line stands for a sale. The raw frame holds text only, with missing
values, decimal commas and a code that is no number, so that every cleaning
step has work. Lines up to 1998 and from 1998 on form two extracts, and the
lines of 1998 are in both.
"""

from __future__ import annotations

from collections.abc import Callable
from threading import RLock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.operators.cleaning import CleanSpec, clean
from parcelflow.operators.joins import HASHED_BYTES, dimension_join
from parcelflow.operators.star import Star, build_star
from parcelflow.plans.medallion import SOURCE_COLUMN
from parcelflow.sources.staging import keep

SPLIT_YEAR = 1998
LAST_YEAR = 2001
# Rounded means make two engines agree on the last digit.
SPEC = CleanSpec(mean_decimals=6)


class Layers:
    """Bronze, silver and gold of one folder of order tables, each written once."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir
        self._built: dict[str, DataFrame | Star] = {}
        self._lock = RLock()

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @property
    def bronze(self) -> DataFrame:
        """Raw text rows of both extracts, with the year of the extract.

        Written by extract, so that one of them can be read alone.
        """
        return self._once("bronze", lambda: keep(self._raw(), "bronze", [SOURCE_COLUMN], rebalance=False))

    @property
    def silver(self) -> DataFrame:
        """Clean rows.

        The shuffle that removes duplicates is their only one: there are few years.
        """
        return self._once("silver", lambda: keep(clean(self.raw, SPEC), "silver", ["annee"], rebalance=False))

    @property
    def star(self) -> Star:
        """Dimensions and facts."""
        return self._once("star", lambda: build_star(self.silver))

    def _once(self, name: str, build: Callable[[], DataFrame | Star]) -> DataFrame | Star:
        with self._lock:
            if name not in self._built:
                self._built[name] = build()
            return self._built[name]

    @property
    def raw(self) -> DataFrame:
        """Raw text rows, without the year of their extract."""
        return self.bronze.drop(SOURCE_COLUMN)

    @property
    def raw_once(self) -> DataFrame:
        """As ``raw``, for a query that reads it once: bronze is used if it is there, but not written."""
        with self._lock:
            return (self._built.get("bronze") or self._raw()).drop(SOURCE_COLUMN)

    def extract(self, year: int) -> DataFrame:
        """Raw text rows of one extract."""
        return self.bronze.where(F.col(SOURCE_COLUMN) == year).drop(SOURCE_COLUMN)

    def _raw(self) -> DataFrame:
        lines = self.table("lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_extendedprice", "l_shipdate",
        )
        orders = self.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus")
        parts = self.table("part").select(F.col("p_partkey").alias("l_partkey"), "p_type", "p_size")
        suppliers = self.table("supplier").select(
            F.col("s_suppkey").alias("l_suppkey"), "s_name", "s_nationkey"
        )
        sales = lines
        for dim, key in ((orders, "l_orderkey"), (parts, "l_partkey"), (suppliers, "l_suppkey")):
            sales = dimension_join(sales, dim, [key], "inner", counted=lines, hashed_bytes=HASHED_BYTES)
        # One pass over the lines; those without a date are in no extract.
        year = F.year("l_shipdate")
        old, new = F.lit(SPLIT_YEAR), F.lit(LAST_YEAR)
        extracts = (
            F.when(year < SPLIT_YEAR, F.array(old))
            .when(year == SPLIT_YEAR, F.array(old, new))
            .when(year > SPLIT_YEAR, F.array(new))
        )
        text = sales.select(
            extracts.alias("extracts"), *[column.alias(name) for name, column in _text_columns().items()]
        )
        return text.withColumn(SOURCE_COLUMN, F.explode("extracts")).drop("extracts")


def _text_columns() -> dict[str, Column]:
    def missing(when: Column, otherwise: Column) -> Column:
        return F.when(~when, otherwise.cast("string"))

    kind = (
        F.when(F.col("p_type") == "ECONOMY", "Maison")
        .when(F.col("p_type") == "LARGE", "Appartement")
        .otherwise(F.col("p_type"))
    )
    price = F.replace(
        F.col("l_extendedprice").cast("decimal(12,2)").cast("string"), F.lit("."), F.lit(",")
    )
    department = F.when(F.col("s_nationkey") == 0, "2A").otherwise(
        (F.col("s_nationkey") + 70).cast("string")
    )
    untyped = F.col("p_type") == "SMALL"
    quantity = F.col("l_quantity").cast("int")
    return {
        "Identifiant de document": F.col("l_orderkey").cast("string"),
        "Date mutation": missing(
            F.col("l_orderkey") % 17 == 0, F.date_format("l_shipdate", "dd/MM/yyyy")
        ),
        "Nature mutation": missing(F.col("l_partkey") % 29 == 0, F.col("o_orderstatus")),
        "Valeur fonciere": missing(F.col("l_partkey") % 23 == 0, price),
        "Code postal": (F.col("l_suppkey") + 70000).cast("string"),
        "Commune": missing(F.col("l_suppkey") % 31 == 0, F.col("s_name")),
        "Code departement": department,
        "Code commune": (F.col("l_suppkey") % 10).cast("string"),
        "No Volume": F.col("l_linenumber").cast("string"),
        "1er lot": F.col("l_suppkey").cast("string"),
        "Nombre de lots": missing(F.col("l_linenumber") == 7, F.col("l_linenumber") - 1),
        "Code type local": missing(untyped, F.length("p_type")),
        "Type local": missing(untyped, kind),
        "Surface reelle bati": missing(F.col("l_quantity") == 50, quantity),
        "Nombre pieces principales": missing(F.col("p_size") % 11 == 0, F.col("p_size") % 8),
        "Surface terrain": missing(F.col("l_linenumber") == 2, quantity * 10),
    }


_cache: dict[tuple, Layers] = {}
_cache_lock = RLock()


def layers(spark: SparkSession, sf_dir: str) -> Layers:
    """The layers of a folder, shared by the queries of one application.

    They are derived anew when the files of the folder have changed.
    """
    names = ("lineitem", "orders", "part", "supplier")
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load([f"{sf_dir}/{name}.parquet" for name in names])
    )
    state = files.agg(F.count(F.lit(1)), F.sum("length"), F.max("modificationTime")).first()
    key = (spark.conf.get("spark.app.id"), sf_dir, *state)
    with _cache_lock:
        return _cache.setdefault(key, Layers(spark, sf_dir))
