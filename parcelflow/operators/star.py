"""Star schema: four numbered dimensions, one fact table, checks of its keys."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parcelflow.operators.joins import BROADCAST_BYTES, HOT_ROWS, dimension_join, hot_keys, row_hash
from parcelflow.operators.ordered import surrogate_key
from parcelflow.operators.sketches import ACCURACY, sketch_values
from parcelflow.sources.layers import layer_tables, read_layer
from parcelflow.sources.staging import Staged, keep, measure, stage


@dataclass(frozen=True)
class DimensionSpec:
    """A dimension: its key columns, which also order its ids, and its id column."""

    name: str
    columns: tuple[str, ...]
    id_column: str


# Tables of the star and their columns.
DIMENSIONS = (
    DimensionSpec("dim_temps", ("annee", "mois", "jour"), "id_temps"),
    DimensionSpec(
        "dim_commune", ("code_commune", "commune", "code_postal", "code_departement"), "id_commune"
    ),
    DimensionSpec("dim_mutation", ("nature_mutation", "nombre_de_lots"), "id_mutation"),
    DimensionSpec(
        "dim_local",
        ("type_local", "code_type_local", "surface_reelle_bati", "nombre_pieces_principales"),
        "id_local",
    ),
)
FACT_COLUMNS = (
    "identifiant_de_document",
    "id_temps",
    "id_local",
    "id_commune",
    "id_mutation",
    "valeur_fonciere",
    "surface_reelle_bati",
    "nombre_pieces_principales",
    "surface_terrain",
    "prix_a_payer",
)
FACTS = "facts"
SKETCHES = "prix_par_jour"


@dataclass(frozen=True)
class Star:
    """Tables of the star by name, and the measured size of each dimension.

    ``facts`` may hold ``annee`` besides its own columns, as a partition column
    that lets year filters skip files.
    """

    tables: Mapping[str, DataFrame]
    dim_bytes: Mapping[str, int]
    broadcast_bytes: int = BROADCAST_BYTES
    hot_rows: int = HOT_ROWS
    _hot: dict[tuple[str, int], Staged] = field(default_factory=dict, compare=False, repr=False)

    @property
    def sketches(self) -> DataFrame:
        """Sketches of the values of each day, stored ones if there are some."""
        stored = self.tables.get(SKETCHES)
        return sketches_per_day(self.facts) if stored is None else stored

    @property
    def facts(self) -> DataFrame:
        return self.tables[FACTS].drop("annee")

    def facts_of_years(self, first: int, last: int) -> DataFrame:
        """Facts, without those that the partition column shows to be of other years."""
        facts = self.tables[FACTS]
        if "annee" in facts.columns:
            facts = facts.where(F.col("annee").between(first, last)).drop("annee")
        return facts

    def lookup(
        self,
        facts: DataFrame,
        name: str,
        columns: Sequence[str],
        how: str = "inner",
        grouped: bool = False,
    ) -> DataFrame:
        """Add columns of a dimension to rows that hold its id.

        ``grouped`` says that the rows have been aggregated per id.
        """
        spec = next(d for d in DIMENSIONS if d.name == name)
        return dimension_join(
            facts,
            self.tables[name].select(spec.id_column, *columns),
            [spec.id_column],
            how,
            dim_bytes=self.dim_bytes[name],
            broadcast_bytes=self.broadcast_bytes,
            grouped=grouped,
            hot=None if grouped else self._hot_ids(name),
        )

    def _hot_ids(self, name: str) -> Staged | None:
        """Hot ids of a dimension that is not broadcast.

        All such dimensions are counted at the first call, side by side, over all
        facts: an id that is hot among some of them is hot among all.
        """
        large = [s for s in DIMENSIONS if self.dim_bytes[s.name] > self.broadcast_bytes]
        missing = [s for s in large if (s.name, self.hot_rows) not in self._hot]
        if missing:

            def count(spec: DimensionSpec) -> Staged:
                return hot_keys(self.facts, [spec.id_column], self.hot_rows)

            for spec, hot in zip(missing, _side_by_side(self.facts, count, missing)):
                self._hot[spec.name, self.hot_rows] = hot
        return self._hot.get((name, self.hot_rows))


def build_dimension(clean: DataFrame, spec: DimensionSpec, base: str | None = None) -> Staged:
    """Distinct key tuples, numbered in the order of all key columns, NULLs first.

    Written below ``base``, or to the shared folder.
    """
    keys = clean.select(*spec.columns).distinct()
    numbered = surrogate_key(keys, spec.id_column, spec.columns)
    narrow = numbered.withColumn(spec.id_column, F.col(spec.id_column).cast("int"))
    return stage(narrow, spec.name, base=base)


def build_dimensions(clean: DataFrame, base: str | None = None) -> dict[str, Staged]:
    """All dimensions by name; their jobs do not depend on each other and overlap."""

    def build(spec: DimensionSpec) -> Staged:
        return build_dimension(clean, spec, base)

    built = _side_by_side(clean, build, DIMENSIONS)
    return {spec.name: dim for spec, dim in zip(DIMENSIONS, built)}


def _side_by_side(
    df: DataFrame, job: Callable[[DimensionSpec], Staged], specs: Iterable[DimensionSpec]
) -> list[Staged]:
    """Results of a job per dimension, all started at once."""
    specs = list(specs)
    # Each thread runs in a copy of the context, so that it keeps tables in the same scope.
    contexts = [copy_context() for _ in specs]
    run = inheritable_thread_target(df.sparkSession)(lambda context, spec: context.run(job, spec))
    with ThreadPoolExecutor(len(DIMENSIONS)) as pool:
        return list(pool.map(run, contexts, specs))


def attach_keys(
    clean: DataFrame,
    dimensions: Mapping[str, Staged],
    null_safe: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add the id of every dimension to the clean rows.

    By default a key tuple with a NULL matches nothing and its id is NULL.
    """

    def count(spec: DimensionSpec) -> Staged:
        return hot_keys(clean, spec.columns, hot_rows)

    large = [spec for spec in DIMENSIONS if dimensions[spec.name].bytes > broadcast_bytes]
    hot = {spec.name: keys for spec, keys in zip(large, _side_by_side(clean, count, large))}
    # One hash for all salts, so that each join shuffles only the columns that are asked for.
    keyed = clean.withColumn("__row", row_hash(clean)) if large else clean
    for spec in DIMENSIONS:
        dim = dimensions[spec.name]
        keyed = dimension_join(
            keyed,
            dim.df,
            spec.columns,
            "left",
            null_safe,
            dim.bytes,
            broadcast_bytes,
            hot=hot.get(spec.name),
            row="__row" if large else None,
        )
    return keyed.drop("__row")


def build_star(
    clean: DataFrame,
    null_safe: bool = False,
    base: str | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> Star:
    """Build and write the star of a clean table, which is best a written one: it is read often.

    The tables go below ``base``, or to the shared folder.
    """
    dimensions = build_dimensions(clean, base)
    facts = attach_keys(clean, dimensions, null_safe, broadcast_bytes)
    # Facts that meet broadcast dimensions only stay where they are, in the order of the clean table.
    moved = any(dim.bytes > broadcast_bytes for dim in dimensions.values())
    written = keep(facts.select(*FACT_COLUMNS, "annee"), FACTS, ["annee"], base, rebalance=moved)
    tables = {name: dim.df for name, dim in dimensions.items()}
    sizes = {name: dim.bytes for name, dim in dimensions.items()}
    return Star({**tables, FACTS: written}, sizes, broadcast_bytes)


def load_star(
    spark: SparkSession,
    base: str,
    broadcast_bytes: int = BROADCAST_BYTES,
    schemas: Mapping[str, StructType] | None = None,
) -> Star:
    """Read a star from a gold folder and register its tables as temporary views.

    Without ``schemas`` of its tables, the type of the year is fixed and all
    other types are those the files hold.
    """
    names = [*(spec.name for spec in DIMENSIONS), FACTS]
    names += [SKETCHES] if SKETCHES in layer_tables(spark, base) else []
    tables = read_layer(spark, base, names, schemas)
    tables[FACTS] = tables[FACTS].withColumn("annee", F.col("annee").cast("int"))
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    sizes = {spec.name: measure(tables[spec.name]) for spec in DIMENSIONS}
    return Star(tables, sizes, broadcast_bytes)


def sketches_per_day(facts: DataFrame, accuracy: int = ACCURACY) -> DataFrame:
    """``id_temps, n, sketch`` of the values of each day, to be merged into those of longer times."""
    return sketch_values(facts, ["id_temps"], "valeur_fonciere", accuracy)


def star_integrity(facts: DataFrame) -> DataFrame:
    """Facts with and without an id, per dimension."""
    counts = [F.count(F.lit(1)).alias("__facts")]
    counts += [F.count(spec.id_column).alias(spec.name) for spec in DIMENSIONS]
    matched = facts.agg(*counts).unpivot(
        "__facts", [spec.name for spec in DIMENSIONS], "dimension", "matched"
    )
    return matched.select("dimension", "matched", (F.col("__facts") - F.col("matched")).alias("missing"))
