"""Registered queries, each run over whole tables, and the SQL that checks them."""

from __future__ import annotations

import sys
from collections.abc import Callable, Mapping
from dataclasses import replace
from pathlib import Path
from uuid import uuid4

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import oracle  # noqa: E402
from parcelflow import functions as fn  # noqa: E402
from parcelflow import operators as op  # noqa: E402
from parcelflow import sources  # noqa: E402
from parcelflow.plans import marts, proxy  # noqa: E402
from parcelflow.plans.medallion import SOURCE_COLUMN  # noqa: E402
from parcelflow.plans.proxy import SPEC, Layers  # noqa: E402

try:  # The folders of these operators may be absent; everything else works without them.
    import corpus_pipeline  # noqa: E402
    from parcelflow.llm import queries as corpus  # noqa: E402
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "parcelflow.llm"):
        raise
    corpus_pipeline = corpus = None

YEARS = (1998, 2001)
LAST_YEARS = (2000, 2001)
YEAR = 2000
# Lines of a file of the checked extract, and the least number of its files.
CHECKED_LINES, CHECKED_FILES = 500_000, 8
# So few rows make a key hot that the salted joins have hot keys on small tables too.
FEW_ROWS = 500
ID = "identifiant_de_document"
ALL_IDS = ("id_temps", "id_local", "id_commune", "id_mutation")
SHAPE = (
    ID, "valeur_fonciere", "surface_reelle_bati", "nombre_pieces_principales", "surface_terrain",
    "prix_a_payer", "annee", "mois", "jour", "nature_mutation", "type_local", "commune",
    "code_departement",
)

Query = Callable[[SparkSession, str], DataFrame]


def entry(spark: SparkSession) -> DataFrame:
    """Mean price by year and type of property."""
    return queries()["q01_avg_price_year_type"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    on_pages = {"links_extract": _links, "links_latest_per_key": _latest_links}
    own = {name: _on_layers(plan) for name, plan in {**_OPERATORS, **_MARTS}.items()} | on_pages
    if corpus is None:
        return own
    return own | corpus.QUERIES | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for each query that SQL can express."""
    if corpus is None:
        return dict(oracle.STATEMENTS)
    last = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return oracle.STATEMENTS | corpus.SQL | last


def _on_layers(plan: Callable[[Layers], DataFrame]) -> Query:
    return lambda spark, sf_dir: plan(proxy.layers(spark, sf_dir))


def _rounded(df: DataFrame, decimals: Mapping[str, int]) -> DataFrame:
    return df.select(*[
        F.round(c, decimals[c]).alias(c) if c in decimals else F.col(f"`{c}`") for c in df.columns
    ])


def _fresh_folder(layers: Layers, name: str) -> str:
    return f"{sources.shared_dir(layers.spark)}/{name}-{uuid4().hex}"


# Sources and sinks.


def _scan_delimited(layers: Layers) -> DataFrame:
    folder = _fresh_folder(layers, "text")
    _write_text(layers.raw_once, folder)
    return sources.read_delimited(layers.spark, folder)


def _scan_multi_file(layers: Layers) -> DataFrame:
    """Two extracts with their columns in different order, one of them without a column."""
    folder = _fresh_folder(layers, "extracts")
    _write_text(layers.extract(1998), f"{folder}/extrait-1998")
    later = layers.extract(2001).drop("No Volume")
    _write_text(later.select(*[f"`{c}`" for c in reversed(later.columns)]), f"{folder}/extrait-2001")
    return sources.read_extracts(
        layers.spark,
        folder,
        header_per="directory",
        source_column=SOURCE_COLUMN,
        source_pattern=r"extrait-(\d{4})/[^/]*$",
    )


def _checked(layers: Layers) -> tuple[DataFrame, DataFrame]:
    """Good and rejected lines of an extract in which some lines end after their third field."""
    folder, columns = _fresh_folder(layers, "checked"), layers.raw.columns
    line = F.concat_ws("|", *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in columns])
    cut = F.when(F.col("`Nombre de lots`") == "3", F.substring_index(line, "|", 3)).otherwise(line)
    # More lines make more files, so that neither a task that writes one nor one that reads it grows.
    parts = max(CHECKED_FILES, -(-layers.raw.count() // CHECKED_LINES))
    part = F.pmod(F.xxhash64("`Identifiant de document`", "`No Volume`"), F.lit(parts)).alias("part")
    lines = layers.raw.select(part, F.lit(1).alias("place"), cut.alias("value"))
    headers = layers.spark.range(parts).select(
        F.col("id").alias("part"), F.lit(0).alias("place"), F.lit("|".join(columns)).alias("value")
    )
    # Each file holds one part, and its header stands first.
    ordered = lines.unionByName(headers).repartition(parts, "part").sortWithinPartitions("part", "place")
    ordered.select("part", "value").write.partitionBy("part").option("extension", "txt").text(folder)
    return sources.read_checked_extracts(layers.spark, folder)


def _write_text(df: DataFrame, folder: str) -> None:
    with sources.write_settings(df.sparkSession):
        df.write.option("sep", "|").option("header", True).option("extension", "txt").csv(folder)


def _union_years(layers: Layers) -> DataFrame:
    later = layers.extract(2001)
    reordered = later.select(*[f"`{c}`" for c in reversed(later.columns)])
    return sources.union_years([layers.extract(1998), reordered])


def _links(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return sources.extract_links(pages, contains="/t", suffix="", key=F.substring("href", 2, 2))


def _latest_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.latest_per_key(_links(spark, sf_dir))


def _round_trip(layers: Layers, name: str, df: DataFrame, partition: str) -> DataFrame:
    base = _fresh_folder(layers, name)
    # The files of these layers hold rows of few values each, so nothing is shuffled.
    sources.write_layer({name: df}, base, {name: [partition]}, rebalance=False)
    return sources.read_layer(layers.spark, base, [name])[name]


def _gold_round_trip(layers: Layers) -> DataFrame:
    base = _fresh_folder(layers, "gold")
    sources.write_layer(layers.star.tables, base, {"facts": ["annee"]})
    return _left_shape(op.load_star(layers.spark, base))


# Cleaning steps.


def _named(layers: Layers) -> DataFrame:
    return op.normalise_names(layers.raw)


def _typed(layers: Layers) -> DataFrame:
    return op.type_columns(op.normalise_names(op.drop_columns(layers.raw, SPEC.dropped)), SPEC)


def _imputed(layers: Layers) -> DataFrame:
    filled = op.fill_sentinels(_typed(layers), SPEC.sentinels)
    return op.impute_mean(filled, SPEC.mean_columns, SPEC.mean_decimals)


def _carry(layers: Layers) -> DataFrame:
    rows = _typed(layers).select(
        ID, "code_commune", "nombre_de_lots", "valeur_fonciere", "date_mutation"
    )
    return op.carry_forward(rows, [ID, "date_mutation"], ["code_commune"])


def _global_mean(layers: Layers) -> DataFrame:
    return _typed(layers).agg(*[F.round(F.avg(c), 6).alias(c) for c in SPEC.mean_columns])


# Star schema and its joins.


def _dimension(name: str) -> Callable[[Layers], DataFrame]:
    spec = next(d for d in op.DIMENSIONS if d.name == name)
    return lambda layers: op.build_dimension(layers.silver, spec).df


def _keyed(layers: Layers, **options: int) -> DataFrame:
    keyed = op.attach_keys(layers.silver, op.build_dimensions(layers.silver), **options)
    return keyed.select(ID, "valeur_fonciere", *ALL_IDS)


def _inner_shape(star: op.Star) -> DataFrame:
    return marts.star_rows(star, star.facts).select(*SHAPE)


def _left_shape(star: op.Star) -> DataFrame:
    return marts.star_rows(star, star.facts, how="left").select(*SHAPE)


def _mixed_shape(star: op.Star) -> DataFrame:
    return marts.star_rows(star, star.facts, local="left").select(*SHAPE)


def _document_ids(layers: Layers) -> DataFrame:
    documents = layers.silver.select(ID).distinct()
    return op.surrogate_key(documents, "id_document", [ID])


_OPERATORS: dict[str, Callable[[Layers], DataFrame]] = {
    "scan_delimited": _scan_delimited,
    "scan_multi_file": _scan_multi_file,
    "scan_checked": lambda l: _checked(l)[0],
    "scan_rejected": lambda l: _checked(l)[1].select("record", "reason"),
    "union_years": _union_years,
    "sink_bronze_roundtrip": lambda l: _round_trip(l, "bronze", l.bronze, SOURCE_COLUMN),
    "sink_silver_roundtrip": lambda l: _round_trip(l, "silver", l.silver, "annee"),
    "sink_gold_roundtrip": _gold_round_trip,
    "drop_columns": lambda l: op.drop_columns(l.raw, SPEC.dropped),
    "normalise_names": _named,
    "conditional_price": lambda l: op.rebate_price(_typed(l)).select(
        ID, "code_departement", "valeur_fonciere", "prix_a_payer"
    ),
    "filter_in": lambda l: l.silver.where(F.col("type_local").isin("Maison", "Appartement")),
    "filter_between": lambda l: l.silver.where(F.col("annee").between(*YEARS)),
    "filter_positive": lambda l: l.silver.where(F.col("nombre_de_lots") > 0),
    "cast_lenient": lambda l: _typed(l).select(ID, *SPEC.int_columns, *SPEC.double_columns),
    "parse_date": lambda l: _named(l).select(
        ID, fn.lenient_date(F.col("date_mutation")).alias("date_mutation")
    ),
    "decimal_comma": lambda l: _named(l).select(
        ID, fn.lenient_double(F.col("valeur_fonciere"), decimal_comma=True).alias("valeur_fonciere")
    ),
    "date_parts": lambda l: op.date_parts(_typed(l)).select(
        ID, "date_mutation", "annee", "mois", "jour"
    ),
    "date_from_parts": lambda l: l.star.tables["dim_temps"].select(
        "id_temps", fn.date_from_parts("annee", "mois", "jour").alias("date_transaction")
    ),
    "date_from_parts_concat": lambda l: l.star.tables["dim_temps"].select(
        "id_temps",
        fn.concat_date(F.col("annee"), fn.pad_with_case("mois"), fn.pad_with_case("jour")).alias(
            "date_transaction"
        ),
    ),
    "zero_pad_case": lambda l: l.star.tables["dim_temps"].select(
        "id_temps",
        fn.pad_with_case("mois").alias("mois_texte"),
        fn.pad_with_case("jour").alias("jour_texte"),
    ),
    "zero_pad_right": lambda l: l.star.tables["dim_temps"].select(
        "id_temps",
        fn.pad_with_right("annee", 4).alias("annee_texte"),
        fn.pad_with_right("mois").alias("mois_texte"),
        fn.pad_with_right("jour").alias("jour_texte"),
    ),
    "safe_ratio": lambda l: l.star.facts.select(
        ID,
        "valeur_fonciere",
        "nombre_pieces_principales",
        fn.safe_ratio(F.col("valeur_fonciere"), F.col("nombre_pieces_principales")).alias(
            "valeur_par_piece"
        ),
    ),
    "fill_sentinels": lambda l: op.fill_sentinels(_typed(l), SPEC.sentinels),
    "impute_mean": lambda l: _imputed(l).select(ID, *SPEC.mean_columns),
    # Missing dates sort first, so the date before a missing one is missing too.
    "carry_lag_parity": lambda l: _typed(l).select(ID, "valeur_fonciere", "date_mutation"),
    "carry_forward": _carry,
    "rebate_price": lambda l: op.rebate_price(_imputed(l)).select(
        ID, "code_departement", "valeur_fonciere", "prix_a_payer"
    ),
    "rebate_price_table": lambda l: op.rebate_price(
        _imputed(l), _typed(l).where("code_departement % 2 = 0").select("code_departement")
    ).select(ID, "code_departement", "valeur_fonciere", "prix_a_payer"),
    "dedup_rows": lambda l: op.dedup_rows(_named(l)),
    "clean_full": lambda l: op.clean(l.raw, SPEC),
    "join_left_multikey": _keyed,
    "join_left_multikey_salted": lambda l: _keyed(l, broadcast_bytes=0, hot_rows=FEW_ROWS),
    "join_left_nullsafe": lambda l: _keyed(l, null_safe=True),
    "join_inner_star": lambda l: _inner_shape(l.star),
    "join_inner_star_salted": lambda l: _inner_shape(replace(l.star, broadcast_bytes=0, hot_rows=FEW_ROWS)),
    "join_left_star": lambda l: _left_shape(l.star),
    "join_mixed_star": lambda l: _mixed_shape(l.star),
    "join_full_outer": lambda l: marts.full_outer_rows(l.star).select(*SHAPE),
    # Written from the time dimension in SQL; Spark gives it the plan of the inner star.
    "join_dim_first": lambda l: _inner_shape(l.star),
    "agg_global_mean": _global_mean,
    "distinct_tuples": lambda l: l.silver.select(
        "type_local", "code_type_local", "surface_reelle_bati", "nombre_pieces_principales"
    ).distinct(),
    "count_over_all": lambda l: op.with_total(
        l.star.facts.select(ID, "valeur_fonciere"), "total_lignes"
    ),
    "dim_temps": _dimension("dim_temps"),
    "dim_commune": _dimension("dim_commune"),
    "dim_mutation": _dimension("dim_mutation"),
    "dim_local": _dimension("dim_local"),
    "surrogate_key_distributed": _document_ids,
    "facts": lambda l: l.star.facts,
    "star_integrity": lambda l: op.star_integrity(l.star.facts),
}

def _sketched(star: op.Star, by: list[str]) -> DataFrame:
    """Whether the rank of each sketched median is as near to the middle as the sketch promises.

    Twice the published error, which holds in 99 of 100 cases, holds in practically all.
    """
    errors = marts.sketched_median_error(star, by)
    within = F.col("error") <= 2 * op.rank_error()
    return errors.select(*by, "n", within.alias("proche_du_milieu"))


_MARTS: dict[str, Callable[[Layers], DataFrame]] = {
    "q00_flat_extract": lambda l: marts.flat_extract(l.star, *YEARS),
    "q01_avg_price_year_type": lambda l: _rounded(
        marts.mean_price_per_year_and_type(l.star), {"valeur_fonciere_moyenne": 4}
    ),
    "q02_top_communes": lambda l: marts.top_communes(l.star),
    "q02_top_communes_year": lambda l: marts.top_communes(l.star, year=YEAR),
    "q03_avg_surface_type": lambda l: _rounded(
        marts.mean_surface_per_type(l.star), {"surface_moyenne": 4}
    ),
    "q04_median_month": lambda l: _rounded(
        marts.median_price_per_month(l.star), {"valeur_fonciere_mediane": 4}
    ),
    "q04_sketched_month": lambda l: _sketched(l.star, ["annee", "mois"]),
    "q04_sketched_year": lambda l: _sketched(l.star, ["annee"]),
    "q05_count_year": lambda l: marts.sales_per_year(l.star),
    "q06_price_m2_rank": lambda l: _rounded(
        marts.price_per_square_metre(l.star), {"prix_m2_moyen": 4}
    ),
    "q07_top1_commune": lambda l: marts.dearest_sale_per_commune(l.star, YEAR),
    "q08_market_share": lambda l: _rounded(marts.market_share(l.star), {"part_marche": 8}),
    "q09_dept_gap": lambda l: _rounded(
        marts.department_gap(l.star),
        {"prix_moyen_departement": 4, "prix_moyen_national": 4, "ecart_moyenne": 4},
    ),
    "q10_moving_avg": lambda l: _rounded(
        marts.moving_mean_per_type(l.star), {"prix_moy": 4, "moyenne_mobile_3_ans": 4}
    ),
    "q11_attractiveness": lambda l: _rounded(
        marts.commune_attractiveness(l.star), {"valeur_fonciere_total": 4}
    ),
    "q12a_top5_year": lambda l: marts.top_sales_per_year(l.star),
    "q12b_yoy_change": lambda l: _rounded(
        marts.yearly_change_per_department(l.star),
        {"prix_moyn": 4, "prix_annee_precd": 4, "taux_variation": 8},
    ),
    "q13_flat_extract_v2": lambda l: marts.flat_extract_v2(l.star, *YEARS),
    "q14_extract_left_local": lambda l: marts.extract_keeping_untyped(l.star, *LAST_YEARS),
    "q15_inner_star_count": lambda l: marts.inner_star_count(l.star),
    "q16_left_star": lambda l: marts.left_star(l.star),
    "q17_left_star_year": lambda l: marts.left_star_with_year(l.star),
    "q18_full_outer_time": lambda l: marts.full_outer_on_time(l.star),
    "q19_dim_first": lambda l: marts.extract_from_time(l.star),
    "q20_count_over_facts": lambda l: marts.count_on_every_fact(l.star),
}
