"""Analytical queries on the star, each a function of a ``Star``.

Two rules hold throughout. Communes are looked up after facts have been
aggregated per ``id_commune``, since that dimension grows with the data: a
commune with very many sales is reduced before it is shuffled. Sorted extracts
order by further columns after the asked ones, so that a frequent date, or a
missing one, can be split over several sort tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.functions import date_from_parts, exact_sum, mean_of_partials, safe_ratio
from parcelflow.operators.joins import row_hash
from parcelflow.operators.ordered import exact_median, rank_over_all, top_k, with_total
from parcelflow.operators.sketches import merge_sketches, rank_errors, with_quantiles
from parcelflow.operators.star import DIMENSIONS, FACTS, Star

VALUE = "valeur_fonciere"
_MEASURES = (VALUE, "surface_reelle_bati", "nombre_pieces_principales")
_TIE_BREAKS = (
    "identifiant_de_document",
    VALUE,
    "id_commune",
    "id_mutation",
    "id_local",
    "surface_terrain",
)


def flat_extract(star: Star, first: int = 2021, last: int = 2024) -> DataFrame:
    """Q0: sales of some years with every dimension, and their number on each row."""
    sales = star_rows(star, star.facts_of_years(first, last), years=(first, last))
    shown = (*_MEASURES, "commune", "code_departement", "nature_mutation", "annee", "type_local")
    counted = _in_every_dimension(star, (first, last))
    return _with_date(sales, "date_transaction_f", shown, "total_lignes", counted)


def mean_price_per_year_and_type(star: Star) -> DataFrame:
    """Q1: mean value by year and type of property."""
    mean = F.avg(VALUE).alias("valeur_fonciere_moyenne")
    means = _dated_and_typed(star).groupBy("annee", "type_local").agg(mean)
    return means.orderBy(F.desc("annee"), F.desc("valeur_fonciere_moyenne"))


def top_communes(star: Star, k: int = 10, year: int | None = None) -> DataFrame:
    """Q2: communes with the most sales, over all years or in one."""
    facts = star.facts
    if year is not None:
        facts = _in_years(star, star.facts_of_years(year, year), (year, year))
    per_id = facts.groupBy("id_commune").agg(F.count(VALUE).alias("ventes"))
    per_commune = (
        star.lookup(per_id, "dim_commune", ["commune"], grouped=True)
        .groupBy("commune")
        .agg(F.sum("ventes").alias("nombre_transaction"))
    )
    return per_commune.orderBy(F.desc("nombre_transaction"), "commune").limit(k)


def mean_surface_per_type(star: Star) -> DataFrame:
    """Q3: mean built surface by type of property."""
    typed = star.lookup(star.facts, "dim_local", ["type_local"])
    means = typed.groupBy("type_local").agg(F.avg("surface_reelle_bati").alias("surface_moyenne"))
    return means.orderBy(F.desc("surface_moyenne"))


def median_price_per_month(star: Star) -> DataFrame:
    """Q4: median value by year and month."""
    dated = star.lookup(star.facts.select("id_temps", VALUE), "dim_temps", ["annee", "mois"])
    medians = exact_median(dated, ["annee", "mois"], VALUE, "valeur_fonciere_mediane")
    return medians.orderBy(F.desc("annee"), F.desc("mois"))


def sketched_median(star: Star, by: Sequence[str] = ("annee", "mois")) -> DataFrame:
    """Q4 by merging the sketches of days: ``by``, ``n`` and the median within their rank error.

    Facts are not read if the star has stored sketches.
    """
    dated = star.lookup(star.sketches, "dim_temps", list(by), grouped=True)
    medians = with_quantiles(merge_sketches(dated, by), {"valeur_fonciere_mediane": 0.5})
    return medians.select(*by, "n", "valeur_fonciere_mediane").orderBy(*[F.desc(c) for c in by])


def sketched_median_error(star: Star, by: Sequence[str] = ("annee", "mois")) -> DataFrame:
    """How far the rank of each sketched median is from the middle, counted on the facts."""
    dated = star.lookup(star.facts.select("id_temps", VALUE), "dim_temps", list(by))
    medians = sketched_median(star, by)
    return rank_errors(dated, medians, by, VALUE, "valeur_fonciere_mediane", 0.5)


def sales_per_year(star: Star) -> DataFrame:
    """Q5: number of sales by year."""
    dated = star.lookup(star.facts, "dim_temps", ["annee"])
    counts = dated.groupBy("annee").agg(F.count(VALUE).alias("nombre_transaction"))
    return counts.orderBy(F.desc("annee"))


def price_per_square_metre(star: Star) -> DataFrame:
    """Q6: price per built square metre by type and commune, ranked over all."""
    built = star.facts.where(F.col("surface_reelle_bati") > 0)
    per_id = (
        star.lookup(built, "dim_local", ["type_local"])
        .groupBy("id_commune", "type_local")
        .agg(exact_sum(VALUE).alias("valeur"), exact_sum("surface_reelle_bati").alias("surface"))
    )
    ratio = safe_ratio(F.sum("valeur").cast("double"), F.sum("surface").cast("double"))
    prices = (
        star.lookup(per_id, "dim_commune", ["commune", "code_departement"], grouped=True)
        .groupBy("type_local", "commune", "code_departement")
        .agg(ratio.alias("prix_m2_moyen"))
    )
    return rank_over_all(prices, {"rang": "prix_m2_moyen"})


def dearest_sale_per_commune(star: Star, year: int = 2023) -> DataFrame:
    """Q7: highest value in each commune in one year; the first of a ranking is a maximum."""
    sales = _in_years(star, star.facts_of_years(year, year), (year, year))
    per_id = sales.groupBy("id_commune").agg(F.max(VALUE).alias(VALUE))
    named = star.lookup(per_id, "dim_commune", ["commune"], grouped=True)
    return named.groupBy("commune").agg(F.max(VALUE).alias(VALUE)).orderBy(F.desc(VALUE), "commune")


def market_share(star: Star, types: Sequence[str] = ("Maison", "Appartement")) -> DataFrame:
    """Q8: sales of houses and flats by year, and their share of both."""
    counts = (
        _dated_and_typed(star)
        .where(F.col("type_local").isin(*types))
        .groupBy("annee", "type_local")
        .agg(F.count(VALUE).alias("nombre_transactions"))
    )
    year = F.sum("nombre_transactions").over(Window.partitionBy("annee"))
    shares = counts.withColumn("total_anne", year).withColumn(
        "part_marche", F.col("nombre_transactions").cast("double") / F.col("total_anne")
    )
    return shares.orderBy(F.desc("annee"), F.desc("part_marche"))


def department_gap(star: Star) -> DataFrame:
    """Q9: mean value by department against the unweighted mean of those means."""
    per_id = _partial_means(star.facts, ["id_commune"])
    means = (
        star.lookup(per_id, "dim_commune", ["code_departement"], grouped=True)
        .groupBy("code_departement")
        .agg(mean_of_partials("somme", "nombre").alias("prix_moyen_departement"))
    )
    avg_of_group_avgs = means.agg(F.avg("prix_moyen_departement")).scalar()
    gaps = means.withColumn("prix_moyen_national", avg_of_group_avgs).withColumn(
        "ecart_moyenne", F.col("prix_moyen_departement") - F.col("prix_moyen_national")
    )
    return gaps.orderBy(F.desc("ecart_moyenne"))


def moving_mean_per_type(star: Star, years: int = 3) -> DataFrame:
    """Q10: mean value by type and year, and its mean over the last years listed."""
    means = (
        _dated_and_typed(star).groupBy("annee", "type_local").agg(F.avg(VALUE).alias("prix_moy"))
    )
    # One row per year and type reaches this window.
    recent = Window.partitionBy("type_local").orderBy("annee").rowsBetween(1 - years, 0)
    moving = means.withColumn(f"moyenne_mobile_{years}_ans", F.avg("prix_moy").over(recent))
    return moving.orderBy("type_local", F.desc("annee"))


def commune_attractiveness(star: Star) -> DataFrame:
    """Q11: half the sum of two ranks of each commune and year, by sales and by value."""
    dated = star.lookup(star.facts, "dim_temps", ["annee"])
    per_id = dated.groupBy("id_commune", "annee").agg(
        F.count(VALUE).alias("ventes"), exact_sum(VALUE).alias("valeur")
    )
    totals = (
        star.lookup(per_id, "dim_commune", ["commune"], grouped=True)
        .groupBy("commune", "annee")
        .agg(
            F.sum("ventes").alias("nombre_transactions_imo"),
            F.sum("valeur").alias("valeur_fonciere_total"),
        )
    )
    ranked = rank_over_all(
        totals,
        {
            "rang_transactions_imo": "nombre_transactions_imo",
            "rang_valeur": "valeur_fonciere_total",
        },
    )
    scored = ranked.withColumns(
        {
            "valeur_fonciere_total": F.col("valeur_fonciere_total").cast("double"),
            "scrore_attractivite": F.expr("(rang_transactions_imo + rang_valeur) div 2"),
        }
    )
    return scored.orderBy("scrore_attractivite", "commune", "annee")


def top_sales_per_year(star: Star, k: int = 5) -> DataFrame:
    """Q12a: the sales of highest value of every year."""
    # An id that is not NULL has its dimension row, so names wait until few rows are left.
    facts = star.facts.dropna(subset=["id_temps", "id_local", "id_commune"])
    sales = star.lookup(facts, "dim_temps", ["annee"])
    ties = [c for c in _TIE_BREAKS if c != VALUE]
    first = top_k(sales, ["annee"], VALUE, ties, k, pieces=["id_temps"])
    typed = star.lookup(first, "dim_local", ["type_local"], grouped=True)
    named = star.lookup(typed, "dim_commune", ["commune"], grouped=True)
    return named.select("annee", "commune", "type_local", VALUE).orderBy(
        F.desc("annee"), F.desc(VALUE)
    )


def yearly_change_per_department(star: Star) -> DataFrame:
    """Q12b: change of the mean value of each department from the year listed before."""
    dated = star.lookup(star.facts, "dim_temps", ["annee"])
    per_id = _partial_means(dated, ["id_commune", "annee"])
    means = (
        star.lookup(per_id, "dim_commune", ["code_departement"], grouped=True)
        .groupBy("annee", "code_departement")
        .agg(mean_of_partials("somme", "nombre").alias("prix_moyn"))
    )
    before = F.lag("prix_moyn").over(Window.partitionBy("code_departement").orderBy("annee"))
    changes = means.withColumn("prix_annee_precd", before).withColumn(
        "taux_variation",
        safe_ratio(F.col("prix_moyn") - F.col("prix_annee_precd"), F.col("prix_annee_precd")),
    )
    return changes.orderBy("code_departement", F.desc("annee"))


def flat_extract_v2(star: Star, first: int = 2021, last: int = 2024) -> DataFrame:
    """Q13: as Q0, with its columns in another order."""
    sales = star_rows(star, star.facts_of_years(first, last), years=(first, last))
    shown = (*_MEASURES, "commune", "code_departement", "nature_mutation", "type_local", "annee")
    counted = _in_every_dimension(star, (first, last))
    return _with_date(sales, "date_transaction", shown, "nombre_de_lignes", counted)


def extract_keeping_untyped(star: Star, first: int = 2023, last: int = 2024) -> DataFrame:
    """Q14: sales of some years, also those without a known property type."""
    facts = star.facts_of_years(first, last)
    sales = star_rows(star, facts, local="left", years=(first, last))
    shown = (*_MEASURES, "commune", "code_departement", "nature_mutation", "type_local", "annee")
    return _with_date(sales, "date_transaction", shown)


def inner_star_count(star: Star) -> DataFrame:
    """Q15: number of sales found in every dimension."""
    return star_rows(star, star.facts).agg(F.count(F.lit(1)).alias("nombre_de_lignes"))


def left_star(star: Star) -> DataFrame:
    """Q16: every sale with what is known of it, by date."""
    shown = (*_MEASURES, "commune", "code_departement", "nature_mutation", "type_local")
    return _left_extract(star, shown, "total_lignes", by_year=False)


def left_star_with_year(star: Star) -> DataFrame:
    """Q17: as Q16 with the year, by year and date."""
    shown = (*_MEASURES, "commune", "code_departement", "nature_mutation", "type_local", "annee")
    return _left_extract(star, shown, "nombre_de_lignes", by_year=True)


def full_outer_on_time(star: Star) -> DataFrame:
    """Q18: as Q17, with the dates on which nothing was sold."""
    rows = full_outer_rows(star)
    counted = star.facts.select("id_temps").unionByName(_unsold_dates(star).select("id_temps"))
    shown = (*_MEASURES, "commune", "code_departement", "nature_mutation", "type_local", "annee")
    return _sorted_extract(rows, shown, "nombre_de_lignes", counted, by_year=True)


def extract_from_time(star: Star) -> DataFrame:
    """Q19: sales of all years, asked from the time dimension."""
    sales = star_rows(star, star.facts)
    shown = (VALUE, "code_departement", "nature_mutation", "type_local")
    counted = _in_every_dimension(star)
    return _with_date(sales, "date_transaction", shown, "nombre_de_lignes", counted)


def count_on_every_fact(star: Star) -> DataFrame:
    """Q20: the number of facts, once for each of them."""
    return with_total(star.facts.select(), "nombre_de_lignes")


def star_rows(
    star: Star,
    facts: DataFrame,
    how: str = "inner",
    local: str | None = None,
    years: tuple[int, int] | None = None,
) -> DataFrame:
    """Facts with the columns of all four dimensions."""
    rows = star.lookup(facts, "dim_temps", ["annee", "mois", "jour"], how)
    if years is not None:
        rows = rows.where(F.col("annee").between(*years))
    rows = star.lookup(rows, "dim_mutation", ["nature_mutation"], how)
    rows = star.lookup(rows, "dim_local", ["type_local"], local or how)
    return star.lookup(rows, "dim_commune", ["commune", "code_departement"], how)


def full_outer_rows(star: Star) -> DataFrame:
    """Facts with the columns of all four dimensions, and the dates without a fact.

    A full outer join on time cannot broadcast either side. Each fact meets at
    most one date, so the result is a left join and the dates nothing meets.
    """
    sales = star_rows(star, star.facts, how="left")
    return sales.unionByName(_unsold_dates(star), allowMissingColumns=True)


def _unsold_dates(star: Star) -> DataFrame:
    sold_on = star.facts.select("id_temps").distinct()
    return star.tables["dim_temps"].join(sold_on, "id_temps", "left_anti")


def _in_years(star: Star, facts: DataFrame, years: tuple[int, int]) -> DataFrame:
    dated = star.lookup(facts, "dim_temps", ["annee"])
    return dated.where(F.col("annee").between(*years))


def _dated_and_typed(star: Star) -> DataFrame:
    dated = star.lookup(star.facts, "dim_temps", ["annee"])
    return star.lookup(dated, "dim_local", ["type_local"])


def _partial_means(facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    return facts.groupBy(*keys).agg(F.sum(VALUE).alias("somme"), F.count(VALUE).alias("nombre"))


def _in_every_dimension(star: Star, years: tuple[int, int] | None = None) -> DataFrame | None:
    """As many rows as the inner star has: an id that is not NULL has its dimension row.

    None if years are asked of facts that do not hold theirs.
    """
    if years is not None and "annee" not in star.tables[FACTS].columns:
        return None
    facts = star.facts if years is None else star.facts_of_years(*years)
    return facts.dropna(subset=[spec.id_column for spec in DIMENSIONS])


def _with_date(
    rows: DataFrame,
    date: str,
    shown: Sequence[str],
    total: str | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    extract = rows.select(*shown, date_from_parts("annee", "mois", "jour").alias(date))
    return extract if total is None else with_total(extract, total, counted)


def _left_extract(star: Star, shown: Sequence[str], total: str, by_year: bool) -> DataFrame:
    # Ids are unique in a dimension, so a left join keeps the number of facts.
    return _sorted_extract(star_rows(star, star.facts, how="left"), shown, total, star.facts, by_year)


def _sorted_extract(
    rows: DataFrame, shown: Sequence[str], total: str, counted: DataFrame, by_year: bool
) -> DataFrame:
    dated = rows.withColumn("date_transaction", date_from_parts("annee", "mois", "jour"))
    first = ["annee", "date_transaction"] if by_year else ["date_transaction"]
    counted_rows = with_total(dated, total, counted).withColumn("tie", row_hash(dated))
    sorted_rows = counted_rows.orderBy(*first, *_TIE_BREAKS, "tie")
    return sorted_rows.select(*shown, "date_transaction", total)
