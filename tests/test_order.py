"""Sorted queries return their rows in the order they promise; bags cannot show that."""

import __spark_entry__ as registry
import pytest

# Sort columns of each query; a minus means largest first.
ORDERS = {
    "q01_avg_price_year_type": ("-annee", "-valeur_fonciere_moyenne"),
    "q02_top_communes": ("-nombre_transaction", "commune"),
    "q02_top_communes_year": ("-nombre_transaction", "commune"),
    "q03_avg_surface_type": ("-surface_moyenne",),
    "q04_median_month": ("-annee", "-mois"),
    "q05_count_year": ("-annee",),
    "q07_top1_commune": ("-valeur_fonciere", "commune"),
    "q08_market_share": ("-annee", "-part_marche"),
    "q09_dept_gap": ("-ecart_moyenne",),
    "q10_moving_avg": ("type_local", "-annee"),
    "q11_attractiveness": ("scrore_attractivite", "commune", "annee"),
    "q12a_top5_year": ("-annee", "-valeur_fonciere"),
    "q12b_yoy_change": ("code_departement", "-annee"),
    "q16_left_star": ("date_transaction",),
    "q17_left_star_year": ("annee", "date_transaction"),
    "q18_full_outer_time": ("annee", "date_transaction"),
}


def in_order(before, after, order):
    """Whether ``after`` may follow ``before``; missing values come first, or last if reversed."""
    for column in order:
        name = column.lstrip("-")
        one, other = before[name], after[name]
        if one == other:
            continue
        ascends = one is None or (other is not None and one < other)
        return ascends != column.startswith("-")
    return True


@pytest.mark.parametrize("name", sorted(ORDERS))
def test_rows_come_in_order(spark, sf_dir, name):
    rows = registry.queries()[name](spark, sf_dir).collect()
    assert len(rows) > 1
    assert all(in_order(a, b, ORDERS[name]) for a, b in zip(rows, rows[1:]))


def test_a_lost_order_is_seen(spark, sf_dir):
    order = ORDERS["q17_left_star_year"]
    rows = registry.queries()["q17_left_star_year"](spark, sf_dir).collect()[::-1]
    assert not all(in_order(a, b, order) for a, b in zip(rows, rows[1:]))
