"""Cleaning and star of a small fixture with results worked out by hand."""

import datetime

import pytest
from parcelflow.functions import lenient_int
from parcelflow.operators import (
    CleanSpec, build_dimension, build_star, carry_forward, clean, dedup_rows, impute_mean,
    normalise_names, rebate_price, star_integrity, DIMENSIONS,
)
from parcelflow.plans import marts
from parcelflow.sources import read_delimited
from pyspark.sql import functions as F

LINES = """\
Identifiant de document|Date mutation|Nature mutation|Valeur fonciere|Code postal|Commune|Code departement|Code commune|No Volume|Nombre de lots|Code type local|Type local|Surface reelle bati|Nombre pieces principales|Surface terrain
D1|05/01/2023|Vente|100000,50|75001|PARIS 01|75|101||1|2|Appartement|40|2|
D2|06/02/2023|Vente||20000|AJACCIO|2A|4||0|1|Maison|120|5|300
D3||Vente|200000,00|69001||69|381|||||||500
D1|05/01/2023|Vente|100000,50|75001|PARIS 01|75|101||1|2|Appartement|40|2|
"""


@pytest.fixture(scope="module")
def cleaned(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    (folder / "ventes-2023.txt").write_text(LINES)
    return clean(read_delimited(spark, str(folder))).cache()


@pytest.fixture(scope="module")
def star(cleaned):
    return build_star(cleaned)


def rows_of(df, key="identifiant_de_document"):
    return {row[key]: row for row in df.collect()}


def test_clean_rows(cleaned):
    rows = rows_of(cleaned)
    assert cleaned.count() == 3
    assert "no_volume" not in cleaned.columns
    d1, d2, d3 = rows["D1"], rows["D2"], rows["D3"]
    assert (d1.date_mutation, d2.date_mutation, d3.date_mutation) == (
        datetime.date(2023, 1, 5), datetime.date(2023, 2, 6), None,
    )
    assert [(r.annee, r.mois, r.jour) for r in (d1, d2, d3)] == [
        (2023, 1, 5), (2023, 2, 6), (None, None, None),
    ]
    # The repeated line weighs in the means.
    assert d2.valeur_fonciere == pytest.approx(400001.0 / 3)
    assert d3.surface_reelle_bati == pytest.approx(200 / 3)
    assert (d3.nombre_pieces_principales, d1.surface_terrain) == (3.0, 400.0)
    assert (d3.commune, d2.code_departement, d3.nombre_de_lots) == ("inconnu", 0, None)
    assert d1.prix_a_payer == pytest.approx(97000.485)
    assert d2.prix_a_payer == d2.valeur_fonciere


def test_clean_types(cleaned):
    types = dict(cleaned.dtypes)
    for name in ("valeur_fonciere", "surface_reelle_bati", "nombre_pieces_principales", "prix_a_payer"):
        assert types[name] == "double"
    for name in ("code_departement", "code_postal", "nombre_de_lots", "annee", "jour"):
        assert types[name] == "int"
    assert types["date_mutation"] == "date"


def test_kept_columns_take_part_in_dedup(spark, tmp_path):
    (tmp_path / "a.txt").write_text(LINES.replace("\nD1|", "\nD1x|", 1))
    raw = read_delimited(spark, str(tmp_path))
    assert clean(raw).count() == 4
    names = [c for c in normalise_names(raw).columns if c != "identifiant_de_document" and c != "no_volume"]
    assert clean(raw, CleanSpec(kept=names)).count() == 3


def test_column_of_nulls_is_left(spark):
    df = spark.createDataFrame([(None, 1.0), (None, None)], "a double, b double")
    assert [tuple(r) for r in impute_mean(df, ["a", "b"]).collect()] == [(None, 1.0), (None, 1.0)]


def test_lenient_int_follows_a_plain_cast_without_ansi(spark):
    texts = ["12", "12.7", " 12 ", "12.", ".5", "-3.9", "2A", "1e3", "99999999999", "", None, "+7",
             "07", "12.7a", "\t5\n", "-", "."]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        rows = df.select("s", F.col("s").cast("int").alias("plain"), lenient_int(F.col("s")).alias("ours"))
        got = rows.collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert [r.ours for r in got] == [r.plain for r in got]


def test_star_ids(star):
    facts = rows_of(star.facts)
    ids = {k: (r.id_temps, r.id_local, r.id_commune, r.id_mutation) for k, r in facts.items()}
    assert ids == {"D1": (2, 2, 2, 3), "D2": (3, 3, 1, 2), "D3": (None, None, 3, None)}


def test_star_joins(star):
    assert marts.inner_star_count(star).first()[0] == 2
    assert marts.left_star(star).count() == 3
    assert marts.full_outer_on_time(star).count() == 4
    assert {r.nombre_de_lignes for r in marts.full_outer_on_time(star).collect()} == {4}


def test_null_safe_ids(cleaned):
    facts = rows_of(build_star(cleaned, null_safe=True).facts)
    d3 = facts["D3"]
    assert (d3.id_temps, d3.id_local, d3.id_commune, d3.id_mutation) == (1, 1, 3, 1)


def test_star_integrity(star):
    rows = {r.dimension: (r.matched, r.missing) for r in star_integrity(star.facts).collect()}
    assert rows == {
        "dim_temps": (2, 1), "dim_commune": (3, 0), "dim_mutation": (2, 1), "dim_local": (2, 1),
    }


def test_ids_do_not_depend_on_partitions(cleaned):
    for spec in DIMENSIONS:
        once = build_dimension(cleaned.repartition(1), spec).df
        again = build_dimension(cleaned.repartition(7), spec).df
        assert sorted(map(str, once.collect())) == sorted(map(str, again.collect()))
        ids = sorted(r[0] for r in once.select(spec.id_column).collect())
        assert ids == list(range(1, len(ids) + 1))


def test_carry_forward(spark):
    df = spark.createDataFrame(
        [("a", 1, None), ("a", 2, "x"), ("a", 3, None), ("b", 1, None), ("b", 2, "y"), ("b", 4, None)],
        "g string, n int, v string",
    )
    got = carry_forward(df, ["n"], ["g"], "v")
    assert sorted((r.g, r.n, r.v or "") for r in got.collect()) == [
        ("a", 1, ""), ("a", 2, "x"), ("a", 3, "x"), ("b", 1, ""), ("b", 2, "y"), ("b", 4, "y"),
    ]


def test_rebate_by_a_table_equals_the_list(spark):
    df = spark.createDataFrame([(75, 100.0), (13, 100.0), (None, 50.0), (77, None)], "code_departement int, valeur_fonciere double")
    listed = spark.createDataFrame([(75,), (77,), (75,), (None,)], "code int")
    by_table, by_list = rebate_price(df, listed), rebate_price(df, (75, 77))
    assert by_table.columns == by_list.columns
    assert sorted(map(str, by_table.collect())) == sorted(map(str, by_list.collect()))


def test_dedup_compares_rows_only_where_equal_ones_meet(spark):
    rows = [("a", 0.0, None), ("a", -0.0, None), ("b", float("nan"), 1), ("b", float("nan"), 1), (None, None, None),
            (None, None, None), ("", None, None), ("a", 0.0, 1)]
    df = spark.createDataFrame(rows, "`a.b` string, v double, n int").repartition(3)
    once = dedup_rows(df)
    assert sorted(map(str, once.collect())) == sorted(map(str, df.dropDuplicates().collect()))
    assert dedup_rows(df, ["n"]).count() == 2
    plan = dedup_rows(df)._jdf.queryExecution().executedPlan().toString()
    # No hash table of whole rows is built before the shuffle, and there is one shuffle of them.
    assert "Aggregate" not in plan[plan.index("Exchange hashpartitioning"):]
    assert plan.count("Exchange hashpartitioning") == 1


def test_columns_that_clean_adds_are_not_shuffled(spark):
    header, *lines = [line.split("|") for line in LINES.splitlines()]
    raw = spark.createDataFrame([[v or None for v in line] for line in lines], ", ".join(f"`{c}` string" for c in header))
    plan = clean(raw)._jdf.queryExecution().executedPlan().toString()
    dealt = next(line for line in plan.splitlines() if "Exchange hashpartitioning" in line)
    assert "valeur_fonciere" in dealt and "prix_a_payer" not in dealt and "jour" not in dealt
    assert clean(raw).columns[-4:] == ["annee", "mois", "jour", "prix_a_payer"]
    # A raw column that is replaced keeps no rows apart.
    assert clean(raw.withColumn("mois", F.monotonically_increasing_id().cast("string"))).count() == 3
