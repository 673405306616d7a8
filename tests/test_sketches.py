"""Merged sketches against exact ranks."""

import random

from parcelflow.operators import merge_sketches, rank_error, rank_errors, sketch_values, with_quantiles
from parcelflow.plans import marts
from parcelflow.plans.proxy import layers


def test_merged_sketches_are_within_their_error(spark):
    rng = random.Random(1)
    rows = [(d % 3, d, rng.lognormvariate(0, 2)) for d in range(60) for _ in range(500)]
    df = spark.createDataFrame([*rows, (0, 1, None), (9, 9, None)], "month int, day int, value double")
    daily = sketch_values(df, ["month", "day"], "value", 200)
    assert daily.count() == 60 and daily.where("n <> 500").count() == 0
    monthly = merge_sketches(daily, ["month"], 200)
    for share in (0.1, 0.5, 0.9):
        found = with_quantiles(monthly, {"q": share})
        errors = rank_errors(df, found, ["month"], "value", "q", share).collect()
        assert len(errors) == 3 and all(e.n == 10000 and e.error <= 2 * rank_error(200) for e in errors)


def test_small_groups_are_exact_and_null_keys_are_groups(spark):
    rows = [(None, float(v)) for v in (5, 1, 3)] + [(1, 7.0)] + [(2, 4.0)] * 10
    df = spark.createDataFrame(rows, "k int, value double")
    found = with_quantiles(sketch_values(df, ["k"], "value"), {"q": 0.5})
    assert {r.k: r.q for r in found.collect()} == {None: 3.0, 1: 7.0, 2: 4.0}
    errors = rank_errors(df, found, ["k"], "value", "q", 0.5)
    assert {r.k: r.error for r in errors.collect()} == {None: 0.0, 1: 0.0, 2: 0.0}


def test_stored_sketches_answer_without_facts(spark, sf_dir):
    star = layers(spark, sf_dir).star
    stored = type(star)({**star.tables, "prix_par_jour": star.sketches, "facts": star.facts.limit(0)}, star.dim_bytes)
    months = {(r.annee, r.mois): r.n for r in marts.sketched_median(stored).collect()}
    years = {r.annee: r.n for r in marts.sketched_median(stored, ["annee"]).collect()}
    assert months and {y: sum(n for (a, _), n in months.items() if a == y) for y in years} == years
