"""Ordered operators and skewed joins: the large-table path against a plain window or join."""

import random

import pytest
from parcelflow.operators import (
    carry_last, dimension_join, exact_median, rank_over_all, running_total, surrogate_key, top_k,
)
from parcelflow.operators import joins
from pyspark.sql import Window
from pyspark.sql import functions as F


def bag(df):
    return sorted(map(repr, (tuple(r) for r in df.select(*sorted(df.columns)).collect())))


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one group, NULL groups and values, many ties."""
    pick = random.Random(7)
    rows = []
    for n in range(3000):
        group = 1 if n % 3 == 0 else pick.choice([None, *range(2, 40)])
        value = None if pick.random() < 0.1 else float(pick.choice([5, 5, 5, *range(60)]))
        rows.append((n, group, value))
    return spark.createDataFrame(rows, "n int, g int, v double").repartition(6, "n").cache()


@pytest.fixture(autouse=True)
def several_ranges(spark):
    """Without coalescing there really are several ranges."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_surrogate_key(skewed):
    keys = skewed.select("g", "v").distinct()
    window = Window.orderBy(F.col("g").asc(), F.col("v").asc())
    plain = keys.withColumn("id", F.row_number().over(window))
    ours = surrogate_key(keys, "id", ["g", "v"])
    assert bag(ours) == bag(plain)
    assert dict(ours.dtypes)["id"] == "bigint"


def test_running_total(skewed):
    window = Window.partitionBy("g").orderBy(F.col("n").desc())
    upto = F.sum(F.col("n") % 5).over(window.rowsBetween(Window.unboundedPreceding, 0))
    plain = skewed.withColumn("upto", upto)
    ours = running_total(skewed, [F.col("n").desc()], F.col("n") % 5, "upto", ["g"])
    assert bag(ours) == bag(plain)


def test_rank_with_ties_and_nulls(skewed):
    window = Window.orderBy(F.col("v").desc())
    plain = skewed.withColumn("place", F.rank().over(window))
    ours = rank_over_all(skewed, {"place": "v"})
    assert bag(ours) == bag(plain)


def test_two_ranks(skewed):
    plain = skewed.withColumns({
        "a": F.rank().over(Window.orderBy(F.col("v").desc())),
        "b": F.rank().over(Window.orderBy(F.col("g").desc())),
    })
    assert bag(rank_over_all(skewed, {"a": "v", "b": "g"})) == bag(plain)


def test_carry_last(skewed):
    window = Window.partitionBy("g").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    plain = skewed.withColumn("v", F.last("v", ignorenulls=True).over(window))
    assert bag(carry_last(skewed, "v", ["n"], ["g"])) == bag(plain)


def test_carry_last_over_all(skewed):
    window = Window.orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    plain = skewed.withColumn("v", F.last("v", ignorenulls=True).over(window))
    assert bag(carry_last(skewed, "v", ["n"])) == bag(plain)


def test_exact_median(skewed):
    plain = skewed.groupBy("g").agg(F.percentile("v", 0.5).alias("m"))
    assert bag(exact_median(skewed, ["g"], "v", "m")) == bag(plain)


def test_exact_median_of_signed_and_close_values(spark):
    pick = random.Random(3)
    wide = [(g, pick.uniform(-1, 1) * 10 ** pick.randint(-3, 9)) for g in (1, 2) for _ in range(401 + g)]
    close = [(3, 1000 + n / 1e6) for n in range(500)]
    df = spark.createDataFrame(wide + close, "g int, v double").repartition(4)
    plain = df.groupBy("g").agg(F.percentile("v", 0.5).alias("m"))
    got = {r.g: r.m for r in exact_median(df, ["g"], "v", "m").collect()}
    assert got == pytest.approx({r.g: r.m for r in plain.collect()}, rel=1e-14)


def test_median_of_a_group_of_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 4.0), (2, 7.0)], "g int, v double")
    assert bag(exact_median(df, ["g"], "v", "m")) == ["(1, None)", "(2, 5.5)"]


def test_empty_input(spark):
    none = spark.createDataFrame([], "g int, v double")
    assert surrogate_key(none, "id", ["g"]).count() == 0
    assert exact_median(none, ["g"], "v", "m").count() == 0
    assert rank_over_all(none, {"r": "v"}).count() == 0


@pytest.mark.parametrize("pieces", [[], ["n"], ["part"], ["one"]])
@pytest.mark.parametrize("k", [1, 3, 200])
def test_top_k(skewed, pieces, k):
    rows = skewed.withColumns({"part": F.col("n") % 7, "one": F.lit(1)})
    window = Window.partitionBy("g").orderBy(F.desc("v"), "n")
    plain = rows.withColumn("p", F.row_number().over(window)).where(f"p <= {k}").drop("p")
    ours = top_k(rows, ["g"], "v", ["n"], k, pieces)
    assert bag(ours) == bag(plain)
    assert "WindowGroupLimit" in plan_of(ours)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_join_of_grouped_rows(spark, skewed):
    dim = spark.createDataFrame([(k, f"name {k}") for k in range(1, 30)], "g int, name string")
    counts = skewed.groupBy("g").count()
    large = dimension_join(counts, dim, ["g"], "inner", broadcast_bytes=0, grouped=True)
    assert bag(large) == bag(counts.join(dim, "g"))


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_salted_join(spark, skewed, how, null_safe):
    dim = spark.createDataFrame([(None, "none")] + [(k, f"name {k}") for k in range(1, 30)], "g int, name string")
    same = skewed.g.eqNullSafe(dim.g) if null_safe else skewed.g == dim.g
    plain = skewed.join(dim, same, how).drop(dim.g)
    small = dimension_join(skewed, dim, ["g"], how, null_safe)
    large = dimension_join(skewed, dim, ["g"], how, null_safe, broadcast_bytes=0, hot_rows=150)
    assert bag(small) == bag(plain)
    assert bag(large) == bag(plain)


def test_hot_keys_are_spread(skewed):
    hot = {r.g: r["__salts"] for r in joins.hot_keys(skewed, ["g"], 150).df.collect()}
    assert hot[1] == 7 and len(hot) <= 20


def test_hot_keys_of_cheap_facts_are_the_same(spark, skewed):
    missing = spark.range(400).select(F.lit(None).cast("int").alias("g"))
    facts = skewed.select("g").union(missing)
    for hot_rows in (1, 150, 10_000):
        plain = joins.hot_keys(facts, ["g"], hot_rows).df
        assert bag(joins.hot_keys(facts, ["g"], hot_rows, cheap=True).df) == bag(plain)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("hot_rows", [150, 10_000])
def test_hashed_join_sorts_nothing(spark, skewed, how, null_safe, hot_rows):
    """Neither with hot keys nor without them; without them there are no salts."""
    dim = spark.createDataFrame([(None, "none")] + [(k, f"name {k}") for k in range(1, 30)], "g int, name string")
    options = {"broadcast_bytes": 0, "hot_rows": hot_rows, "counted": skewed}
    large = dimension_join(skewed, dim, ["g"], how, null_safe, hashed_bytes=joins.HASHED_BYTES, **options)
    plan = large._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    assert ("__salt" in plan) == (hot_rows == 150)
    assert bag(large) == bag(dimension_join(skewed, dim, ["g"], how, null_safe))
    # A dimension too large for that is merged.
    merged = dimension_join(skewed, dim, ["g"], how, null_safe, **options)
    assert "ShuffledHashJoin" not in merged._jdf.queryExecution().executedPlan().toString()


def test_copies_of_a_hot_row_are_spread(spark):
    """Copies in different tasks get different salts."""
    copies = spark.range(0, 8000, 1, 8).select(F.lit(1).alias("g"), F.lit("same").alias("v"))
    numbers = copies.withColumn("h", joins.row_hash(copies)).select("h").distinct()
    assert numbers.count() == 8
    dim = spark.createDataFrame([(1, "one")], "g int, name string")
    joined = dimension_join(copies, dim, ["g"], "inner", broadcast_bytes=0, hot_rows=1000)
    assert joined.where("name = 'one'").count() == 8000


def test_carry_last_splits_copies(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        copies = spark.range(0, 8000, 1, 8).select(F.lit(2).alias("n"), F.lit(None).cast("int").alias("v"))
        first = spark.createDataFrame([(1, 7)], "n int, v int")
        filled = carry_last(first.union(copies), "v", ["n"])
        assert filled.groupBy("n", "v").count().orderBy("n").collect() == [(1, 7, 1), (2, 7, 8000)]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_dimension_join_keeps_every_row_of_a_missing_key(spark, skewed):
    none = spark.createDataFrame([], "g int, name string")
    for limit in (0, 1 << 20):
        joined = dimension_join(skewed, none, ["g"], "left", broadcast_bytes=limit)
        assert joined.count() == skewed.count()
        assert joined.where(F.col("name").isNotNull()).count() == 0
