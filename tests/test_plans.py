"""Shape of physical plans: what is pushed down, and what may reach one task."""

import re

import __spark_entry__ as registry
import oracle
import pytest
from parcelflow.operators import attach_keys, build_dimensions, build_star, impute_mean, surrogate_key, with_total
from parcelflow.plans import marts, proxy
from parcelflow.plans.medallion import SOURCE_COLUMN
from parcelflow.sources import write_layer


@pytest.fixture(scope="module")
def layers(spark, sf_dir):
    return proxy.layers(spark, sf_dir)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def below_single_partition(plan):
    """The operators right below exchanges to a single partition."""
    lines = plan.splitlines()
    return [lines[i + 1] for i, line in enumerate(lines) if "Exchange SinglePartition" in line]


@pytest.mark.parametrize("name", sorted(oracle.STATEMENTS))
def test_no_pairs_of_all_rows(spark, sf_dir, name):
    plan = plan_of(registry.queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "Python" not in plan and "InPandas" not in plan


def test_only_partial_aggregates_reach_one_task(layers):
    frames = [
        impute_mean(layers.silver, ["surface_terrain", "valeur_fonciere"]),
        with_total(layers.star.facts, "n"),
        surrogate_key(
            layers.silver.select("identifiant_de_document").distinct(),
            "id", ["identifiant_de_document"],
        ),
    ]
    for df in frames:
        below = below_single_partition(plan_of(df))
        assert below and all("HashAggregate" in line for line in below)


def test_means_read_their_columns_only(layers):
    plan = plan_of(impute_mean(layers.silver, ["surface_terrain"]).select("jour"))
    assert "surface_terrain" not in plan
    plan = plan_of(impute_mean(layers.silver, ["surface_terrain"]).select("surface_terrain"))
    for schema in re.findall(r"ReadSchema: (struct<[^>]*>)", plan):
        assert schema == "struct<surface_terrain:double>"


def test_text_is_written_from_the_tables_alone(spark, sf_dir):
    """One pass over the lines and no bronze for a query that reads its rows once; the same rows as with bronze."""
    fresh = proxy.Layers(spark, sf_dir)
    plan = plan_of(fresh.raw_once)
    assert len(re.findall(r"FileScan parquet \[l_orderkey", plan)) == 1
    without = registry._scan_delimited(fresh)
    assert "bronze" not in fresh._built
    assert fresh.bronze.count() == without.count() > fresh.table("lineitem").count()
    assert "lineitem.parquet" not in plan_of(fresh.raw_once)
    with_bronze = registry._scan_delimited(fresh)
    assert without.exceptAll(with_bronze).isEmpty() and with_bronze.exceptAll(without).isEmpty()


def test_one_extract_reads_no_file_of_another(layers):
    plan = plan_of(layers.extract(1998))
    assert re.search(r"PartitionFilters: \[[^\]]*annee_source", plan)


def test_year_filter_skips_partitions(layers):
    plan = plan_of(marts.flat_extract(layers.star, 2000, 2001))
    assert "PartitionFilters: [isnotnull(annee" in plan


def test_filters_reach_the_scan(spark, sf_dir):
    assert "PushedFilters: [IsNotNull(nombre_de_lots), GreaterThan(nombre_de_lots,0)]" in plan_of(
        registry.queries()["filter_positive"](spark, sf_dir)
    )
    built = plan_of(registry.queries()["q03_avg_surface_type"](spark, sf_dir))
    assert "valeur_fonciere" not in built


def test_small_dimensions_are_broadcast(layers):
    assert plan_of(marts.inner_star_count(layers.star)).count("BroadcastHashJoin") == 4


def test_communes_are_looked_up_after_aggregation(layers):
    plan = plan_of(marts.top_communes(layers.star))
    join = plan.index("BroadcastHashJoin")
    assert "HashAggregate(keys=[id_commune" in plan[join:]


def test_top_k_limits_before_the_shuffle(layers):
    plan = plan_of(marts.top_sales_per_year(layers.star))
    assert plan.count("WindowGroupLimit") == 2
    below = plan[plan.index("WindowGroupLimit"):]
    assert "Join [id_commune" in plan and "Join [id_commune" not in below
    assert "Join [id_local" in plan and "Join [id_local" not in below


def test_totals_are_counted_without_joins(layers):
    """Beyond the four lookups of the rows themselves no join is planned, and counts agree."""
    for df in (marts.flat_extract(layers.star, 1998, 2001), marts.extract_from_time(layers.star)):
        assert plan_of(df).count("BroadcastHashJoin") == 4
        total = next(c for c in df.columns if c in ("total_lignes", "nombre_de_lignes"))
        assert df.first()[total] == df.count()


@pytest.mark.parametrize("name", ["q06_price_m2_rank", "q11_attractiveness"])
def test_ranks_send_no_rows_to_one_task(spark, sf_dir, name):
    """What is left of single partitions holds one row per range or a small final sort."""
    plan = plan_of(registry.queries()[name](spark, sf_dir))
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert all("__range" in line for line in windows)


def test_rows_of_few_values_are_written_without_a_shuffle(spark, layers, tmp_path, monkeypatch):
    hints = []
    monkeypatch.setattr(type(layers.raw), "hint", lambda df, name, *args: hints.append(name) or df)
    write_layer({"bronze": layers.bronze}, str(tmp_path), {"bronze": [SOURCE_COLUMN]}, rebalance=False)
    build_star(layers.silver)
    assert hints == []
    build_star(layers.silver, broadcast_bytes=0)
    assert hints == ["rebalance"]


def test_salted_keys_shuffle_no_column_that_is_not_asked_for(layers):
    dimensions = build_dimensions(layers.silver)
    keyed = attach_keys(layers.silver, dimensions, broadcast_bytes=0, hot_rows=50).select("id_local")
    plan = keyed._jdf.queryExecution().optimizedPlan().toString()
    # One hash of all columns below the joins, not one more in each of them.
    assert sum("xxhash64" in line and "surface_terrain" in line for line in plan.splitlines()) == 1
