"""Plans and contracts of the registered queries."""

import re

import pytest

import __spark_entry__ as entry
from massloom.operators import groups as G
from massloom.operators.resolve import settle_in_order
from massloom.plans.catalog import groups as C
from massloom.plans.catalog.groups import hits

D = "/root/testdata/sf0.001"
BAND = ["band_join_pairs", "j1_library_candidates", "j6_isobaric_neighbours", "j8_isotope_pairs", "j9_adduct_known", "j10_in_source", "j19_xic", "j22_inclusion",
        "j24_safe_exclusions", "j36_fragmentation_audit", "j43_coisolation", "j44_resolution_at_risk", "w1_cluster_mz", "flagship_filtered_areas"]


@pytest.mark.parametrize("key", BAND)
def test_no_nested_loop(spark, key, capsys):
    entry.queries()[key](spark, D).explain("simple")
    plan = capsys.readouterr().out
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scan_reads_only_needed_columns(spark, capsys):
    entry.queries()["a9_pooled_cv"](spark, D).explain("formatted")
    plan = capsys.readouterr().out
    assert "l_extendedprice" in plan and "l_comment" not in plan and "l_shipdate" not in plan


def test_entry_and_keys(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", ["w1_cluster_mz", "j1_library_candidates", "a16_presence"])
def test_result_is_independent_of_partitioning(spark, key):
    def rows():
        return sorted(map(str, entry.queries()[key](spark, D).collect()))

    first = rows()
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert rows() == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_growing_sides_are_shuffled_not_collected(spark):
    """A few rows stand for a table whose compressed files look small: no side but one row per run may be broadcast."""
    from pyspark.sql import functions as F

    from massloom.functions import ions
    from massloom.operators import groups as G
    from massloom.operators.band import Band, band_join

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    a = spark.createDataFrame([(1, 5.0)], "ia int, x double")
    b = spark.createDataFrame([(1, 5.1)], "ib int, y double")
    assert "Broadcast" not in plan(band_join(a, b, [Band("x", "y", 0.2)]))
    g = spark.createDataFrame([("A", "+", i, 500.0 + i, 5.0, 0.4, "[M+H]+", [500.0]) for i in range(3)],
                              "study_id string, polarity string, group_id long, mz double, rt double, fwhm double, adduct string, fragments array<double>")
    for pairs, small in ((G.in_source_pairs(g), 1), (G.adduct_pairs_known(g, ions.adduct_table(spark)), 2)):
        assert plan(pairs).count("BroadcastHashJoin") <= small, plan(pairs)
    assert {tuple(r) for r in G.in_source_pairs(g).select("parent", "fragment").collect()} == {(1, 0), (2, 0)}
    shared = g.withColumn("mz", F.lit(500.0))
    assert G.adduct_pairs_known(shared, ions.adduct_table(spark)).count() == 6


def test_hits_are_not_left_to_be_merged_by_bytes(spark):
    """Features are dealt by number before they become two wide rows each."""
    plan = hits(spark, D)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [group_id" in plan


def test_split_peaks_collect_no_groups_on_the_driver(spark, monkeypatch):
    """Groups grow with the data; however small their files, joins to them are shuffled."""
    for frame in (C.split_groups(spark, D), C.split_areas(spark, D)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin [group_id" in plan or "SortMergeJoin [b#" in plan
        assert not re.search(r"BroadcastHashJoin \[(group_id|b)#", plan)
    nodes = []
    monkeypatch.setattr(G, "settle_in_order", lambda pairs, order, ends, info, *a, **k: nodes.append(info) or settle_in_order(pairs, order, ends, info, *a, **k))
    G.merge_split_peaks(C.split_groups(spark, D), C.split_areas(spark, D), C.S.injections(spark, D))
    assert not re.search(r"BroadcastHashJoin \[study_id#\d+, polarity#\d+, group_id#", nodes[0]._jdf.queryExecution().executedPlan().toString())
