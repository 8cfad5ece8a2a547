"""Plan properties that keep the queries fit for large inputs."""

import pytest
from support import SMALL

import __spark_entry__ as entry
from ebbflow.plans.bindings import Inputs

HEAVY = """a01_od_month a03_hourly_population a08_daily_flow a28_totals_by_dimension a31_weighted_quantiles
a54_distance_quantiles_by_age j01_both_cells p02_both_ends_filter t03_top_pairs_by_hour x05_points_in_zones""".split()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", HEAVY)
def test_no_python_no_cross_join(spark, name):
    text = plan(entry.queries()[name](spark, SMALL))
    for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text, word


def test_flagship_shuffles_once(spark):
    text = plan(entry.queries()["a01_od_month"](spark, SMALL))
    assert text.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in text


def test_scan_reads_only_what_is_needed(spark):
    text = plan(entry.queries()["s07_parquet_projection"](spark, SMALL))
    assert "ReadSchema: struct<c_nationkey:int,c_mktsegment:string>" in text


def test_filter_reaches_the_scan(spark):
    df = Inputs(spark, SMALL).table("lineitem").filter("l_quantity > 30").select("l_orderkey")
    assert "GreaterThan(l_quantity,30.0)" in plan(df)


def test_top_k_is_trimmed_before_the_shuffle(spark):
    text = plan(entry.queries()["t03_top_pairs_by_hour"](spark, SMALL))
    assert "WindowGroupLimit" in text and "Partial" in text
    assert "TakeOrderedAndProject" in plan(entry.queries()["t02_top_pairs"](spark, SMALL))


@pytest.mark.parametrize("name", ["j08_file_sizes", "j08_months_without_file"])
def test_months_beside_files_read_the_stored_movement(spark, name):
    """The trips are placed and summed once, for the files and the series alike."""
    text = plan(entry.queries()[name](spark, SMALL))
    assert "l_shipdate" not in text and "o_admdong_cd" not in text
