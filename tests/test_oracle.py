"""Queries against their SQL twins. All of them run with EBBFLOW_ALL_ORACLES=1."""

import os
import sys

import pytest
from support import SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check import compare, connect  # noqa: E402

SAMPLE = """a01_od_month a02_od_month_purpose a09_flow_marginals a10_dense_slice a24_age_bridge a31_weighted_quantiles
a34_log_histogram a38_detection_summary a50_band_consistency a54_distance_quantiles_by_age j11_code_reconciliation
k06_daytype_counts p17_iso_week s13_ingest_run t03_top_pairs_by_hour v02_null_counts x01_split_decades
x05_points_in_zones z01_stream_ingest""".split()
NAMES = sorted(entry.oracle_sql()) if os.environ.get("EBBFLOW_ALL_ORACLES") else SAMPLE


def test_every_query_has_an_oracle():
    """Of the operators outside the optional package; what that leaves out SQL cannot express."""
    assert set(entry.catalog.ORACLE) == set(entry.catalog.QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_is_the_flagship(spark):
    assert entry.entry(spark).columns[:2] == ["date", "hour"]


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, name):
    result = compare(entry.queries()[name](spark, SMALL), connect(SMALL), entry.oracle_sql()[name])
    assert result.startswith("ok") and "types" not in result, result
