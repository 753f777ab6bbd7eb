"""Registered queries against their SQL twins on the smallest dataset.

The whole registry is compared with ``python -m tests.oracle``; here one query
per mechanism keeps the suite short. Set ALL_QUERIES=1 to run every one.
"""

import os

import pytest

from tests.oracle import compare, duck
from tidegate import catalog

SF = "/root/testdata/sf0.001"
SHORT = (
    "a6_dry_run_sample", "a17_json_lines_events", "b4_quality_filters", "b8_column_registry", "b12_cast_by_type", "c9_boolean_composition",
    "c12_named_splits", "d7_shared_account_user_bands", "d9_prior_event_velocity", "d10_prior_min_gap", "d18_star_assembly", "e9_outcome_blocks",
    "e14_backtest_report", "e15_monthly_rule_report", "e16_band_by_month", "f1_roc_auc", "f12_depth_metrics", "f13_band_report",
    "g10_rare_categories", "g14_outlier_scan", "h9_component_census", "h11_user_projection", "h14_bad_neighbours",
    "i1_weight_of_evidence", "i17_cohort_report", "j1_span_pairing", "j3_uncovered_time", "f25_run_summary",
)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()) if os.environ.get("ALL_QUERIES") else SHORT)
def test_query_matches_its_sql(spark, con, name):
    message, ok = compare(spark, con, name, catalog.queries()[name], catalog.oracle_sql()[name], SF)
    spark.catalog.clearCache()
    assert ok, message


def test_entry_and_registry(spark):
    import __spark_entry__ as driver
    assert driver.entry(spark).count() > 0
    assert set(driver.oracle_sql()) <= set(driver.queries())
