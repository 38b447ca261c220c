"""Registered queries against their SQL on the small data."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry
from parity import compare, duck

SMALL = "/root/testdata/sf0.001"
# End points of each chain; tests/parity.py runs all queries.
CHECKED = [
    "load_csv", "profile_key_uniqueness", "profile_coverage", "dq_report", "dq_department_sales", "clean_transactions",
    "clean_reconciliation", "weekly_product_store_sales", "households", "campaigns", "promo_week_uplift",
    "uplift_summary", "placement_highlights", "placebo_test", "subcat_weeks", "cannibalisation_summary",
    "did_panel_never", "did_panel_other_times", "did_per_campaign", "event_study", "household_rfm", "churn_backtest",
    "retention_by_quarter", "redemption_by", "redemption_chi_square", "dim_household", "bi_promo_uplift",
    "weekly_category_report", "weekly_headline", "weekly_movers", "kpi_discount_describe", "kpi_net_extra", "rec_summary",
    "ab_sample_size", "ab_sample_size_exact", "ab_assignment", "weekly_refresh",
]


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, con, name):
    verdict = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SMALL)[0]
    assert verdict == "ok"


def test_every_query_of_the_analysis_has_sql():
    assert set(entry.queries()) - set(entry.oracle_sql()) <= set(entry._corpus()[0])
