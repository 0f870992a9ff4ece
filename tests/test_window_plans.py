"""Window queries look at the visible days only, from the scan on."""

import os

import pytest

from tidemark.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
WINDOWED = [
    "summary_kpis", "dau_insights", "code_insights", "code_milestones", "code_milestones_3000",
    "prompts_per_user", "acceptance_rate", "mode_mix", "visible_days", "last_14_days",
    "latest_org_metrics", "agent_insights", "adoption_overview", "agent_trend",
    "agent_trend_available", "visible_user_daily", "visible_language_daily", "window_user_summary",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


def scans(spark, name):
    """Scans of the log in the plan, before any reuse."""
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.split("\n") if "FileScan" in line and "events" in line]


@pytest.mark.parametrize("name", WINDOWED)
def test_the_log_is_scanned_once_from_the_first_day_on(spark, name):
    (scan,) = scans(spark, name)
    pushed = scan.split("PushedFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(ts," in pushed


@pytest.mark.parametrize("name", ["language_ranking", "language_series", "language_pivot"])
def test_languages_are_scanned_for_scores_and_series(spark, name):
    found = scans(spark, name)
    assert len(found) == 2 and all("GreaterThanOrEqual(ts," in s for s in found)
