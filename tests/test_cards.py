import pytest
from pyspark.sql import functions as F

from tidemark.fields import (
    ACCEPTED, ACTIVE_USERS, AGENT_1D, AGENT_28D, AGENT_EDIT, AGENT_MODE, ASK_MODE, EDIT_MODE,
    GENERATED, MONTHLY_AGENT, ORG_METRICS, PROMPTS,
)
from tidemark.operators import kpis, trends, views

FUNCTIONS = [
    kpis.summary_kpis, kpis.latest_org_metrics, kpis.dau_insights, kpis.code_insights,
    kpis.code_milestones, kpis.agent_insights, kpis.adoption_overview,
]


def daily(spark, *days, columns=()):
    """One row per dict; the named columns exist as nulls where not given."""
    names = sorted({k for d in days for k in d} | set(columns))
    schema = ", ".join(["day string"] + [f"{n} bigint" for n in names])
    data = [(f"2025-01-{i + 1:02d}", *[d.get(n) for n in names]) for i, d in enumerate(days)]
    return views.daily_summary(spark.createDataFrame(data, schema))


@pytest.mark.parametrize("fn", FUNCTIONS, ids=lambda f: f.__name__)
def test_no_rows_no_cards(spark, fn):
    assert fn(daily(spark, {}).where("false")).count() == 0


@pytest.mark.parametrize("fn", FUNCTIONS, ids=lambda f: f.__name__)
def test_cards_per_organization_equal_separate_runs(spark, fn):
    a = daily(spark, {PROMPTS: 5, GENERATED: 90, ACCEPTED: 9}, {PROMPTS: 5, GENERATED: 4})
    b = daily(spark, {PROMPTS: 7, AGENT_EDIT: 1}, {AGENT_MODE: 3, GENERATED: 1, ACCEPTED: 1})
    both = a.withColumn("org", F.lit("a")).unionByName(b.withColumn("org", F.lit("b")))
    got = {r.org: tuple(r)[1:] for r in fn(both, by=["org"]).collect()}
    assert got == {"a": tuple(fn(a).first()), "b": tuple(fn(b).first())}


def test_summary(spark):
    r = kpis.summary_kpis(daily(
        spark,
        {ACTIVE_USERS: 3, PROMPTS: 5, GENERATED: 10, ACCEPTED: 4, AGENT_MODE: 1, ASK_MODE: 3},
        {ACTIVE_USERS: 4, PROMPTS: None, GENERATED: 0, ACCEPTED: 0, AGENT_MODE: 0, ASK_MODE: 0},
    )).first()
    assert (r.days, r.avg_dau, r.total_prompts, r.prompts_per_day) == (2, 4, 5, 3)
    assert (r.acceptance_rate, r.agent_mode_share) == (40.0, 25.0)


def test_rates_are_zero_without_a_base(spark):
    r = kpis.summary_kpis(daily(spark, {GENERATED: 0, ACCEPTED: 3})).first()
    assert (r.acceptance_rate, r.agent_mode_share) == (0.0, 0.0)


def test_latest_keeps_nulls(spark):
    df = daily(spark, {MONTHLY_AGENT: 5, AGENT_1D: 1}, {MONTHLY_AGENT: None, AGENT_1D: 0})
    r = kpis.latest_org_metrics(df).first()
    assert (r.latest_day, r[MONTHLY_AGENT], r[AGENT_1D]) == ("2025-01-02", None, 0)


def test_earliest_day_wins_ties_and_null_never_wins(spark):
    r = kpis.dau_insights(daily(
        spark, {ACTIVE_USERS: None, PROMPTS: 1}, {ACTIVE_USERS: 2, PROMPTS: 4},
        {ACTIVE_USERS: 2, PROMPTS: 4}, {ACTIVE_USERS: 1, PROMPTS: 2},
    )).first()
    assert (r.peak_dau, r.peak_dau_day) == (2, "2025-01-02")
    assert (r.peak_prompt_intensity, r.peak_prompt_intensity_day) == (2.0, "2025-01-02")
    assert r.avg_prompts_per_user == 2  # 11 / 5
    zero = kpis.dau_insights(daily(spark, {ACTIVE_USERS: 0}, {ACTIVE_USERS: 0})).first()
    assert zero.peak_dau_day == "2025-01-01" and zero.avg_prompts_per_user == 0


@pytest.mark.parametrize("days,best", [
    # rate counts only among days with 80 generated or more
    ([(100, 10), (10, 9), (200, 60)], ("2025-01-03", 30.0, 60)),
    # none that large: any generating day
    ([(10, 1), (0, 50), (20, 10), (2, 1)], ("2025-01-03", 50.0, 10)),
    # none at all: most accepted, shown with rate zero
    ([(0, 1), (0, 7), (0, 7)], ("2025-01-02", 0.0, 7)),
])
def test_best_efficiency_day(spark, days, best):
    r = kpis.code_milestones(daily(spark, *[{GENERATED: g, ACCEPTED: a} for g, a in days])).first()
    assert (r.best_day, r.best_rate, r.best_accepted) == best


def test_milestone_threshold_is_a_parameter(spark):
    df = daily(spark, {GENERATED: 5, ACCEPTED: 5}, {GENERATED: 50, ACCEPTED: 1})
    assert kpis.code_milestones(df, meaningful=10).first().best_day == "2025-01-02"


def test_code_insights_peaks(spark):
    r = kpis.code_insights(daily(
        spark, {GENERATED: 5, ACCEPTED: 1, AGENT_EDIT: 2}, {GENERATED: 9, ACCEPTED: 0, AGENT_EDIT: 2},
    )).first()
    assert (r.peak_generation_day, r.peak_acceptance_day, r.peak_agent_edit_day) == (
        "2025-01-02", "2025-01-01", "2025-01-01",
    )
    assert (r.total_agent_edit, r.acceptance_rate) == (4, 1 / 14 * 100)


@pytest.mark.parametrize("monthly,month28,reach", [
    (10, 5, 50.0), (0, 5, None), (10, 0, None), (None, 5, None), (10, None, None),
])
def test_cloud_reach(spark, monthly, month28, reach):
    df = daily(spark, {MONTHLY_AGENT: monthly, AGENT_28D: month28})
    r = kpis.agent_insights(df).first()
    assert (r.latest_28d, r.cloud_reach) == (month28, reach)


def test_adoption(spark):
    df = daily(spark, {AGENT_MODE: 1, ASK_MODE: 1}, {AGENT_MODE: 0, AGENT_EDIT: 4}, columns=ORG_METRICS)
    r = kpis.adoption_overview(df).first()
    assert (r.window_days, r.agent_days, r.total_agent_edit, r.agent_mode_share) == (2, 1, 4, 50.0)
    assert r.has_cloud_metrics is False and r[MONTHLY_AGENT] is None


def test_trends(spark, rows):
    df = daily(
        spark,
        {ACTIVE_USERS: 2, PROMPTS: 3, GENERATED: 4, ACCEPTED: 1, AGENT_MODE: 1, EDIT_MODE: 3, AGENT_1D: 1},
        {ACTIVE_USERS: 0, PROMPTS: 3, GENERATED: 0, ACCEPTED: 1, AGENT_MODE: 0, EDIT_MODE: 0},
        columns=ORG_METRICS,
    )
    assert rows(trends.prompts_per_user(df), "prompts_per_user") == [(0.0,), (1.5,)]
    assert rows(trends.code_activity(df), "acceptance_rate") == [(0.0,), (25.0,)]
    assert rows(trends.mode_mix(df), "agent_ratio", "ask_ratio", "plan_ratio", "custom_ratio") == [
        (0.0, 0.0, 0.0, 0.0), (25.0, 0.0, 75.0, 0.0),
    ]
    assert rows(trends.agent_trend(df), "day", "active_users_1d") == [
        ("2025-01-01", 1), ("2025-01-02", None),
    ]
    assert rows(trends.agent_trend_available(df)) == [(True,)]
    assert rows(trends.agent_trend_available(df.where("day > '2025-01-01'"))) == [(False,)]
    assert rows(trends.agent_trend_available(df.where("false"))) == [(False,)]
