import pytest
from pyspark.sql import functions as F

from tidemark.fields import (
    ACCEPTED, ACTIVE_USERS, AGENT_MODE, FLAG_ACTIVE, FLAG_AGENT, FLAG_PASSIVE, GENERATED, PROMPTS,
)
from tidemark.operators import languages, quality, users, views


def user_days(spark, *data):
    """(day, login, prompts, agent, active, passive)"""
    schema = (f"day string, user_login string, {PROMPTS} bigint, {FLAG_AGENT} boolean, "
              f"{FLAG_ACTIVE} boolean, {FLAG_PASSIVE} boolean")
    return views.user_daily_summary(spark.createDataFrame(data, schema))


@pytest.fixture
def people(spark):
    return user_days(
        spark,
        ("2025-01-01", "zoe", 1, False, True, True), ("2025-01-02", "zoe", 1, False, False, True),
        ("2025-01-01", "amy", 9, True, False, True), ("2025-01-02", "amy", None, None, True, True),
        ("2025-01-02", "bob", 50, False, None, None), ("2025-01-03", "bob", 1, False, False, False),
        ("2025-01-02", "eve", 51, False, False, False), ("2025-01-03", "eve", 0, False, False, False),
    )


def test_user_order_and_ties(people):
    out = users.sort_users(users.window_user_summary(people)).collect()
    # amy and zoe tie on review days; amy has an agent day. bob and eve tie on all counts
    # up to active days and appear on the same day, so the login decides.
    assert [r.user_login for r in out] == ["amy", "zoe", "bob", "eve"]
    amy = out[0]
    assert (amy.active_days, amy[PROMPTS], amy[f"{FLAG_PASSIVE}_days"]) == (2, 9, 2)


def test_earlier_user_wins_a_tie(spark):
    df = user_days(spark, ("2025-01-02", "a", 1, False, False, False), ("2025-01-01", "b", 1, False, False, False))
    out = users.sort_users(users.window_user_summary(df)).collect()
    assert [r.user_login for r in out] == ["b", "a"]


def test_review_engagement(people):
    r = users.review_engagement(users.window_user_summary(people), window_days=28).first()
    assert (r.total_users, r.total_active_days) == (4, 8)
    assert (r.agent_users, r.active_review_users, r.passive_review_users, r.any_review_users) == (
        1, 2, 2, 2,
    )
    assert (r.agent_days, r.active_review_days, r.passive_review_days, r.review_touch_days) == (
        1, 2, 4, 6,
    )
    assert (r.heavy_threshold, r.heavy_reviewers, r.avg_review_days) == (7, 0, 3.0)
    assert (r.passive_review_days_share, r.agent_users_share) == (50.0, 25.0)
    assert r.has_flags and r.has_day_counts


@pytest.mark.parametrize("days,threshold", [(None, 7), (28, 7), (37, 7), (38, 8), (60, 12), (100, 20)])
def test_heavy_threshold(days, threshold):
    assert users.heavy_review_threshold(days) == threshold


def test_missing_flags_are_reported(spark):
    df = spark.createDataFrame(
        [("a", 1, 5)], f"user_login string, active_days bigint, {PROMPTS} bigint"
    )
    r = users.review_engagement(df).first()
    assert (r.has_flags, r.has_day_counts, r.any_review_users) == (False, False, 0)
    assert users.review_engagement(df.where("false")).count() == 0


def test_coverage(people):
    out = users.review_coverage(users.window_user_summary(people)).collect()
    assert {(r.coverage, r.days, r.users, r.ratio) for r in out} == {
        ("Coding agent coverage", 1, 1, 12.5), ("Active review coverage", 2, 2, 25.0),
        ("Passive review coverage", 4, 2, 50.0),
    }


def test_rankings(people, rows):
    summary = users.window_user_summary(people)
    hot = users.review_hotspots(summary)
    assert rows(hot, "rank", "user_login", "review_days", "review_share") == [
        (1, "amy", 3, 150.0), (2, "zoe", 3, 150.0),
    ]
    top = rows(users.top_reviewers(summary, 3), "rank", "user_login", "passive_share")
    assert top == [(1, "amy", 100.0), (2, "zoe", 100.0), (3, "bob", 0.0)]
    compact = rows(users.user_table(summary, rows=2), "rank", "user_login", "capabilities")
    assert compact == [
        (1, "amy", ["Coding agent", "Review active", "Review passive"]),
        (2, "zoe", ["Review active", "Review passive"]),
    ]
    assert users.user_table(summary, compact=False).count() == 4


def test_rankings_per_organization(people, rows):
    both = people.withColumn("org", F.lit("x")).unionByName(
        people.where("user_login != 'amy'").withColumn("org", F.lit("y"))
    )
    summary = users.window_user_summary(both, ["org"])
    out = users.review_hotspots(summary, 1, by=["org"])
    assert rows(out, "org", "rank", "user_login") == [("x", 1, "amy"), ("y", 1, "zoe")]


# --- languages


def scores(spark, *data):
    return spark.createDataFrame(data, "day string, language string, activity_score bigint")


def test_ranking_share_counts_all_languages(spark, rows):
    df = scores(spark, *[("1", f"l{i}", 10 - i) for i in range(8)])
    out = rows(languages.language_ranking(df, 2), "rank", "language", "score", "share")
    assert out == [(1, "l0", 10, 10 / 52 * 100), (2, "l1", 9, 9 / 52 * 100)]


def test_ranking_ties_by_first_appearance(spark, rows):
    df = scores(spark, ("2", "a", 5), ("1", "b", 2), ("2", "b", 3), ("1", "c", 3), ("3", "c", 2))
    assert [r[1] for r in rows(languages.language_ranking(df), "rank", "language")] == ["c", "b", "a"]


def test_series_fold_the_rest(spark, rows):
    df = scores(spark, ("1", "a", 9), ("1", "b", 5), ("2", "b", 1), ("1", "c", 2), ("2", "d", 1))
    out = languages.language_series(df, 2)
    assert rows(out, "day", "series", "score") == [
        ("1", "Other", 2), ("1", "a", 9), ("1", "b", 5), ("2", "Other", 1), ("2", "b", 1),
    ]
    wide = languages.language_pivot(df, 2)
    assert wide.columns == ["day", "top_1", "top_2", "other", "series"]
    assert rows(wide) == [("1", 9, 5, 2, ["a", "b", "Other"]), ("2", None, 1, 1, ["a", "b", "Other"])]


def test_rest_is_listed_only_if_positive(spark):
    df = scores(spark, ("1", "a", 9), ("1", "b", 0))
    assert [tuple(r) for r in languages.language_pivot(df, 1).collect()] == [("1", 9, None, ["a"])]
    by_org = df.withColumn("org", F.lit("x")).unionByName(
        df.where("language = 'b'").withColumn("org", F.lit("y")))
    assert {(r.org, tuple(r.series)) for r in languages.language_pivot(by_org, 1, ["org"]).collect()} == {
        ("x", ("a",)), ("y", ("b",))}


def test_language_called_other_shares_the_series(spark, rows):
    df = scores(spark, ("1", "Other", 9), ("1", "b", 4))
    assert rows(languages.language_series(df, 1), "series", "series_rank", "score") == [("Other", 1, 13)]


def test_languages_per_organization(spark, rows):
    df = scores(spark, ("1", "a", 9), ("1", "b", 1)).withColumn("org", F.lit("x"))
    df = df.unionByName(df.withColumn("org", F.lit("y")).where("language = 'b'"))
    assert rows(languages.language_ranking(df, 1, ["org"]), "org", "language", "share") == [
        ("x", "a", 90.0), ("y", "b", 100.0),
    ]
    assert languages.language_series(df, 1, ["org"]).count() == 3


def test_infra_languages(spark, rows):
    df = scores(spark, ("1", "bash", 1), ("2", "bash", 1), ("1", "hcl", 0), ("1", "go", 4))
    out = languages.infra_languages(df)
    assert rows(out, "position", "language") == [(2, "hcl"), (3, "bash")]


# --- checks


def test_reconcile(spark, rows):
    a = spark.createDataFrame([("1", 1, 5), ("2", 2, None), ("3", 3, 3)], "day string, x bigint, y bigint")
    b = spark.createDataFrame([("1", 1, 6), ("2", 2, None), ("4", 4, None)], "day string, x bigint, y bigint")
    assert rows(quality.reconcile(a, b, ["x", "y"]), "day", "field", "stored", "recomputed") == [
        ("1", "y", 5, 6), ("3", "x", 3, None), ("3", "y", 3, None), ("4", "x", None, 4),
    ]


def test_ranges(spark, rows):
    df = spark.createDataFrame([("1", 3), ("2", 11), ("3", None)], f"day string, {ACTIVE_USERS} bigint")
    out = quality.range_violations(df, {ACTIVE_USERS: (3, 10)})
    assert rows(out, "day", "field", "value") == [("2", ACTIVE_USERS, 11)]


BOUNDS = "org string, field string, valid_from string, valid_to string, low bigint, high bigint"


def test_bounds_by_key_field_and_time(spark, rows):
    bounds = spark.createDataFrame([
        ("a", "x", "2025-01-01", "2025-01-31", 0, 9), ("a", "x", "2025-02-01", None, 5, None),
        ("a", "y", None, "2025-01-15", None, 1), ("b", "x", None, None, 100, 200),
        (None, "x", "2025-01-01", "2030-01-01", 0, 0), ("c", "x", "1900-01-01", "1999-01-01", 7, 7),
    ], BOUNDS)
    daily = spark.createDataFrame([
        ("a", "2025-01-31", 10, 5), ("a", "2025-02-01", 4, 5), ("a", "2025-01-15", 9, 2),
        ("a", "2024-12-31", 99, 1), ("a", "2026-07-01", 1000, 0), ("b", "2025-01-01", 150, 1),
        ("b", "1999-01-01", 99, None), (None, "2025-06-01", 1, 1), ("c", "2025-01-01", 1, 1),
        ("a", "2025-03-01", None, None), ("a", None, -5, -5),
    ], "org string, day string, x bigint, y bigint")
    got = quality.bound_violations(daily, bounds, ["x", "y"], ["org"])
    assert rows(got, "org", "day", "field", "value", "low", "high") == sorted([
        ("a", "2025-01-31", "x", 10.0, 0, 9), ("a", "2025-02-01", "x", 4.0, 5, None),
        ("a", "2025-01-15", "y", 2.0, None, 1), ("b", "1999-01-01", "x", 99.0, 100, 200),
        (None, "2025-06-01", "x", 1.0, 0, 0)], key=repr)
    none = quality.bound_violations(daily.where("false"), bounds, ["x"], ["org"])
    assert none.count() == 0
    assert quality.bound_violations(daily, bounds.where("false"), ["x"], ["org"]).count() == 0


@pytest.mark.parametrize("wrong, message", [
    ([("a", "x", "2025-01-01", "2025-01-31", 0, 1), ("a", "x", "2025-01-31", None, 0, 1)], "overlap"),
    ([("a", "x", None, None, 0, 1), ("a", "x", "2025-01-31", "2025-02-01", 0, 1)], "overlap"),
    ([("a", "x", None, "2025-01-01", 0, 1), ("a", "x", None, "2024-01-01", 0, 1)], "overlap"),
    ([("a", "x", "2025-01-02", "2025-01-01", 0, 1)], "end before"),
])
def test_bounds_that_contradict_are_rejected(spark, wrong, message):
    bounds = spark.createDataFrame(wrong, BOUNDS)
    daily = spark.createDataFrame([("a", "2025-01-31", 1)], "org string, day string, x bigint")
    with pytest.raises(Exception, match=message):
        quality.bound_violations(daily, bounds, ["x"], ["org"]).collect()


def test_accepted(spark, rows):
    df = spark.createDataFrame([("a", 1, 2), ("b", 2, 2), ("c", None, 1)], f"k string, {GENERATED} bigint, {ACCEPTED} bigint")
    assert rows(quality.accept_violations(df), "k") == [("a",), ("c",)]
    assert rows(quality.clamp_accepted(df.where("k < 'c'")), "k", ACCEPTED) == [("a", 1), ("b", 2)]


def test_members(spark, rows, people):
    known = spark.createDataFrame([("amy",), ("tom",)], "user_login string")
    assert rows(quality.missing_members(known, people)) == [("tom",)]
    assert quality.duplicate_user_days(people).count() == 0
    assert rows(quality.duplicate_user_days(people.union(people.where("day = '2025-01-01'"))), "user_login", "rows") == [
        ("amy", 2), ("zoe", 2),
    ]


def test_periods_and_swing(spark, rows):
    data = [(f"{i:02d}", i, 1, 2, i % 2) for i in range(1, 31)]
    df = spark.createDataFrame(data, f"day string, {PROMPTS} bigint, {AGENT_MODE} bigint, {GENERATED} bigint, {ACCEPTED} bigint")
    assert rows(quality.period_comparison(df, 20), "field", "early", "recent", "change") == [
        (AGENT_MODE, 20, 20, 0), (PROMPTS, 210, 410, 200),
    ]
    assert rows(quality.swing(df)) == [(29, 0, 50.0)]
    both = df.withColumn("org", F.lit("x")).unionByName(df.limit(5).withColumn("org", F.lit("y")))
    assert len(rows(quality.period_comparison(both, 20, by=["org"]))) == 4


def test_adopters(people, rows):
    assert rows(quality.flag_adopters(people)) == [(4, 1, 2, 2)]
    assert quality.flag_adopters(people.where("false")).count() == 0
