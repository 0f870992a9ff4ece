import random

from pyspark.sql import functions as F

from tidemark.fields import (
    AGENT_1D, AGENT_28D, AGENT_7D, AGENT_EDIT, AGENT_MODE, BREAKDOWN, FLAG_AGENT, FLAGS,
    GENERATED, LANGUAGE_METRICS, METRICS, MONTHLY_AGENT, PROMPTS,
)
from tidemark.operators import rollups, views


def spine_of(spark, n):
    return spark.createDataFrame([(f"2025-01-{i:02d}",) for i in range(1, n + 1)], "day string")


def user_rows(seed, n_days, n_users):
    """Random user-days with gaps, days without users and duplicate rows."""
    rng = random.Random(seed)
    data = []
    for d in range(1, n_days + 1):
        if d % 9 == 4:
            continue
        for u in range(n_users):
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                data.append((
                    f"2025-01-{d:02d}", f"u{u}", rng.random() < 0.15,
                    rng.choice([0, 0, 0, 2]), rng.choice([0, 0, 0, 0, 3]),
                ))
    return data


SCHEMA = f"day string, user_login string, {FLAG_AGENT} boolean, {AGENT_MODE} bigint, {AGENT_EDIT} bigint"


def brute_force(data, days, n, keep):
    out = []
    for i in range(len(days)):
        window = set(days[max(0, i - n + 1): i + 1])
        out.append(len({r[1] for r in data if r[0] in window and keep(r)}))
    return out


def test_rolling_distinct_matches_brute_force(spark):
    data = user_rows(3, 31, 12)
    spine = spine_of(spark, 31)
    days = [r.day for r in spine.collect()]
    df = views.ensure_columns(spark.createDataFrame(data, SCHEMA), dict.fromkeys(METRICS, 0))
    got = {r.day: r for r in rollups.org_daily(df, spine).collect()}
    assert sorted(got) == days

    def flag(r):
        return r[2]

    def any_agent(r):
        return r[2] or r[3] > 0 or r[4] > 0

    for column, n, keep in (
        (AGENT_1D, 1, flag), (AGENT_7D, 7, flag), (AGENT_28D, 28, flag),
        (MONTHLY_AGENT, 28, any_agent),
    ):
        assert [got[d][column] for d in days] == brute_force(data, days, n, keep), column
    for d in days:
        assert got[d][AGENT_MODE] == sum(r[3] for r in data if r[0] == d)
    week = {r.day: r[MONTHLY_AGENT] for r in rollups.monthly_agent_users(df, spine, 7).collect()}
    assert [week[d] for d in days] == brute_force(data, days, 7, any_agent)


def test_windows_count_listed_days_not_calendar_days(spark):
    days = ["2025-01-01", "2025-02-01", "2025-03-01"]
    spine = spark.createDataFrame([(d,) for d in days], "day string")
    df = spark.createDataFrame([(days[0], "a", True, 0, 0)], SCHEMA)
    out = rollups.rolling_distinct(df, spine, F.col(FLAG_AGENT), {"two": 2}).collect()
    assert {r.day: r.two for r in out} == {days[0]: 1, days[1]: 1, days[2]: 0}


def test_rollup_per_organization(spark, rows):
    by = ["org"]
    data = [("x", *r) for r in user_rows(5, 12, 5)] + [("y", *r) for r in user_rows(6, 20, 7)]
    spine = (
        spine_of(spark, 12).withColumn("org", F.lit("x"))
        .unionByName(spine_of(spark, 20).withColumn("org", F.lit("y")))
    )
    df = spark.createDataFrame(data, f"org string, {SCHEMA}")
    out = rollups.rolling_distinct(df, spine, F.col(FLAG_AGENT), {"n": 7}, by=by)
    got = {(r.org, r.day): r.n for r in out.collect()}
    for org, n in (("x", 12), ("y", 20)):
        days = [f"2025-01-{i:02d}" for i in range(1, n + 1)]
        mine = [r[1:] for r in data if r[0] == org]
        assert [got[org, d] for d in days] == brute_force(mine, days, 7, lambda r: r[2])


def test_days_without_users_are_zero(spark, rows):
    df = spark.createDataFrame([("2025-01-02", "a", 3)], f"day string, user_login string, {PROMPTS} bigint")
    full = views.user_daily_summary(df)
    out = rollups.org_rollup(full, spine_of(spark, 3))
    assert rows(out, "day", PROMPTS, GENERATED) == [
        ("2025-01-01", 0, 0), ("2025-01-02", 3, 0), ("2025-01-03", 0, 0),
    ]


def test_distinct_users(spark, rows):
    data = [("d", "a", True), ("d", "a", True), ("d", "b", None), ("e", "b", True), ("e", "c", False)]
    df = spark.createDataFrame(data, f"day string, user_login string, {FLAGS[0]} boolean")
    assert rows(rollups.distinct_users(df, F.col(FLAGS[0]))) == [(2,)]
    assert rows(rollups.distinct_users(df, F.col(FLAGS[0]), approximate=True)) == [(2,)]
    assert rows(rollups.distinct_users(df, F.col(FLAGS[0]), by=["day"])) == [("d", 1), ("e", 1)]


def test_nested_rollup_order(spark):
    entry = "language string, feature string, " + ", ".join(f"{m} bigint" for m in LANGUAGE_METRICS)
    data = [
        ("d", "a", [("go", "x", 1, 5, 0), ("go", "y", 9, 1, 0)]),
        ("d", "b", [("go", "x", 1, 5, 1), ("c", "x", 3, 10, 0), ("b", "x", 3, 10, 0)]),
    ]
    df = spark.createDataFrame(data, f"day string, user_login string, {BREAKDOWN} array<struct<{entry}>>")
    entries = rollups.org_language_entries(views.language_entries(df, ["day", "user_login"]))
    row = rollups.nest_breakdown(entries).first()
    assert [tuple(e) for e in row[BREAKDOWN]] == [
        ("b", "x", 3, 10, 0), ("c", "x", 3, 10, 0), ("go", "x", 2, 10, 1), ("go", "y", 9, 1, 0),
    ]


def test_rolling_plan_shuffles_users_once(spark):
    df = views.ensure_columns(spark.createDataFrame(user_rows(1, 5, 3), SCHEMA), dict.fromkeys(METRICS, 0))
    plan = rollups.org_daily(df, spine_of(spark, 5))._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert plan.count("hashpartitioning(user_login") == 1
