import pytest
from pyspark.sql import functions as F

from tidemark.fields import (
    ACTIVE_USERS, AGENT_EDIT, BREAKDOWN, FLAG_ACTIVE, FLAG_AGENT, FLAG_PASSIVE, FLAGS, GENERATED,
    LANGUAGE_METRICS, METRICS, ORG_METRICS, PROMPTS, VIEW_SCHEMAS,
)
from tidemark.functions import scalars
from tidemark.operators import views


def test_missing_columns_get_defaults(spark):
    df = spark.createDataFrame([("d", 1)], f"day string, {ACTIVE_USERS} bigint")
    out = views.ensure_columns(df, {ACTIVE_USERS: 0, PROMPTS: 0, FLAG_AGENT: False})
    row = out.first()
    assert (row[ACTIVE_USERS], row[PROMPTS], row[FLAG_AGENT]) == (1, 0, False)
    assert dict(out.dtypes)[PROMPTS] == "bigint"


def test_existing_columns_keep_nulls(spark):
    df = spark.createDataFrame([(None, None), (42, True)], f"{PROMPTS} bigint, {FLAG_AGENT} boolean")
    out = views.ensure_columns(df, {PROMPTS: 0, FLAG_AGENT: False})
    assert out is df


def test_daily_summary_sorted_and_complete(spark):
    data = [("2025-01-03", 3), ("2025-01-01", 1), ("2025-01-02", 2), ("2025-01-02", 9)]
    df = spark.createDataFrame(data, f"day string, {ACTIVE_USERS} bigint")
    out = views.sort_view(views.daily_summary(df), "daily_summary")
    assert out.columns == ["day", *METRICS, *ORG_METRICS]
    got = out.collect()
    assert [r.day for r in got] == sorted(d for d, _ in data)
    assert all(r[ORG_METRICS[0]] == 0 for r in got)


@pytest.mark.parametrize("view", list(VIEW_SCHEMAS))
def test_missing_required_column_gives_empty_view(spark, view):
    df = spark.createDataFrame([(1,)], "value bigint")
    out = getattr(views, view)(df)
    assert out.count() == 0
    assert out.schema.simpleString() == VIEW_SCHEMAS[view].simpleString()


def test_user_daily_has_no_ids(spark):
    df = spark.createDataFrame(
        [("2025-01-02", 7, "b"), ("2025-01-01", 7, "b"), ("2025-01-01", 8, "a")],
        "day string, user_id bigint, user_login string",
    )
    out = views.sort_view(views.user_daily_summary(df), "user_daily_summary")
    assert out.columns == ["day", "user_login", *METRICS, *FLAGS]
    assert [(r.day, r.user_login) for r in out.collect()] == [
        ("2025-01-01", "a"), ("2025-01-01", "b"), ("2025-01-02", "b"),
    ]


def test_user_summary_sums_and_flags(spark, rows):
    schema = (f"user_login string, day string, {PROMPTS} bigint, {AGENT_EDIT} bigint, "
              f"{FLAG_AGENT} boolean, {FLAG_ACTIVE} boolean")
    data = [
        ("alice", "1", 10, None, True, False), ("alice", "2", 10, None, None, True),
        ("alice", "2", 10, None, False, None), ("bob", "1", 5, None, None, None),
        ("carol", "1", 30, 1, False, False),
    ]
    out = views.user_summary(spark.createDataFrame(data, schema))
    assert rows(
        out, "user_login", "active_days", PROMPTS, AGENT_EDIT, f"{FLAG_AGENT}_days",
        f"{FLAG_ACTIVE}_days", f"{FLAG_PASSIVE}_days", FLAG_AGENT, FLAG_ACTIVE, FLAG_PASSIVE,
    ) == [
        ("alice", 3, 30, 0, 1, 1, 0, True, True, False),
        ("bob", 1, 5, 0, 0, 0, 0, False, False, False),
        ("carol", 1, 30, 1, 0, 0, 0, False, False, False),
    ]
    assert ACTIVE_USERS not in out.columns
    ordered = [r.user_login for r in views.sort_view(out, "user_summary").collect()]
    assert ordered == ["alice", "carol", "bob"]
    assert out.schema.simpleString() == VIEW_SCHEMAS["user_summary"].simpleString()


ENTRY = "language string, feature string, " + ", ".join(f"{m} bigint" for m in LANGUAGE_METRICS)


def test_language_summary(spark, rows):
    data = [
        ("2025-01-01", [("python", "a", 1, 2, 3), ("python", "b", 1, 1, 1), ("hcl", "a", 0, 9, 0),
                        None, (None, None, None, 5, None)]),
        ("2025-01-02", [("python", "a", 1, 0, 0)]),
        ("2025-01-03", []),
        ("2025-01-04", None),
    ]
    df = spark.createDataFrame(data, f"day string, {BREAKDOWN} array<struct<{ENTRY}>>")
    out = views.sort_view(views.language_summary(df), "language_summary")
    assert [tuple(r) for r in out.collect()] == [
        ("2025-01-01", "hcl", 0, 9, 0, 9),
        ("2025-01-01", "python", 2, 3, 4, 9),
        ("2025-01-01", "unknown", 0, 5, 0, 5),
        ("2025-01-02", "python", 1, 0, 0, 1),
    ]


def test_entry_fields_may_be_absent(spark, rows):
    df = spark.createDataFrame(
        [("d", [(3.9,)])], f"day string, {BREAKDOWN} array<struct<{GENERATED} double>>"
    )
    assert rows(views.language_entries(df)) == [("d", "unknown", "code_completion", 0, 3, 0)]


def test_breakdown_inferred_as_text_yields_nothing(spark):
    df = spark.createDataFrame([("d", None)], f"day string, {BREAKDOWN} string")
    assert views.language_summary(df).count() == 0


def test_scalars(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(nan, None, 2.5), (inf, True, 2.4), (-1.9, False, 0.0)],
                               "d double, b boolean, h double")
    got = df.select(
        scalars.finite_number("d"), scalars.is_true("b"), scalars.round_half_up(F.col("h")),
        F.when(~F.isnan("d") & (F.abs("d") < 9), scalars.whole("d")), scalars.has_number("b"),
    ).collect()
    assert [tuple(r) for r in got] == [
        (0.0, False, 3, None, False), (0.0, True, 2, None, True), (-1.9, False, 0, -1, True),
    ]


def test_two_organizations_stay_apart(spark, rows):
    df = spark.createDataFrame(
        [(1, "d", "a", 1), (2, "d", "a", 5), (2, "e", "a", 5)],
        f"organization_id bigint, day string, user_login string, {PROMPTS} bigint",
    )
    by = ["organization_id"]
    assert rows(views.user_summary(df, by), "organization_id", PROMPTS) == [(1, 1), (2, 10)]
    assert rows(views.user_daily_summary(df, by), "organization_id", "day")[0] == (1, "d")
    assert views.empty_view(df, "daily_summary", by).columns[0] == "organization_id"
