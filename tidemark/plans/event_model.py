"""Usage reports derived from an event log.

The event log stands in for landed reports: every event of a user on a day adds
to that user's report row. ``props`` is a flat JSON text with one integer ``k``
(0..99). It is cut out with a pattern, since a JSON parser per event costs ten
times as much as everything else in the scan. For the same reason user-days are
grouped on the date and the numeric id, and named in text afterwards.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fields import (
    ACCEPTED, ACTIVE_USERS, AGENT_EDIT, AGENT_MODE, ASK_MODE, BREAKDOWN, CUSTOM_MODE,
    EDIT_MODE, FLAG_ACTIVE, FLAG_AGENT, FLAG_PASSIVE, FLAGS, GENERATED,
    LANGUAGE_METRICS, METRICS, PROMPTS,
)
from ..operators.rollups import nest_breakdown, org_daily
from ..sources.days import observed_days

LANGUAGES = [
    "python", "typescript", "go", "java", "markdown", "yaml",
    "bicep", "hcl", "bash", "powershell", "pwsh", "shellscript",
]
FEATURE_OF_EVENT = {
    "view": "chat_panel_ask_mode",
    "click": "code_completion",
    "purchase": "chat_panel_agent_mode",
}


def events(spark: SparkSession, sf_dir: str, since: Column | None = None) -> DataFrame:
    """The log, or its events from the time ``since`` on, a bound that the scan can use."""
    raw = spark.read.parquet(f"{sf_dir}/events.parquet")
    if since is not None:
        raw = raw.where(F.col("ts") >= since)
    return raw.selectExpr(
        "cast(ts as date) as date",
        "hour(ts) as hour",
        "user_id",
        "event_type",
        f"try_cast(regexp_extract(props, '{_K}', 1) as bigint) as k",
    )


_K = r'"k"[ ]*:[ ]*(-?[0-9]+)'
_DAY = "cast(date as string) as day"
_LOGIN = "concat('u', cast(user_id as string)) as user_login"
_GENERATED = "coalesce(sum(k) filter (where event_type = 'click'), 0)"
_ACCEPTED = "coalesce(sum((k * (k % 10)) div 10) filter (where event_type = 'click'), 0)"


def _aggregates(rules: dict[str, str]):
    return [F.expr(f"{rule} as {name}") for name, rule in rules.items()]


def _user_dates(ev: DataFrame) -> DataFrame:
    rules = {
        ACTIVE_USERS: "cast(1 as bigint)",
        PROMPTS: "count_if(event_type = 'view')",
        GENERATED: _GENERATED,
        ACCEPTED: _ACCEPTED,
        AGENT_MODE: "count_if(event_type = 'view' and k % 4 = 0)",
        ASK_MODE: "count_if(event_type = 'view' and k % 4 = 1)",
        EDIT_MODE: "count_if(event_type = 'view' and k % 4 = 2)",
        CUSTOM_MODE: "count_if(event_type = 'view' and k % 4 = 3)",
        AGENT_EDIT: "coalesce(sum(k) filter (where event_type = 'click' and k % 5 = 0), 0)",
        FLAG_AGENT: "coalesce(bool_or(event_type = 'signup' and k < 10), false)",
        FLAG_ACTIVE: "coalesce(bool_or(event_type = 'error' and k < 20), false)",
        FLAG_PASSIVE: "coalesce(bool_or(event_type = 'error' and k < 60), false)",
    }
    return ev.groupBy("date", "user_id").agg(*_aggregates(rules))


def user_days(ev: DataFrame) -> DataFrame:
    """One report row per (day, user), without the breakdown."""
    return _user_dates(ev).selectExpr(_DAY, _LOGIN, *METRICS, *FLAGS)


def _entries(ev: DataFrame, keys: list[str]) -> DataFrame:
    """Breakdown entries summed per key, language and feature."""
    names = ", ".join(f"'{n}'" for n in LANGUAGES)
    kinds = ", ".join(f"'{e}'" for e in FEATURE_OF_EVENT)
    feature = " ".join(f"when '{e}' then '{f}'" for e, f in FEATURE_OF_EVENT.items())
    rules = {
        PROMPTS: "count_if(event_type <> 'click')",
        GENERATED: _GENERATED,
        ACCEPTED: _ACCEPTED,
    }
    return (
        ev.where(f"event_type in ({kinds})")
        .selectExpr(
            *keys, "event_type", "k",
            f"element_at(array({names}), cast(k % 12 + 1 as int)) as language",
            f"case event_type {feature} end as feature",
        )
        .groupBy(*keys, "language", "feature")
        .agg(*_aggregates(rules))
    )


def user_entries(ev: DataFrame) -> DataFrame:
    """Flattened breakdown entries per (day, user)."""
    return _entries(ev, ["date", "user_id"]).selectExpr(
        _DAY, _LOGIN, "language", "feature", *LANGUAGE_METRICS
    )


def user_breakdowns(ev: DataFrame) -> DataFrame:
    """Breakdown array per (day, user)."""
    nested = nest_breakdown(_entries(ev, ["date", "user_id"]), ["date", "user_id"])
    return nested.selectExpr(_DAY, _LOGIN, BREAKDOWN)


def user_reports(ev: DataFrame) -> DataFrame:
    """User-day rows in the raw report layout, breakdown included."""
    keys = ["date", "user_id"]
    nested = nest_breakdown(_entries(ev, keys), keys)
    return _user_dates(ev).join(nested, keys, "left").selectExpr(
        _DAY, "cast(1 as bigint) as organization_id", "user_id", _LOGIN,
        *METRICS, *FLAGS, BREAKDOWN,
    )


def event_days(ev: DataFrame) -> DataFrame:
    """The report-day spine: first to last day of the log."""
    return observed_days(ev, column="date")


def org_days(ev: DataFrame, spine: DataFrame | None = None) -> DataFrame:
    """Organization-day rows without the breakdown, for the days of the log or of ``spine``."""
    users = _user_dates(ev).selectExpr(_DAY, "user_id", *METRICS, *FLAGS)
    spine = event_days(ev) if spine is None else spine
    return org_daily(users, spine, user="user_id", unique=True)


def span(spark: SparkSession, sf_dir: str) -> tuple[dt.date, dt.date] | None:
    """First and last day of the log, or None if it is empty: one job over its time column.

    A landing area knows them from its listed days; the log has to be asked, once for a query.
    """
    ts = spark.read.parquet(f"{sf_dir}/events.parquet").agg(
        F.min("ts").cast("date").alias("first"), F.max("ts").cast("date").alias("last")).first()
    return None if ts.first is None else (ts.first, ts.last)


def days_between(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """A spine that needs no table."""
    days = F.sequence(F.lit(first), F.lit(last)).cast("array<string>")
    return spark.range(1).select(F.explode(days).alias("day"))


def since(spark: SparkSession, sf_dir: str, first: dt.date) -> DataFrame:
    """The events from a day on; the bound is a value, so the scan skips older row groups."""
    kind = spark.read.parquet(f"{sf_dir}/events.parquet").schema["ts"].dataType
    return events(spark, sf_dir, F.lit(first).cast(kind))


def org_entries(ev: DataFrame) -> DataFrame:
    """Organization breakdown entries, flattened.

    Summing straight to organization grain gives the same rows as going through
    the users, and shuffles one row per (day, language, feature) and task.
    """
    return _entries(ev, ["date"]).selectExpr(_DAY, "language", "feature", *LANGUAGE_METRICS)


def org_reports(ev: DataFrame) -> DataFrame:
    """Organization-day rows in the raw report layout, breakdown included."""
    nested = nest_breakdown(org_entries(ev))
    return org_days(ev).join(nested, "day", "left")
