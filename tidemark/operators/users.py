"""User-level measures over the visible window: totals, review reach, rankings."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fields import (
    ACCEPTED, CHAT_MODES, FLAG_ACTIVE, FLAG_AGENT, FLAG_PASSIVE, FLAGS, GENERATED, PROMPTS,
)
from ..functions.ranking import top_k, whole_frame
from ..functions.scalars import (
    acceptance_rate, capability_labels, is_true, number, ratio, review_touch_days,
)
from .views import user_totals

AGENT_DAYS, ACTIVE_DAYS, PASSIVE_DAYS = (f"{f}_days" for f in FLAGS)


def window_user_summary(user_daily: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Totals per user over the given user-days.

    ``first_day`` settles ties in the rankings: users who appear earlier come first.
    It is compared as a date, which keeps the aggregation hash-based (text would
    make Spark sort all user-days by user).
    """
    first = F.expr("cast(min(cast(day as date)) as string) as first_day")
    return user_daily.groupBy(*by, "user_login").agg(*user_totals(), first)


def _standing() -> list[Column]:
    """Tie-break keys after review days: the order of the user list."""
    return [
        F.desc(AGENT_DAYS), F.desc(PROMPTS), F.desc("active_days"),
        F.asc("first_day"), F.asc("user_login"),
    ]


def user_order() -> list[Column]:
    return [review_touch_days().desc(), *_standing()]


def reviewer_order() -> list[Column]:
    return [review_touch_days().desc(), F.desc(PROMPTS), *_standing()]


def sort_users(users: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return users.orderBy(*by, *user_order())


def _complete(users: DataFrame) -> DataFrame:
    """Add absent flag and day-count columns as nulls, so they read as not seen."""
    kinds = {f: "boolean" for f in FLAGS} | {f"{f}_days": "bigint" for f in FLAGS}
    absent = {c: F.lit(None).cast(t) for c, t in kinds.items() if c not in users.columns}
    return users.withColumns(absent) if absent else users


def heavy_review_threshold(window_days: int | None = None) -> int:
    """Review days from which a user counts as a heavy reviewer."""
    days = 28 if window_days is None else window_days
    return max(7, math.floor(days * 0.2 + 0.5))


def review_engagement(
    users: DataFrame, window_days: int | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Reach and depth of agent and review use over all users."""
    users = _complete(users)
    threshold = heavy_review_threshold(window_days)
    any_review = is_true(FLAG_ACTIVE) | is_true(FLAG_PASSIVE)

    def seen(columns):
        flag = F.col(columns[0]).isNotNull()
        for c in columns[1:]:
            flag = flag | F.col(c).isNotNull()
        return F.bool_or(flag)

    def days(c):
        return F.sum(number(c)).cast("bigint")

    sums = whole_frame(
        users,
        [
            seen(FLAGS).alias("has_flags"),
            seen([AGENT_DAYS, ACTIVE_DAYS, PASSIVE_DAYS]).alias("has_day_counts"),
            F.count(F.lit(1)).alias("total_users"),
            days("active_days").alias("total_active_days"),
            F.count_if(is_true(FLAG_AGENT)).alias("agent_users"),
            F.count_if(is_true(FLAG_ACTIVE)).alias("active_review_users"),
            F.count_if(is_true(FLAG_PASSIVE)).alias("passive_review_users"),
            F.count_if(any_review).alias("any_review_users"),
            days(AGENT_DAYS).alias("agent_days"),
            days(ACTIVE_DAYS).alias("active_review_days"),
            days(PASSIVE_DAYS).alias("passive_review_days"),
            F.sum(review_touch_days()).cast("bigint").alias("review_touch_days"),
            F.count_if(review_touch_days() >= threshold).alias("heavy_reviewers"),
        ],
        by,
    )
    shares = {
        f"{n}_{unit}_share": ratio(f"{n}_{unit}", f"total_{whole}", 100)
        for n in ("agent", "active_review", "passive_review")
        for unit, whole in (("users", "users"), ("days", "active_days"))
    }
    return sums.withColumns(
        {
            **shares,
            "any_review_users_share": ratio("any_review_users", "total_users", 100),
            "heavy_threshold": F.lit(threshold).cast("bigint"),
            "avg_review_days": ratio("review_touch_days", "any_review_users"),
        }
    )


COVERAGE = [
    ("Coding agent coverage", "agent_days", "agent_users"),
    ("Active review coverage", "active_review_days", "active_review_users"),
    ("Passive review coverage", "passive_review_days", "passive_review_users"),
]


def review_coverage(
    users: DataFrame, window_days: int | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Three rows: days with each flag against all active days."""
    reach = review_engagement(users, window_days, by)
    rows = F.array(
        *[
            F.struct(F.lit(t).alias("coverage"), F.col(d).alias("days"), F.col(u).alias("users"))
            for t, d, u in COVERAGE
        ]
    )
    return (
        reach.select(*by, "total_active_days", "total_users", F.explode(rows).alias("r"))
        .select(*by, "r.*", "total_active_days", "total_users")
        .withColumn("ratio", ratio("days", "total_active_days", 100))
    )


def _touched(users: DataFrame) -> DataFrame:
    return _complete(users).withColumn("review_days", review_touch_days())


def review_hotspots(users: DataFrame, k: int = 3, by: Sequence[str] = ()) -> DataFrame:
    """The users with most review days, among those with any."""
    top = top_k(_touched(users).where("review_days > 0"), k, reviewer_order(), by)
    return top.select(
        *by, "rank", "user_login", "review_days",
        ratio("review_days", "active_days", 100).alias("review_share"),
        F.col(PROMPTS).alias("prompts"),
        number(AGENT_DAYS).alias("agent_days"),
    )


def top_reviewers(users: DataFrame, k: int = 5, by: Sequence[str] = ()) -> DataFrame:
    """The leading reviewers with their shares; users without reviews may fill up."""
    top = top_k(_touched(users), k, reviewer_order(), by)
    return top.select(
        *by, "rank", "user_login", "review_days",
        number(ACTIVE_DAYS).alias("active_review_days"),
        number(PASSIVE_DAYS).alias("passive_review_days"),
        number(AGENT_DAYS).alias("agent_days"),
        "active_days",
        F.col(PROMPTS).alias("prompts"),
        ratio(ACTIVE_DAYS, "active_days", 100).alias("active_share"),
        ratio(PASSIVE_DAYS, "active_days", 100).alias("passive_share"),
        ratio("review_days", "active_days", 100).alias("review_share"),
    )


def user_table(
    users: DataFrame, compact: bool = True, rows: int = 6, by: Sequence[str] = ()
) -> DataFrame:
    """The user list: the first rows of it when compact, else all, in order."""
    users = _touched(users)
    listed = top_k(users, rows, user_order(), by) if compact else sort_users(users, by)
    rank = ["rank"] if compact else []
    return listed.select(
        *by, *rank, "user_login", "active_days", PROMPTS, GENERATED, ACCEPTED,
        acceptance_rate().alias("acceptance_rate"),
        *CHAT_MODES,
        capability_labels().alias("capabilities"),
        F.col("review_days").alias("review_touch_days"),
        number(AGENT_DAYS).alias("agent_days"),
    )
