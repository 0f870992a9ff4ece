"""Per-day series for the charts. Projections only: no shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fields import (
    ACCEPTED, ACTIVE_USERS, AGENT_1D, AGENT_28D, AGENT_7D, AGENT_EDIT, AGENT_MODE, ASK_MODE,
    CUSTOM_MODE, EDIT_MODE, GENERATED, PROMPTS,
)
from ..functions.scalars import acceptance_rate, chat_requests, has_number, ratio


def prompts_per_user(daily: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return daily.select(
        *by, "day", ACTIVE_USERS, PROMPTS, ratio(PROMPTS, ACTIVE_USERS).alias("prompts_per_user")
    )


def code_activity(daily: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return daily.select(
        *by, "day", GENERATED, ACCEPTED, AGENT_EDIT, acceptance_rate().alias("acceptance_rate")
    )


def mode_mix(daily: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Share of each chat mode in percent. Edit mode is published as ``plan``."""
    named = {"agent": AGENT_MODE, "ask": ASK_MODE, "plan": EDIT_MODE, "custom": CUSTOM_MODE}
    return daily.select(
        *by, "day", *[ratio(F.col(m), chat_requests(), 100).alias(f"{n}_ratio")
                      for n, m in named.items()]
    )


_TREND = {"active_users_1d": AGENT_1D, "active_users_7d": AGENT_7D, "active_users_28d": AGENT_28D}


def agent_trend(daily: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rolling agent users per day; a missing value stays null."""
    return daily.select(*by, "day", *[F.col(c).alias(n) for n, c in _TREND.items()])


def agent_trend_available(daily: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Whether any day has any of the rolling values."""
    any_value = has_number(AGENT_1D) | has_number(AGENT_7D) | has_number(AGENT_28D)
    seen = F.coalesce(F.bool_or(any_value), F.lit(False)).alias("has_any_data")
    return daily.groupBy(*by).agg(seen)
