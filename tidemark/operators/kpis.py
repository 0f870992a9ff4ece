"""Cards of the dashboard: one row of measures over the visible report days.

Each function takes the visible organization-day rows and gives one row per key
of ``by`` (one row in all without keys, none for empty input).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fields import (
    ACCEPTED, ACTIVE_USERS, AGENT_1D, AGENT_28D, AGENT_7D, AGENT_EDIT, AGENT_MODE, GENERATED,
    MONTHLY_AGENT, ORG_METRICS, PROMPTS,
)
from ..functions.ranking import whole_frame
from ..functions.scalars import chat_requests, has_number, number, ratio, round_half_up

MEANINGFUL_GENERATION = 80


def total(c: str) -> Column:
    return F.sum(number(c)).cast("bigint")


def latest(*columns: str) -> Column:
    """Values of the last day, nulls kept (a null is not a zero)."""
    return F.max_by(F.struct(*columns), F.col("day"))


def peak(value: Column, fields: Mapping[str, Column | str]) -> Column:
    """Fields of the row with the greatest value; the earliest day wins ties."""
    row = F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in fields.items()])
    return F.min_by(row, F.struct((-value).alias("v"), F.col("day").alias("d")))


def summary_kpis(daily: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    sums = whole_frame(
        daily,
        [
            F.count(F.lit(1)).alias("days"),
            total(ACTIVE_USERS).alias("_active"),
            total(PROMPTS).alias("total_prompts"),
            total(GENERATED).alias("total_generated"),
            total(ACCEPTED).alias("total_accepted"),
            total(AGENT_MODE).alias("total_agent_mode"),
            F.sum(chat_requests()).cast("bigint").alias("total_chat_requests"),
        ],
        by,
    )
    return sums.select(
        *by,
        "days",
        round_half_up(F.col("_active") / F.col("days")).alias("avg_dau"),
        "total_prompts",
        round_half_up(F.col("total_prompts") / F.col("days")).alias("prompts_per_day"),
        "total_accepted",
        "total_generated",
        ratio("total_accepted", "total_generated", 100).alias("acceptance_rate"),
        "total_agent_mode",
        "total_chat_requests",
        ratio("total_agent_mode", "total_chat_requests", 100).alias("agent_mode_share"),
    )


def latest_org_metrics(daily: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    last = whole_frame(daily, [latest("day", *ORG_METRICS).alias("r")], by)
    return last.select(*by, F.col("r.day").alias("latest_day"), *[f"r.{m}" for m in ORG_METRICS])


def dau_insights(daily: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    intensity = ratio(PROMPTS, ACTIVE_USERS)
    cards = whole_frame(
        daily,
        [
            total(PROMPTS).alias("_prompts"),
            total(ACTIVE_USERS).alias("_active"),
            peak(number(ACTIVE_USERS), {"v": number(ACTIVE_USERS), "day": "day"}).alias("dau"),
            peak(intensity, {"v": intensity, "day": "day"}).alias("intensity"),
            F.count_if(number(AGENT_MODE) > 0).alias("agent_traffic_days"),
        ],
        by,
    )
    return cards.select(
        *by,
        round_half_up(ratio("_prompts", "_active")).alias("avg_prompts_per_user"),
        F.col("dau.v").alias("peak_dau"),
        F.col("dau.day").alias("peak_dau_day"),
        F.col("intensity.v").alias("peak_prompt_intensity"),
        F.col("intensity.day").alias("peak_prompt_intensity_day"),
        "agent_traffic_days",
    )


def code_insights(daily: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    peaks = {"generation": GENERATED, "acceptance": ACCEPTED, "agent_edit": AGENT_EDIT}
    cards = whole_frame(
        daily,
        [
            total(ACCEPTED).alias("total_accepted"),
            total(GENERATED).alias("total_generated"),
            total(AGENT_EDIT).alias("total_agent_edit"),
            *[
                peak(number(c), {"v": number(c), "day": "day"}).alias(f"_{n}")
                for n, c in peaks.items()
            ],
        ],
        by,
    )
    return cards.select(
        *by,
        "total_accepted",
        "total_generated",
        ratio("total_accepted", "total_generated", 100).alias("acceptance_rate"),
        "total_agent_edit",
        *[F.col(f"_{n}.v").alias(f"peak_{n}") for n in peaks],
        *[F.col(f"_{n}.day").alias(f"peak_{n}_day") for n in peaks],
    )


def code_milestones(
    daily: DataFrame, by: Sequence[str] = (), meaningful: int = MEANINGFUL_GENERATION
) -> DataFrame:
    """Generation spike, best efficiency day and agent-heavy day.

    The best day is looked for among days with meaningful generation, else among
    days with any, else it is the day with most accepted blocks. One comparison
    key (tier, -value, day) expresses the three steps.
    """
    generated, accepted = number(GENERATED), number(ACCEPTED)
    rate = ratio(ACCEPTED, GENERATED)
    tier = F.when(generated >= meaningful, 0).when(generated > 0, 1).otherwise(2)
    merit = F.when(generated > 0, rate).otherwise(accepted.cast("double"))
    best_row = F.struct(
        F.col("day"), ratio(ACCEPTED, GENERATED, 100).alias("rate"), accepted.alias("accepted")
    )
    best = F.min_by(best_row, F.struct(tier.alias("t"), (-merit).alias("v"), F.col("day")))
    cards = whole_frame(
        daily,
        [
            peak(generated, {"day": "day", "n": generated, "accepted": accepted}).alias("spike"),
            best.alias("best"),
            peak(
                number(AGENT_EDIT),
                {"day": "day", "n": number(AGENT_EDIT), "generated": generated},
            ).alias("agent"),
        ],
        by,
    )
    return cards.select(
        *by,
        F.col("spike.day").alias("spike_day"),
        F.col("spike.n").alias("spike_generated"),
        F.col("spike.accepted").alias("spike_accepted"),
        F.col("best.day").alias("best_day"),
        F.col("best.rate").alias("best_rate"),
        F.col("best.accepted").alias("best_accepted"),
        F.col("agent.day").alias("agent_day"),
        F.col("agent.n").alias("agent_edits"),
        F.col("agent.generated").alias("agent_generated"),
    )


def agent_insights(daily: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    last = latest_org_metrics(daily, by)
    both = (number(MONTHLY_AGENT) != 0) & (number(AGENT_28D) != 0)
    # 1 stands in for the divisor where the result is null anyway
    safe = F.when(both, F.col(MONTHLY_AGENT)).otherwise(F.lit(1))
    return last.select(
        *by,
        F.col(AGENT_1D).alias("latest_1d"),
        F.col(AGENT_7D).alias("latest_7d"),
        F.col(AGENT_28D).alias("latest_28d"),
        F.when(both, F.col(AGENT_28D) / safe * 100).alias("cloud_reach"),
    )


def adoption_overview(daily: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    sums = whole_frame(
        daily,
        [
            F.count(F.lit(1)).alias("window_days"),
            total(AGENT_EDIT).alias("total_agent_edit"),
            F.count_if(number(AGENT_MODE) > 0).alias("agent_days"),
            total(AGENT_MODE).alias("_agent"),
            F.sum(chat_requests()).cast("bigint").alias("_chat"),
            latest(*ORG_METRICS).alias("r"),
        ],
        by,
    )
    seen = [has_number(f"r.{m}") for m in (AGENT_1D, AGENT_7D, AGENT_28D)]
    return sums.select(
        *by,
        "window_days",
        F.col(f"r.{MONTHLY_AGENT}").alias(MONTHLY_AGENT),
        ratio("_agent", "_chat", 100).alias("agent_mode_share"),
        "total_agent_edit",
        "agent_days",
        (seen[0] | seen[1] | seen[2]).alias("has_cloud_metrics"),
    )
