"""Report-day spines: the ordered list of days a measure is defined over."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..fields import MAX_REPORT_DAYS, REPORT_LAG_DAYS


def check_window(days: int, most: int = MAX_REPORT_DAYS) -> int:
    """`most` is the longest window that the report service offers."""
    if not 1 <= days <= most:
        raise ValueError(f"report window must be 1..{most} days, got {days}")
    return days


def report_days(
    spark: SparkSession, days: int = MAX_REPORT_DAYS, end: dt.date | None = None,
    most: int = MAX_REPORT_DAYS,
) -> DataFrame:
    """The last ``days`` report days up to ``end``, as ISO text.

    Reports lag, so ``end`` defaults to two days before today.
    """
    check_window(days, most)
    end = end or dt.date.today() - dt.timedelta(days=REPORT_LAG_DAYS)
    start = end - dt.timedelta(days=days - 1)
    span = F.sequence(F.lit(start), F.lit(end))
    return spark.range(1).select(F.explode(span.cast("array<string>")).alias("day"))


def observed_days(df: DataFrame, by: Sequence[str] = (), column: str = "day") -> DataFrame:
    """Every calendar day between the first and last day seen, gaps included."""
    date = F.col(column).cast("date")
    span = F.sequence(F.min(date), F.max(date))
    return (
        df.groupBy(*by)
        .agg(span.cast("array<string>").alias("_days"))
        .select(*by, F.explode("_days").alias("day"))
    )


def indexed_days(spine: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Number the days of a spine 0, 1, 2, ... The frame has one row per day."""
    w = Window.partitionBy(*by).orderBy("day")
    days = spine.select(*by, "day").distinct()
    return days.withColumn("idx", F.row_number().over(w) - 1)


def trailing_days(
    df: DataFrame, days: int = MAX_REPORT_DAYS, by: Sequence[str] = (), column: str = "day",
    most: int = MAX_REPORT_DAYS,
) -> DataFrame:
    """The last ``days`` calendar days up to the last day seen in ``df``."""
    check_window(days, most)
    end = F.max(F.col(column).cast("date"))
    span = F.sequence(F.date_sub(end, days - 1), end)
    return (
        df.groupBy(*by)
        .agg(span.cast("array<string>").alias("_days"))
        .select(*by, F.explode("_days").alias("day"))
    )
