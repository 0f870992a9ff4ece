"""Language ranking, per-day series and the infrastructure languages seen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..fields import INFRA_LANGUAGES
from ..functions.ranking import attach_total, top_k
from ..functions.scalars import ratio

OTHER = "Other"


def language_scores(languages: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Score per language, with the place of its first appearance for ties."""
    place = F.struct(F.col("day"), (-F.col("activity_score")).alias("s"))
    return languages.groupBy(*by, "language").agg(
        F.sum("activity_score").alias("score"), F.min(place).alias("first_seen")
    )


def _order() -> list[Column]:
    return [F.desc("score"), F.asc("first_seen"), F.asc("language")]


def language_ranking(languages: DataFrame, k: int = 5, by: Sequence[str] = ()) -> DataFrame:
    """The leading languages and their share of all activity, listed or not."""
    top = top_k(language_scores(languages, by), k, _order(), by)
    # Summed from the day rows, which need one row per task, not the language list.
    full = attach_total(top, languages, F.sum("activity_score"), "total_score", by)
    return full.select(
        *by, "rank", "language", "score", ratio("score", "total_score", 100).alias("share")
    )


def language_series(languages: DataFrame, k: int = 6, by: Sequence[str] = ()) -> DataFrame:
    """Score per day for the leading languages, the rest folded into one series.

    Long form: (day, series, series_rank, score). A day without a language has no
    row. The rest is listed only if it is positive on some day.
    """
    keys = [*by, "language"]
    top = top_k(language_scores(languages, by), k, _order(), by, "series_rank")
    top = top.select(*keys, "series_rank")
    tagged = languages.join(top if by else F.broadcast(top), keys, "left")
    series = F.when(F.col("series_rank").isNotNull(), F.col("language")).otherwise(OTHER)
    summed = tagged.groupBy(*by, "day", series.alias("series")).agg(
        F.coalesce(F.min("series_rank"), F.lit(k + 1)).alias("series_rank"),
        F.sum("activity_score").alias("score"),
    )
    highest = F.max("score").over(Window.partitionBy(*by, "series"))
    return (
        summed.withColumn("_max", highest)
        .where((F.col("series_rank") <= k) | (F.col("_max") > 0))
        .drop("_max")
    )


def language_pivot(languages: DataFrame, k: int = 6, by: Sequence[str] = ()) -> DataFrame:
    """The series side by side, by rank: ``top_1`` to ``top_k`` and ``other``.

    Absent cells stay null. ``series`` lists the names in that order, the same on every row (of a
    key of ``by``), so the columns do not depend on the data and no job runs to name them.
    """
    series = language_series(languages, k, by)
    ranked = [F.sum(F.when(F.col("series_rank") == i, F.col("score"))).alias(f"top_{i}")
              for i in range(1, k + 1)]
    other = F.sum(F.when(F.col("series_rank") > k, F.col("score"))).alias("other")
    named = F.collect_set(F.struct("series_rank", "series")).alias("_named")
    wide = series.groupBy(*by, "day").agg(*ranked, other, named)
    # at most k + 1 names per key, gathered from the rows of its days
    names = F.flatten(F.collect_set("_named").over(Window.partitionBy(*by)))
    return wide.withColumn("series", F.array_sort(F.array_distinct(names))["series"]).drop("_named")


def infra_languages(languages: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Infrastructure and shell languages that occur, in their fixed order."""
    known = F.array(*[F.lit(n) for n in INFRA_LANGUAGES])
    return (
        languages.where(F.col("language").isin(*INFRA_LANGUAGES))
        .groupBy(*by, "language")
        .agg(F.count(F.lit(1)).alias("day_rows"))
        .select(*by, F.array_position(known, F.col("language")).alias("position"), "language",
                "day_rows")
    )
