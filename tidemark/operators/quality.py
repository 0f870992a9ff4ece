"""Checks over the daily and user-daily tables. Each returns findings as rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..fields import (
    ACCEPTED, AGENT_MODE, FLAG_ACTIVE, FLAG_AGENT, FLAG_PASSIVE, FLAGS, GENERATED, METRICS,
    ORG_METRICS, PROMPTS,
)
from ..functions.ranking import top_k, whole_frame
from ..functions.scalars import acceptance_rate, is_true, number


def _long_form(keys: Sequence[str], fields: Mapping[str, Mapping[str, Column]]):
    """Explode one struct per field: {field: {column: value}} -> rows."""
    structs = [
        F.struct(F.lit(f).alias("field"), *[c.alias(n) for n, c in cols.items()])
        for f, cols in fields.items()
    ]
    return [*keys, F.explode(F.array(*structs)).alias("r")]


def reconcile(
    stored: DataFrame,
    recomputed: DataFrame,
    fields: Sequence[str] = tuple(METRICS + ORG_METRICS),
    by: Sequence[str] = (),
) -> DataFrame:
    """Fields whose stored value differs from the recomputed one, per day.

    A day missing on one side differs in every field that has a value.
    """
    keys = [*by, "day"]
    left = stored.select(*keys, *[F.col(f).alias(f"s_{f}") for f in fields])
    right = recomputed.select(*keys, *[F.col(f).alias(f"r_{f}") for f in fields])
    values = {
        f: {"stored": F.col(f"s_{f}").cast("bigint"), "recomputed": F.col(f"r_{f}").cast("bigint")}
        for f in fields
    }
    return (
        left.join(right, keys, "full_outer")
        .select(*_long_form(keys, values))
        .select(*keys, "r.*")
        .where(~F.col("stored").eqNullSafe(F.col("recomputed")))
    )


def range_violations(
    daily: DataFrame,
    ranges: Mapping[str, tuple[int, int]],
    by: Sequence[str] = (),
) -> DataFrame:
    """Values outside their field's bounds. The bounds are constants in the plan."""
    keys = [*by, "day"]
    values = {
        f: {
            "value": F.col(f).cast("bigint"),
            "low": F.lit(lo).cast("bigint"),
            "high": F.lit(hi).cast("bigint"),
        }
        for f, (lo, hi) in ranges.items()
    }
    outside = (F.col("value") < F.col("low")) | (F.col("value") > F.col("high"))
    return daily.select(*_long_form(keys, values)).select(*keys, "r.*").where(outside)


#: Calendar days of a bucket, by which bounds meet the values of their time.
BUCKET_DAYS = 32


def _bucket(day: Column) -> Column:
    return F.floor(F.unix_date(day) / BUCKET_DAYS)


def checked_bounds(bounds: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Bounds with their days as dates; two that hold on the same day, or end early, are an error.

    Each reads *by, ``field``, ``valid_from``, ``valid_to``, ``low``, ``high``: the bounds of a
    field from one day to another, both included. A null is open. The error is raised by whatever
    reads the result, no job runs here.
    """
    keys = [*by, "field"]
    start, end = F.col("valid_from").cast("date"), F.col("valid_to").cast("date")
    dated = bounds.select(*keys, start.alias("valid_from"), end.alias("valid_to"), "low", "high")
    earlier = Window.partitionBy(*keys).orderBy(
        F.asc_nulls_first("valid_from"), F.asc_nulls_last("valid_to")).rowsBetween(
            Window.unboundedPreceding, -1)
    last = F.max(F.coalesce("valid_to", F.lit("9999-12-31").cast("date"))).over(earlier)
    name = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys])
    wrong = (
        F.when(F.col("valid_to") < F.col("valid_from"),
               F.raise_error(F.concat(F.lit("bounds end before they start: "), name)))
        .when(F.col("_last") >= F.coalesce("valid_from", F.lit("0001-01-01").cast("date")),
              F.raise_error(F.concat(F.lit("overlapping bounds: "), name)))
        .otherwise(F.lit(True)).cast("boolean")
    )
    return dated.withColumn("_last", last).where(wrong).drop("_last")


def bound_violations(
    daily: DataFrame,
    bounds: DataFrame,
    fields: Sequence[str],
    by: Sequence[str] = (),
) -> DataFrame:
    """Values outside the bounds that hold for their key, field and day, from a table of bounds.

    Values and bounds meet by key, field and a range of days, so long histories of bounds and of
    values join by equality, and no value sees bounds of other times than its own. Values without
    a day, or without bounds for it, are not judged. See :func:`checked_bounds`.
    """
    keys = [*by, "field"]
    values = {f: {"value": F.col(f).cast("double")} for f in fields}
    long = daily.select(*_long_form([*by, "day"], values)).select(*by, "day", "r.*")
    long = long.where(F.col("value").isNotNull() & F.col("day").isNotNull()).withColumn(
        "_date", F.col("day").cast("date"))
    first, last = (daily.agg(f(F.col("day").cast("date")).alias("d")).scalar()
                   for f in (F.min, F.max))
    limits = (
        checked_bounds(bounds, by).withColumnsRenamed({k: f"_{k}" for k in keys})
        .withColumns({"_first": first, "_until": last})
        .withColumns({"_begin": F.greatest("valid_from", "_first"),
                      "_end": F.least("valid_to", "_until")})
        .where(F.col("_begin") <= F.col("_end"))
        .withColumn("_bucket", F.explode(F.sequence(_bucket(F.col("_begin")),
                                                    _bucket(F.col("_end")))))
    )
    same = reduce(and_, [long[k].eqNullSafe(limits[f"_{k}"]) for k in keys])
    joined = long.withColumn("_at", _bucket(F.col("_date"))).join(
        limits, same & (F.col("_at") == F.col("_bucket"))
        & F.col("_date").between(F.col("_begin"), F.col("_end")))
    outside = (F.col("value") < F.col("low")) | (F.col("value") > F.col("high"))
    return joined.where(outside).select(*by, "day", "field", "value", "low", "high")


def accept_violations(df: DataFrame) -> DataFrame:
    """Rows with more accepted than generated blocks."""
    return df.where(number(ACCEPTED) > number(GENERATED))


def clamp_accepted(df: DataFrame) -> DataFrame:
    """Limit accepted blocks to the generated ones."""
    return df.withColumn(ACCEPTED, F.least(F.col(ACCEPTED), F.col(GENERATED)))


def missing_members(known: DataFrame, user_daily: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Known users without a row. The user-days are reduced to users first."""
    keys = [*by, "user_login"]
    return known.join(user_daily.select(*keys).distinct(), keys, "left_anti")


def duplicate_user_days(user_daily: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """User-days that occur more than once."""
    return (
        user_daily.groupBy(*by, "day", "user_login")
        .agg(F.count(F.lit(1)).alias("rows"))
        .where("rows > 1")
    )


def period_comparison(
    daily: DataFrame,
    span: int = 20,
    fields: Sequence[str] = (PROMPTS, AGENT_MODE),
    by: Sequence[str] = (),
) -> DataFrame:
    """Sums over the first and the last ``span`` report rows, per field."""
    needed = [*by, "day", *fields]
    early = top_k(daily.select(needed), span, [F.asc("day")], by, "_p").withColumn("_late", F.lit(False))
    late = top_k(daily.select(needed), span, [F.desc("day")], by, "_p").withColumn("_late", F.lit(True))

    def part(f, is_late):
        value = F.when(F.col("_late") == is_late, number(f)).otherwise(F.lit(0))
        return F.sum(value).cast("bigint")

    sums = whole_frame(
        early.unionByName(late),
        [part(f, side).alias(f"{n}_{f}") for f in fields for n, side in (("e", False), ("r", True))],
        by,
    )
    values = {f: {"early": F.col(f"e_{f}"), "recent": F.col(f"r_{f}")} for f in fields}
    return (
        sums.select(*_long_form(by, values))
        .select(*by, "r.*")
        .withColumn("change", F.col("recent") - F.col("early"))
    )


def swing(daily: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distance between the highest and lowest day."""
    measures = {
        "prompts_swing": number(PROMPTS),
        "agent_mode_swing": number(AGENT_MODE),
        "acceptance_rate_swing": acceptance_rate(),
    }
    return whole_frame(daily, [(F.max(c) - F.min(c)).alias(n) for n, c in measures.items()], by)


def flag_adopters(user_daily: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct users with each flag, against all users.

    Reducing to one row per user first needs one shuffle with map-side combine,
    where three distinct counts would expand every row.
    """
    per_user = user_daily.groupBy(*by, "user_login").agg(
        *[F.bool_or(is_true(f)).alias(f) for f in FLAGS]
    )
    counts = {
        "agent_users": FLAG_AGENT,
        "active_review_users": FLAG_ACTIVE,
        "passive_review_users": FLAG_PASSIVE,
    }
    return whole_frame(
        per_user,
        [F.count(F.lit(1)).alias("population")]
        + [F.count_if(F.col(f)).alias(n) for n, f in counts.items()],
        by,
    )
