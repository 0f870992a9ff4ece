"""Organization rows from user rows: sums, rolling distinct users, breakdowns.

Rolling distinct counts do not use a set per window. A user who qualifies on day
``i`` counts for windows ending on days ``i .. i+N-1``, or until their next
qualifying day takes over. Each qualifying user-day therefore adds one at ``i``
and takes one away at ``min(i+N, next)``, and a running sum over the days gives
every window. One shuffle by user finds ``next``; what follows is grouped by
(day, next) and does not grow with the users.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..fields import (
    AGENT_1D, AGENT_28D, AGENT_7D, AGENT_EDIT, AGENT_MODE, BREAKDOWN, FLAG_AGENT, GENERATED,
    LANGUAGE_METRICS, METRICS, MONTHLY_AGENT, PROMPTS,
)
from ..functions.scalars import is_true, number
from ..sources.days import indexed_days

USES_AGENT = "uses_agent"
ANY_AGENT = "any_agent"


def agent_predicates() -> dict[str, Column]:
    """Who counts as a coding-agent user, and as an agent user of any kind."""
    flag = is_true(FLAG_AGENT)
    return {
        USES_AGENT: flag,
        ANY_AGENT: flag | (number(AGENT_MODE) > 0) | (number(AGENT_EDIT) > 0),
    }


# measure -> (predicate name, window length in report days)
AGENT_WINDOWS = {
    MONTHLY_AGENT: (ANY_AGENT, 28),
    AGENT_1D: (USES_AGENT, 1),
    AGENT_7D: (USES_AGENT, 7),
    AGENT_28D: (USES_AGENT, 28),
}


def distinct_users(
    df: DataFrame,
    predicate: Column,
    by: Sequence[str] = (),
    user: str = "user_login",
    approximate: bool = False,
) -> DataFrame:
    """Number of distinct users with a row that satisfies ``predicate``."""
    who = F.when(predicate, F.col(user))
    counted = F.approx_count_distinct(who) if approximate else F.count_distinct(who)
    return df.groupBy(*by).agg(counted.alias("users"))


def _on_spine(df: DataFrame, spine: DataFrame, by: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    days = indexed_days(spine, by)
    keys = [*by, "day"]
    # One key-less spine is a list of days; with keys Spark sizes the join itself.
    return days, df.join(days if by else F.broadcast(days), keys)


def day_measures(
    users: DataFrame,
    spine: DataFrame,
    sums: Sequence[str] = (),
    predicates: Mapping[str, Column] | None = None,
    windows: Mapping[str, tuple[str, int]] | None = None,
    by: Sequence[str] = (),
    user: str = "user_login",
    unique: bool = False,
) -> DataFrame:
    """Per spine day: sums of user-day columns and rolling distinct users.

    Everything comes from one pass over the user-days. Days without users are
    kept with zero sums, and still take up a place in the rolling windows. Say
    ``unique`` if no user-day occurs twice, which saves a shuffle.
    """
    windows = dict(windows or {})
    if not windows:
        days = indexed_days(spine, by)
        daily = users.groupBy(*by, "day").agg(*_summed(sums))
        return _complete(days, daily, sums, [], by, "day")

    used = {p for p, _ in windows.values()}
    predicates = {n: c for n, c in (predicates or {}).items() if n in used}
    if unique:
        folded = users.select(*by, "day", user, *sums, *[c.alias(n) for n, c in predicates.items()])
    else:
        # Duplicate user-days are folded first (map-side), so a user brings at most
        # one row per report day to the window below.
        folded = users.groupBy(*by, "day", user).agg(
            *_summed(sums), *[F.bool_or(c).alias(n) for n, c in predicates.items()]
        )
    days, rows = _on_spine(folded, spine, by)
    longest = {p: max(n for q, n in windows.values() if q == p) for p in predicates}
    later = (
        Window.partitionBy(*by, user)
        .orderBy(F.desc("idx"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    # Index at which a later qualifying day takes over; capped, since beyond the
    # longest window all values act alike.
    upcoming = {
        f"_next_{p}": F.min(F.when(F.col(p), F.col("idx"))).over(later) for p in predicates
    }
    caps = {p: f"idx + {longest[p]}" for p in predicates}
    rows = rows.withColumns(upcoming).withColumns(
        {
            f"_next_{p}": F.expr(f"if({p}, least(coalesce(_next_{p}, {cap}), {cap}), null)")
            for p, cap in caps.items()
        }
    )
    cells = rows.groupBy(*by, "idx", *[f"_next_{n}" for n in predicates]).agg(
        *_summed(sums), F.expr("count(1) as _users")
    )

    # Each cell becomes a few changes: its sums and arrivals on its own day, and
    # per measure the departures on the day its users stop counting.
    def change(idx, carries_sums, counts):
        fields = [f"'idx', {idx}"]
        fields += [f"'{c}', {c if carries_sums else 'cast(0 as bigint)'}" for c in sums]
        fields += [f"'{m}', {counts.get(m, 'cast(0 as bigint)')}" for m in windows]
        return f"named_struct({', '.join(fields)})"

    arrivals = {
        m: f"if(_next_{p} is null, cast(0 as bigint), _users)" for m, (p, _) in windows.items()
    }
    changes = [change("idx", True, arrivals)] + [
        change(f"least(idx + {n}, _next_{p})", False, {m: f"-({arrivals[m]})"})
        for m, (p, n) in windows.items()
    ]
    daily = (
        cells.select(*by, F.expr(f"explode(array({', '.join(changes)})) as c"))
        .select(*by, "c.*")
        .groupBy(*by, "idx")
        .agg(*_summed([*sums, *windows]))
    )
    return _complete(days, daily, sums, list(windows), by, "idx")


def _summed(columns: Sequence[str]) -> list[Column]:
    return [F.expr(f"cast(coalesce(sum({c}), 0) as bigint) as {c}") for c in columns]


def _complete(days, daily, sums, running, by, key) -> DataFrame:
    """Join the small per-day frame to the spine and run the counters over it."""
    over = f"({'partition by ' + ', '.join(by) if by else ''} order by idx rows unbounded preceding)"
    full = days.join(daily, [*by, key], "left")
    return full.selectExpr(
        *by,
        "day",
        *[f"coalesce({c}, 0) as {c}" for c in sums],
        *[f"cast(sum(coalesce({c}, 0)) over {over} as bigint) as {c}" for c in running],
    )


def org_rollup(users: DataFrame, spine: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The nine user metrics summed per report day."""
    return day_measures(users, spine, sums=METRICS, by=by)


def rolling_distinct(
    users: DataFrame,
    spine: DataFrame,
    predicate: Column,
    windows: Mapping[str, int],
    by: Sequence[str] = (),
    user: str = "user_login",
    unique: bool = False,
) -> DataFrame:
    """Distinct qualifying users over the trailing N report days, per name in ``windows``."""
    return day_measures(
        users, spine,
        predicates={"_p": predicate},
        windows={name: ("_p", n) for name, n in windows.items()},
        by=by, user=user, unique=unique,
    )


def rolling_agent_users(
    users: DataFrame, spine: DataFrame, by: Sequence[str] = (), **options
) -> DataFrame:
    """Coding-agent users of the last 1, 7 and 28 report days."""
    return rolling_distinct(
        users, spine, agent_predicates()[USES_AGENT],
        {AGENT_1D: 1, AGENT_7D: 7, AGENT_28D: 28}, by, **options,
    )


def monthly_agent_users(
    users: DataFrame, spine: DataFrame, days: int = 28, by: Sequence[str] = (), **options
) -> DataFrame:
    """Users of any agent feature over the last ``days`` report days."""
    return rolling_distinct(
        users, spine, agent_predicates()[ANY_AGENT], {MONTHLY_AGENT: days}, by, **options
    )


def org_daily(
    users: DataFrame, spine: DataFrame, by: Sequence[str] = (), **options
) -> DataFrame:
    """Complete organization-day rows (without breakdown), in one pass."""
    return day_measures(
        users, spine, sums=METRICS,
        predicates=agent_predicates(), windows=AGENT_WINDOWS, by=by, **options,
    )


def qualifying_cells(predicate: str, before: Column, after: Column) -> Column:
    """How a user's qualifying days changed, from two sorted arrays of days.

    A cell is a qualifying day with the one that follows it (null at the end). Gives an array of
    (predicate, day, next, n): n is 1 for cells that are new and -1 for those that are gone.
    """
    def cells(days: Column) -> Column:
        following = F.concat(F.slice(days, 2, F.greatest(F.size(days), F.lit(1))),
                             F.array(F.lit(None).cast("string")))
        return F.zip_with(days, F.slice(following, F.lit(1), F.size(days)),
                          lambda day, later: F.struct(day.alias("day"), later.alias("next")))

    def signed(of: Column, n: int) -> Column:
        return F.transform(of, lambda c: F.struct(
            F.lit(predicate).alias("predicate"), c["day"].alias("day"),
            c["next"].alias("next"), F.lit(n).cast("bigint").alias("n")))

    old, new = cells(before), cells(after)
    return F.concat(signed(F.array_except(new, old), 1), signed(F.array_except(old, new), -1))


def org_from_cells(cells: DataFrame, sums: DataFrame, spine: DataFrame) -> DataFrame:
    """Organization-day rows from (predicate, day, next, n) cells and the metric sums by day.

    Equal to :func:`org_daily` over the user-days that the cells and sums were taken from. What is
    read here grows with the days, not with the users.
    """
    days = indexed_days(spine)
    first, second = days.withColumnRenamed("idx", "_i"), days.toDF("next", "_next")
    placed = cells.join(F.broadcast(first), "day").join(F.broadcast(second), "next", "left")
    zero = F.lit(0).cast("bigint")

    def change(idx: Column, counts: Mapping[str, Column]) -> Column:
        return F.struct(idx.cast("bigint").alias("idx"), *[zero.alias(c) for c in METRICS],
                        *[counts.get(m, zero).alias(m) for m in AGENT_WINDOWS])

    def of(predicate: str) -> Column:
        return F.when(F.col("predicate") == predicate, F.col("n")).otherwise(zero)

    arrivals = change(F.col("_i"), {m: of(p) for m, (p, _) in AGENT_WINDOWS.items()})
    departures = [change(F.least(F.col("_i") + n, F.col("_next")), {m: -of(p)})
                  for m, (p, n) in AGENT_WINDOWS.items()]
    moved = placed.select(F.explode(F.array(arrivals, *departures)).alias("c")).select("c.*")
    own = sums.join(F.broadcast(days), "day").select(
        F.col("idx").cast("bigint").alias("idx"), *METRICS, *[zero.alias(m) for m in AGENT_WINDOWS])
    daily = own.unionByName(moved).groupBy("idx").agg(*_summed([*METRICS, *AGENT_WINDOWS]))
    return _complete(days, daily, METRICS, list(AGENT_WINDOWS), [], "idx")


def org_language_entries(entries: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """User-level breakdown entries summed per (day, language, feature)."""
    return entries.groupBy(*by, "day", "language", "feature").agg(
        *_summed(LANGUAGE_METRICS)
    )


def nest_breakdown(entries: DataFrame, keys: Sequence[str] = ("day",)) -> DataFrame:
    """Rebuild the breakdown array per key.

    Entries are ordered by generated and prompts, both descending, then language
    and feature. Call it on summed entries: an array then holds one element per
    (language, feature).
    """
    fields = ["language", "feature", *LANGUAGE_METRICS]
    element = F.struct(
        (-F.col(GENERATED)).alias("a"), (-F.col(PROMPTS)).alias("b"),
        F.col("language").alias("c"), F.col("feature").alias("d"),
        F.struct(*fields).alias("e"),
    )
    ordered = F.array_sort(F.collect_list(element))
    return entries.groupBy(*keys).agg(F.transform(ordered, lambda x: x["e"]).alias(BREAKDOWN))
