"""Trailing report windows, counted in report rows rather than calendar days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fields import DEFAULT_WINDOW, WINDOW_OPTIONS
from ..functions.ranking import top_k


def window_options(total_rows: int) -> list[int]:
    """The windows offered for a table of ``total_rows`` report rows."""
    fitting = [o for o in WINDOW_OPTIONS if o <= total_rows]
    if fitting:
        return fitting
    return [total_rows] if total_rows > 0 else list(WINDOW_OPTIONS)


def resolve_window(total_rows: int, selected: int | None = None) -> int:
    """The selected window if it is on offer, else the default, else the largest."""
    if total_rows <= 0:
        return DEFAULT_WINDOW
    offered = window_options(total_rows)
    if selected in offered:
        return selected
    return DEFAULT_WINDOW if DEFAULT_WINDOW in offered else offered[-1]


def _resolved(total: Column, selected: int | None) -> Column:
    """:func:`resolve_window` as an expression over a row count."""
    smallest = WINDOW_OPTIONS[0]
    largest_fitting = total
    for option in WINDOW_OPTIONS:
        if option <= DEFAULT_WINDOW:
            largest_fitting = F.when(total >= option, F.lit(option)).otherwise(largest_fitting)
    if selected is None:
        return largest_fitting
    on_offer = (total < smallest) & (total == selected)
    if selected in WINDOW_OPTIONS:
        on_offer = on_offer | (total >= selected)
    return F.when(on_offer, F.lit(selected)).otherwise(largest_fitting)


def last_days(daily: DataFrame, n: int, by: Sequence[str] = ()) -> DataFrame:
    """The last ``n`` report rows by day; a day listed twice goes by its other columns."""
    return top_k(daily, n, _by_day(daily, by), by, "_pos").drop("_pos")


def _by_day(daily: DataFrame, by: Sequence[str]) -> list[Column]:
    rest = [f.name for f in daily.schema if f.name not in ("day", *by) and _sortable(f.dataType)]
    return [F.desc("day"), *[F.desc(F.col(f"`{c}`")) for c in rest]]


def _sortable(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.MapType, T.ArrayType, T.StructType, T.VariantType))


def visible_days(
    daily: DataFrame, selected: int | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """The report rows of the resolved window, without an action.

    No window exceeds the largest option, so that many rows per key settle both
    the count and the choice.
    """
    top = top_k(daily, max(WINDOW_OPTIONS), _by_day(daily, by), by, "_pos")
    total = F.count(F.lit(1)).over(Window.partitionBy(*by))
    kept = top.withColumn("_total", total).where(
        F.col("_pos") <= _resolved(F.col("_total"), selected)
    )
    return kept.drop("_pos", "_total")


def restrict_to_days(
    detail: DataFrame, days: DataFrame, by: Sequence[str] = ()
) -> DataFrame:
    """Keep the detail rows whose day is among ``days``.

    One key-less window holds at most the largest window option of days, so it is
    broadcast; with keys the size depends on their number and Spark decides.
    """
    keys = [*by, "day"]
    chosen = days.select(*keys)
    return detail.join(chosen if by else F.broadcast(chosen), keys, "left_semi")
