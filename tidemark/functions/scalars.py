"""Column expressions shared by the operators. All stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fields import (
    ACCEPTED, AGENT_EDIT, AGENT_MODE, CHAT_MODES, EDIT_MODE, FLAG_ACTIVE, FLAG_AGENT,
    FLAG_PASSIVE, GENERATED, PROMPTS,
)


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number(c: Column | str) -> Column:
    """Null reads as zero."""
    if isinstance(c, str):
        return F.expr(f"coalesce({c}, 0)")
    return F.coalesce(c, F.lit(0))


def finite_number(c: Column | str) -> Column:
    """Like :func:`number` for doubles: NaN and infinities read as zero too."""
    d = col_of(c).cast("double")
    bad = d.isNull() | F.isnan(d) | (F.abs(d) == F.lit(float("inf")))
    return F.when(bad, F.lit(0.0)).otherwise(d)


def has_number(c: Column | str) -> Column:
    return col_of(c).isNotNull()


def is_true(c: Column | str) -> Column:
    """True only when the flag is strictly true; null counts as false."""
    if isinstance(c, str):
        return F.expr(f"coalesce({c}, false)")
    return F.coalesce(c, F.lit(False))


def ratio(part: Column | str, whole: Column | str, scale: int = 1) -> Column:
    """``part / whole * scale`` as a double, 0.0 unless ``whole`` is positive."""
    p, w = number(part), number(whole)
    q = p.cast("double") / w
    return F.when(w > 0, q * scale if scale != 1 else q).otherwise(F.lit(0.0))


def round_half_up(c: Column) -> Column:
    """Round a non-negative number to the nearest integer, halves upwards."""
    return F.floor(c + F.lit(0.5)).cast("bigint")


def whole(c: Column | str) -> Column:
    """Truncate towards zero."""
    return col_of(c).cast("bigint")


def acceptance_rate() -> Column:
    return ratio(ACCEPTED, GENERATED, 100)


def chat_requests() -> Column:
    return F.expr(" + ".join(f"coalesce({m}, 0)" for m in CHAT_MODES))


def review_touch_days() -> Column:
    """Active plus passive review days; a day with both counts twice."""
    return number(f"{FLAG_ACTIVE}_days") + number(f"{FLAG_PASSIVE}_days")


def capability_labels() -> Column:
    """Array of labels, one per flag that is true, in fixed order."""
    labels = [
        (FLAG_AGENT, "Coding agent"),
        (FLAG_ACTIVE, "Review active"),
        (FLAG_PASSIVE, "Review passive"),
    ]
    return F.array_compact(F.array(*[F.when(is_true(f), F.lit(t)) for f, t in labels]))


def agent_signal() -> Column:
    return number(AGENT_MODE) * 2 + number(AGENT_EDIT) * 3 + number(EDIT_MODE)


def active_review_signal() -> Column:
    return number(ACCEPTED) + F.floor(number(PROMPTS) / 2).cast("bigint") + number(EDIT_MODE)


def passive_review_signal() -> Column:
    return number(ACCEPTED) + F.floor(number(GENERATED) / 3).cast("bigint")


def utc_text(ts: Column | str) -> Column:
    """Second-precision ISO text with a ``Z`` suffix (session time zone UTC)."""
    return F.date_format(col_of(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def run_id(started_at: Column | str, invocation_id: Column | str) -> Column:
    stamp = F.date_format(col_of(started_at), "yyyyMMdd'T'HHmmss'Z'")
    return F.concat(stamp, F.lit("-"), F.substring(col_of(invocation_id), 1, 8))
