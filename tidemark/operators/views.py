"""The four curated views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fields import (
    BREAKDOWN, DEFAULT_FEATURE, FLAGS, LANGUAGE_METRICS, METRICS, ORG_METRICS,
    PROMPTS, UNKNOWN_LANGUAGE, VIEW_SCHEMAS,
)
from ..functions.scalars import whole

_SQL_TYPE = {bool: "boolean", int: "bigint", float: "double", str: "string"}

# Order of each view in its published form. Ties are settled by the last key.
VIEW_ORDER = {
    "daily_summary": ["day"],
    "user_summary": [PROMPTS, "user_login"],
    "user_daily_summary": ["day", "user_login"],
    "language_summary": ["day", "activity_score", "language"],
}
_DESCENDING = {PROMPTS, "activity_score"}


def ensure_columns(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Add each column the frame does not have, as a literal default.

    Presence decides, not content: a column that exists keeps its nulls.
    """
    missing = {c: v for c, v in defaults.items() if c not in df.columns}
    if not missing:
        return df
    return df.withColumns({c: F.lit(v).cast(_SQL_TYPE[type(v)]) for c, v in missing.items()})


def empty_view(df: DataFrame, view: str, by: Sequence[str] = ()) -> DataFrame:
    """A frame without rows that has the view's declared schema."""
    keys = [T.StructField(k, df.schema[k].dataType) for k in by]
    schema = T.StructType(keys + VIEW_SCHEMAS[view].fields)
    return df.sparkSession.createDataFrame([], schema)


def sort_view(df: DataFrame, view: str, by: Sequence[str] = ()) -> DataFrame:
    """Put a view into its published order (a distributed range sort)."""
    keys = [F.asc(k) for k in by]
    for name in VIEW_ORDER[view]:
        keys.append(F.desc_nulls_first(name) if name in _DESCENDING else F.asc(name))
    return df.orderBy(*keys)


def _typed(df: DataFrame, view: str, by: Sequence[str]) -> DataFrame:
    fields = VIEW_SCHEMAS[view].fields
    casts = [f"cast({f.name} as {f.dataType.simpleString()}) as {f.name}" for f in fields]
    return df.selectExpr(*by, *casts)


def daily_summary(org: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per organization-day row; duplicates pass through."""
    if "day" not in org.columns:
        return empty_view(org, "daily_summary", by)
    full = ensure_columns(org, dict.fromkeys(METRICS + ORG_METRICS, 0))
    return _typed(full, "daily_summary", by)


def user_daily_summary(users: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per user-day row. An allow-list select, so ids never leak."""
    if not {"day", "user_login"} <= set(users.columns):
        return empty_view(users, "user_daily_summary", by)
    full = ensure_columns(users, {**dict.fromkeys(METRICS, 0), **dict.fromkeys(FLAGS, False)})
    return _typed(full, "user_daily_summary", by)


def user_totals():
    """Aggregates per user: row count, metric sums, flag days, flag any.

    All-null sums read as zero and all-null flags as false.
    """
    return [
        F.expr("count(1) as active_days"),
        *[F.expr(f"cast(coalesce(sum({m}), 0) as bigint) as {m}") for m in METRICS[1:]],
        *[F.expr(f"count_if({f}) as {f}_days") for f in FLAGS],
        *[F.expr(f"bool_or(coalesce({f}, false)) as {f}") for f in FLAGS],
    ]


def user_summary(users: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Whole-period totals per user."""
    if "user_login" not in users.columns:
        return empty_view(users, "user_summary", by)
    full = ensure_columns(users, {**dict.fromkeys(METRICS, 0), **dict.fromkeys(FLAGS, False)})
    return full.groupBy(*by, "user_login").agg(*user_totals())


def _entry_fields(df: DataFrame, column: str) -> set[str]:
    kind = df.schema[column].dataType
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        return set(kind.elementType.names)
    return set()


def language_entries(
    df: DataFrame, keys: Sequence[str] = ("day",), column: str = BREAKDOWN
) -> DataFrame:
    """One row per breakdown entry, with defaults for absent or null fields.

    Null and empty arrays yield no rows; null entries are skipped.
    """
    have = _entry_fields(df, column)
    if not have:  # an all-null or non-list column was inferred as something else
        schema = T.StructType(
            [T.StructField(k, df.schema[k].dataType) for k in keys]
            + [T.StructField("language", T.StringType()), T.StructField("feature", T.StringType())]
            + [T.StructField(m, T.LongType()) for m in LANGUAGE_METRICS]
        )
        return df.sparkSession.createDataFrame([], schema)

    def text(name, default):
        if name not in have:
            return F.lit(default).alias(name)
        return F.coalesce(F.col(f"e.{name}").cast("string"), F.lit(default)).alias(name)

    def count(name):
        if name not in have:
            return F.lit(0).cast("bigint").alias(name)
        return F.coalesce(whole(f"e.{name}"), F.lit(0)).cast("bigint").alias(name)

    return (
        df.select(*keys, F.explode(column).alias("e"))
        .where(F.col("e").isNotNull())
        .select(
            *keys,
            text("language", UNKNOWN_LANGUAGE),
            text("feature", DEFAULT_FEATURE),
            *[count(m) for m in LANGUAGE_METRICS],
        )
    )


def language_summary(org: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Breakdown summed per (day, language); the feature is summed away."""
    if not {"day", BREAKDOWN} <= set(org.columns):
        return empty_view(org, "language_summary", by)
    typed = org.withColumn("day", F.col("day").cast("string"))
    return language_totals(language_entries(typed, [*by, "day"]), by)


def language_totals(entries: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sum flattened entries per (day, language) and score them."""
    score = F.expr(" + ".join(LANGUAGE_METRICS))
    return (
        entries.groupBy(*by, "day", "language")
        .agg(*[F.sum(m).alias(m) for m in LANGUAGE_METRICS])
        .withColumn("activity_score", score)
    )
