"""One ingestion run: landed reports in, published views and ledger states out."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fields import RAW_TABLES
from ..operators import views
from ..sources import ledger, snapshots
from ..sources.days import check_window
from ..sources.landing import Registry, landed_days
from ..sources.ndjson import read_ndjson


def new_run_id(started_at: dt.datetime, invocation_id: str | None = None) -> str:
    suffix = (invocation_id or uuid.uuid4().hex)[:8]
    return f"{started_at.astimezone(dt.timezone.utc):%Y%m%dT%H%M%SZ}-{suffix}"


def _second(now: dt.datetime) -> dt.datetime:
    return now.astimezone(dt.timezone.utc).replace(microsecond=0)


def ingest(
    spark: SparkSession,
    org_paths: str | Sequence[str],
    user_paths: str | Sequence[str],
    root: str,
    report_window_days: int = 100,
    end: dt.date | None = None,
    **options,
) -> dict:
    """Build and publish the four views from report files, with a ledger entry before and after.

    Only the ``report_window_days`` calendar days up to ``end`` (the last landed day, unless given)
    are taken from the reports, so the ledger states what was read. All files are parsed to find
    them; reports in the landing layout are better read by :func:`ingest_landed`.
    """
    def read() -> list[DataFrame]:
        reports = [read_ndjson(spark, org_paths), read_ndjson(spark, user_paths)]
        return in_window(reports, report_window_days, end)

    return _run(spark, read, root, report_window_days, **options)


def ingest_landed(
    spark: SparkSession,
    landing: str,
    root: str,
    report_window_days: int = 100,
    end: dt.date | None = None,
    **options,
) -> dict:
    """The same from a landing area of days and deliveries (see sources/landing.py).

    Only the newest deliveries of the window's days are opened. Their schemas come from a registry
    below ``root``; text is parsed for them once, when a delivery is new or has other files.
    """
    def read() -> list[DataFrame]:
        tables = [Registry(spark, f"{landing}/{table}", f"{root}/registry") for table in RAW_TABLES]
        days = [day for t in tables for day in landed_days(spark, t.root)]
        last = end or (dt.date.fromisoformat(max(days)) if days else None)
        return [t.read(t.window(report_window_days, last)) for t in tables]

    return _run(spark, read, root, report_window_days, **options)


def _run(
    spark: SparkSession,
    read: Callable[[], Sequence[DataFrame]],
    root: str,
    report_window_days: int,
    org: str | None = None,
    source: str = "reports",
    trigger: str = "manual",
    invocation_id: str | None = None,
    fmt: str = "parquet",
    keep_raw: bool = True,
) -> dict:
    """One run of the ledger. Any failure is recorded as such and raised again.

    The user reports are parsed for the user-day view only; the user totals are taken from its
    written copy.
    """
    check_window(report_window_days)
    started = dt.datetime.now(dt.timezone.utc)
    ledger_path, owner = f"{root}/ledger", org or "mock"
    run = {
        "id": new_run_id(started, invocation_id),
        "source": source,
        "status": "running",
        "trigger": trigger,
        "started_at": _second(started),
        "report_window_days": report_window_days,
        "org": org,
        "invocation_id": invocation_id,
    }
    ledger.append_event(spark, ledger_path, run)
    try:
        org_raw, user_raw = read()
        run.update(_build(spark, org_raw, user_raw, root, owner, source, run["id"], fmt, keep_raw))
        run["status"] = "succeeded"
    except BaseException as e:
        run.update(status="failed", error=str(e))
        raise
    finally:
        run["completed_at"] = _second(dt.datetime.now(dt.timezone.utc))
        ledger.append_event(spark, ledger_path, run)
    return run


def in_window(
    reports: Sequence[DataFrame], days: int, end: dt.date | None = None
) -> list[DataFrame]:
    """The rows of the last ``days`` calendar days; reports without a day column as they are."""
    dated = [r for r in reports if "day" in r.columns]
    if not dated:
        return list(reports)
    if end is None:
        lasts = [r.agg(F.max("day").cast("date").alias("last")).scalar() for r in dated]
        last = F.greatest(*lasts) if len(lasts) > 1 else lasts[0]
    else:
        last = F.lit(end)
    first = F.date_sub(last, days - 1).cast("string")
    inside = (F.col("day") >= first) & (F.col("day") <= last.cast("string"))
    return [r.where(inside) if "day" in r.columns else r for r in reports]


def _build(spark, org_raw, user_raw, root, owner, source, run_id, fmt, keep_raw) -> dict:
    """Write raw copies and views; the counts are those of the writes themselves."""
    kept = {}
    if keep_raw:
        reports = {"org_metrics": org_raw, "user_metrics": user_raw}
        kept = {name: snapshots.stage(name, df, root, owner, source, run_id, "raw", "json")
                for name, df in reports.items()}
    staged = {
        name: snapshots.stage(name, df, root, owner, source, run_id, fmt=fmt)
        for name, df in {
            "daily_summary": views.daily_summary(org_raw),
            "language_summary": views.language_summary(org_raw),
            "user_daily_summary": views.user_daily_summary(user_raw),
        }.items()
    }
    if {"day", "user_login"} <= set(user_raw.columns):
        folder = staged["user_daily_summary"].table.parts[""].path
        place = f"{snapshots.log_root(root, 'views', owner, source)}/{folder}"
        totals = views.user_summary(
            snapshots.read_path(spark, "user_daily_summary", place, fmt))
    else:  # the totals need no day, the user-day view does
        totals = views.user_summary(user_raw)
    staged["user_summary"] = snapshots.stage(
        "user_summary", totals, root, owner, source, run_id, fmt=fmt)
    return {
        "raw_records": {name: w.rows for name, w in kept.items()},
        "snapshot_records": {name: w.rows for name, w in staged.items()},
        "raw_places": snapshots.switch(spark, kept, root, owner, source, run_id, "raw")
        if kept else {},
        "snapshot_places": snapshots.switch(spark, staged, root, owner, source, run_id),
    }
