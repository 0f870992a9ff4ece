"""Every registered query: name -> function of (session, data folder)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fields import (
    ACCEPTED, ACTIVE_USERS, AGENT_EDIT, AGENT_MODE, ASK_MODE, BREAKDOWN, CUSTOM_MODE, EDIT_MODE,
    FLAG_AGENT, FLAGS, GENERATED, LANGUAGE_METRICS, METRICS, PROMPTS,
)
from ..functions.scalars import is_true, utc_text
from ..operators import (
    allocate, kpis, languages, quality, rollups, sketches, trends, users, views, windows,
)
from ..sources import days, ledger, manifest, ndjson, scratch, snapshots
from ..streaming import refresh as streaming
from . import event_model as model
from . import ingest as ingestion
from .ledger_model import run_events

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _user_days(spark, sf):
    return model.user_days(model.events(spark, sf))


def _daily(spark, sf):
    return model.org_days(model.events(spark, sf))


#: Days before the first visible one that reach into its rolling counts.
_LEAD = 27


def _window(spark, sf, lead=0, last_rows=None):
    """Events and spine of the visible window, with some days before it, and the window's spine.

    The log is scanned once; its first and last day are known beforehand. Its days have no gaps, so
    the last report rows are the last calendar days.
    """
    span = model.span(spark, sf)
    if span is None:
        ev = model.events(spark, sf)
        return ev, model.event_days(ev), model.event_days(ev)
    first, last = span
    rows = last_rows or windows.resolve_window((last - first).days + 1)
    shown = max(first, last - dt.timedelta(days=rows - 1))
    read = max(first, shown - dt.timedelta(days=lead))
    return (model.since(spark, sf, read), model.days_between(spark, read, last),
            model.days_between(spark, shown, last))


def _visible(spark, sf):
    """Visible report days, from the events of these days and those that reach into them."""
    ev, with_lead, visible = _window(spark, sf, _LEAD)
    return windows.restrict_to_days(model.org_days(ev, with_lead), visible)


def _visible_sums(spark, sf):
    """Visible report days without the rolling counts: no shuffle by user."""
    ev, _, visible = _window(spark, sf)
    return rollups.org_rollup(model.user_days(ev), visible)


def _sums(spark, sf):
    ev = model.events(spark, sf)
    return rollups.org_rollup(model.user_days(ev), model.event_days(ev))


def _visible_user_days(spark, sf):
    ev, _, visible = _window(spark, sf)
    return windows.restrict_to_days(model.user_days(ev), visible)


def _window_users(spark, sf):
    return users.window_user_summary(_visible_user_days(spark, sf))


def _visible_languages(spark, sf):
    ev, _, visible = _window(spark, sf)
    return windows.restrict_to_days(views.language_totals(model.org_entries(ev)), visible)


# --- curated views ---------------------------------------------------------


@query
def daily_summary(spark: SparkSession, sf: str) -> DataFrame:
    return views.sort_view(views.daily_summary(_daily(spark, sf)), "daily_summary")


@query
def user_summary(spark, sf):
    return views.sort_view(views.user_summary(_user_days(spark, sf)), "user_summary")


@query
def user_daily_summary(spark, sf):
    return views.sort_view(views.user_daily_summary(_user_days(spark, sf)), "user_daily_summary")


@query
def language_summary(spark, sf):
    reports = rollups.nest_breakdown(model.org_entries(model.events(spark, sf)))
    return views.sort_view(views.language_summary(reports), "language_summary")


@query
def language_flatten(spark, sf):
    keys = ["day", "user_login"]
    nested = model.user_breakdowns(model.events(spark, sf))
    return views.language_entries(nested, keys)


@query
def org_language_rollup(spark, sf):
    keys = ["day", "user_login"]
    nested = model.user_breakdowns(model.events(spark, sf))
    org = rollups.nest_breakdown(
        rollups.org_language_entries(views.language_entries(nested, keys))
    )
    return org.select("day", F.posexplode(BREAKDOWN).alias("position", "e")).select(
        "day", F.col("position").cast("bigint"), "e.*"
    )


@query
def ensure_columns(spark, sf):
    partial = _user_days(spark, sf).drop(AGENT_EDIT, *FLAGS)
    defaults = {**dict.fromkeys(METRICS, 0), **dict.fromkeys(FLAGS, False)}
    return views.ensure_columns(partial, defaults)


# --- rollups ---------------------------------------------------------------


@query
def org_rollup(spark, sf):
    return _sums(spark, sf)


@query
def rolling_agent_users(spark, sf):
    ev = model.events(spark, sf)
    return rollups.rolling_agent_users(model.user_days(ev), model.event_days(ev), unique=True)


@query
def monthly_agent_users(spark, sf):
    ev = model.events(spark, sf)
    return rollups.monthly_agent_users(model.user_days(ev), model.event_days(ev), unique=True)


@query
def weekly_any_agent_users(spark, sf):
    ev = model.events(spark, sf)
    return rollups.monthly_agent_users(
        model.user_days(ev), model.event_days(ev), days=7, unique=True
    )


@query
def sketched_agent_users(spark, sf):
    """Rolling users from stored day sketches: next to the exact counts, and whether they agree.

    Agreement is within five times the stated relative error.
    """
    ev = model.events(spark, sf)
    per_user, spine = model.user_days(ev), model.event_days(ev)
    log = manifest.Log(spark, scratch.fresh_dir(spark, "sketches"))
    sketches.store(log, "daily", sketches.user_sketches(
        per_user, rollups.agent_predicates(), ["day"]))
    found = sketches.trailing(log.open().read("daily"), spine, rollups.AGENT_WINDOWS)
    exact = rollups.org_daily(per_user, spine, unique=True)
    measures = list(rollups.AGENT_WINDOWS)
    near = F.lit(True)
    for m in measures:
        off = F.abs(F.col(f"_{m}") - F.col(m))
        near = near & (off <= 5 * sketches.relative_error() * F.col(m))
    renamed = found.withColumnsRenamed({m: f"_{m}" for m in measures})
    return exact.select("day", *measures).join(renamed, "day").select(
        "day", *measures, near.alias("agree"))


@query
def report_days(spark, sf):
    ev = model.events(spark, sf)
    spine = days.trailing_days(ev, column="date")
    return rollups.org_rollup(model.user_days(ev), spine).select("day", ACTIVE_USERS)


@query
def flag_adopters(spark, sf):
    return quality.flag_adopters(_user_days(spark, sf))


@query
def distinct_agent_users(spark, sf):
    return rollups.distinct_users(_user_days(spark, sf), is_true(FLAG_AGENT), by=["day"])


# --- windows ---------------------------------------------------------------


@query
def visible_days(spark, sf):
    ev, with_lead, _ = _window(spark, sf, _LEAD)
    return windows.visible_days(model.org_days(ev, with_lead))


@query
def last_14_days(spark, sf):
    ev, with_lead, _ = _window(spark, sf, _LEAD, last_rows=14)
    return windows.last_days(model.org_days(ev, with_lead), 14)


def _order_days(spark, sf):
    """Report rows of a log of several years: orders by day."""
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    return orders.groupBy(F.col("o_orderdate").cast("date").cast("string").alias("day")).agg(
        F.count("*").alias("orders"),
        F.sum(F.floor("o_totalprice").cast("bigint")).alias("amount"))


@query
def order_days_default(spark, sf):
    return windows.visible_days(_order_days(spark, sf))


@query
def order_days_selected(spark, sf):
    """The longest and the shortest window by choice; one that is not on offer gives the default."""
    daily = _order_days(spark, sf)
    chosen = [windows.visible_days(daily, n).withColumn("selected", F.lit(n)) for n in (28, 100, 45)]
    return chosen[0].unionByName(chosen[1]).unionByName(chosen[2])


@query
def visible_user_daily(spark, sf):
    return _visible_user_days(spark, sf)


@query
def visible_language_daily(spark, sf):
    return _visible_languages(spark, sf)


@query
def window_user_summary(spark, sf):
    return users.sort_users(_window_users(spark, sf))


# --- cards -----------------------------------------------------------------


@query
def summary_kpis(spark, sf):
    return kpis.summary_kpis(_visible_sums(spark, sf))


@query
def latest_org_metrics(spark, sf):
    return kpis.latest_org_metrics(_visible(spark, sf))


@query
def dau_insights(spark, sf):
    return kpis.dau_insights(_visible_sums(spark, sf))


@query
def code_insights(spark, sf):
    return kpis.code_insights(_visible_sums(spark, sf))


@query
def code_milestones(spark, sf):
    return kpis.code_milestones(_visible_sums(spark, sf))


@query
def code_milestones_3000(spark, sf):
    return kpis.code_milestones(_visible_sums(spark, sf), meaningful=3000)


@query
def agent_insights(spark, sf):
    return kpis.agent_insights(_visible(spark, sf))


@query
def adoption_overview(spark, sf):
    return kpis.adoption_overview(_visible(spark, sf))


# --- series ----------------------------------------------------------------


@query
def prompts_per_user(spark, sf):
    return trends.prompts_per_user(_visible_sums(spark, sf))


@query
def acceptance_rate(spark, sf):
    return trends.code_activity(_visible_sums(spark, sf))


@query
def mode_mix(spark, sf):
    return trends.mode_mix(_visible_sums(spark, sf))


@query
def agent_trend(spark, sf):
    return trends.agent_trend(_visible(spark, sf))


@query
def agent_trend_available(spark, sf):
    return trends.agent_trend_available(_visible(spark, sf))


# --- users -----------------------------------------------------------------


@query
def review_engagement(spark, sf):
    return users.review_engagement(_window_users(spark, sf), window_days=28)


@query
def review_coverage(spark, sf):
    return users.review_coverage(_window_users(spark, sf))


@query
def review_hotspots(spark, sf):
    return users.review_hotspots(_window_users(spark, sf))


@query
def top_reviewers(spark, sf):
    return users.top_reviewers(_window_users(spark, sf))


def _as_text(table):
    return table.withColumn("capabilities", F.array_join("capabilities", ", "))


@query
def user_table(spark, sf):
    return _as_text(users.user_table(_window_users(spark, sf)))


@query
def user_table_full(spark, sf):
    return _as_text(users.user_table(_window_users(spark, sf), compact=False))


# --- languages -------------------------------------------------------------


@query
def language_ranking(spark, sf):
    return languages.language_ranking(_visible_languages(spark, sf))


@query
def language_series(spark, sf):
    return languages.language_series(_visible_languages(spark, sf))


@query
def language_pivot(spark, sf):
    wide = languages.language_pivot(_visible_languages(spark, sf))
    return wide.withColumn("series", F.array_join("series", ", "))


@query
def infra_languages(spark, sf):
    return languages.infra_languages(_visible_languages(spark, sf))


# --- allocation, scores, calendar ------------------------------------------


def _order_items(spark, sf):
    """Quantity per part of each order, boosted by return status, with the order total."""
    items = spark.read.parquet(f"{sf}/lineitem.parquet")
    orders = spark.read.parquet(f"{sf}/orders.parquet").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.floor("o_totalprice").cast("bigint").alias("total"),
    )
    n = allocate.parts_of(items)
    boosted = F.col("l_quantity") * F.when(F.col("l_returnflag") == "R", 3.0).otherwise(2.0)
    boosted = items.select("l_orderkey", "l_partkey", boosted.alias("boosted"))
    keys = ["l_orderkey", "l_partkey"]
    lines = allocate.dealt(boosted, n, keys).groupBy(*keys).agg(F.sum("boosted").alias("weight"))
    if n is not None:  # orders of few bytes are still many rows, which each task would get whole
        orders = allocate.dealt(orders, n, ["l_orderkey"]).hint("merge")
    return lines.join(orders, "l_orderkey")


@query
def normalised_weights(spark, sf):
    return allocate.normalised_weights(
        _order_items(spark, sf), ["l_orderkey"], "weight", "l_partkey"
    )


@query
def apportion(spark, sf):
    return allocate.apportion_by_weight(
        _order_items(spark, sf), ["l_orderkey"], "total", "weight", "l_partkey"
    )


@query
def apportion_large_groups(spark, sf):
    """Three groups with a third of the parts each, which are cut into cells."""
    items = spark.read.parquet(f"{sf}/lineitem.parquet")
    parts = items.groupBy("l_returnflag", "l_partkey").agg(F.sum("l_quantity").alias("weight"))
    parts = parts.withColumn("total", F.lit(1_000_003).cast("bigint"))
    return allocate.apportion_by_weight(
        parts, ["l_returnflag"], "total", "weight", "l_partkey"
    )


@query
def apportion_any_scale(spark, sf):
    """The weights of an order scaled by a power of two, from 2**-960 up: the same shares."""
    items = _order_items(spark, sf)
    power = (F.col("l_orderkey") % 25 - 12) * 80
    half = F.pow(F.lit(2.0), power / 2)
    items = items.withColumn("weight", F.col("weight") * half * half)
    return allocate.apportion_by_weight(
        items, ["l_orderkey"], "total", "weight", "l_partkey").drop("weight")


@query
def feature_class(spark, sf):
    ev = model.events(spark, sf)
    phases = allocate.calendar_phases(model.event_days(ev)).select("day", "phase")
    entries = model.org_entries(ev).drop("feature").join(F.broadcast(phases), "day")
    return (
        entries.withColumn("feature", allocate.feature_of(F.col("language"), F.col("phase")))
        .groupBy("day", "phase", "language", "feature")
        .agg(*[F.sum(m).alias(m) for m in LANGUAGE_METRICS])
    )


@query
def signal_scores(spark, sf):
    return allocate.signal_scores(_user_days(spark, sf))


@query
def calendar_phase(spark, sf):
    return allocate.calendar_phases(model.event_days(model.events(spark, sf)))


# --- checks ----------------------------------------------------------------


@query
def reconcile(spark, sf):
    """Stored rows that miss each day's events after 22:00, against the full rollup."""
    ev = model.events(spark, sf)
    spine = model.event_days(ev)
    stored = rollups.org_rollup(model.user_days(ev.where("hour < 22")), spine)
    return quality.reconcile(stored, rollups.org_rollup(model.user_days(ev), spine), METRICS)


#: Bounds of one organization-day that the caller of the check gives.
_RANGES = {
    ACTIVE_USERS: (3, 10), PROMPTS: (30, 260), GENERATED: (25, 364), ACCEPTED: (5, 208),
    AGENT_MODE: (0, 68), ASK_MODE: (6, 84), EDIT_MODE: (2, 65), CUSTOM_MODE: (0, 23),
    AGENT_EDIT: (0, 47),
}


@query
def range_violations(spark, sf):
    return quality.range_violations(_sums(spark, sf), _RANGES)


@query
def bound_violations(spark, sf):
    """Orders by day and priority against bounds of each quarter, the last of them open-ended."""
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    date = F.col("o_orderdate").cast("date")
    daily = orders.groupBy(
        F.col("o_orderpriority").alias("organization"), date.cast("string").alias("day")).agg(
            F.count("*").alias("orders"), F.sum(F.floor("o_totalprice")).alias("amount"))
    quarter = F.trunc(F.col("day").cast("date"), "quarter")
    mean = daily.groupBy("organization", quarter.alias("valid_from")).agg(
        F.avg("orders").alias("orders"), F.avg("amount").alias("amount"))
    last = mean.agg(F.max("valid_from")).scalar()
    until = F.when(F.col("valid_from") < last, F.date_sub(F.add_months("valid_from", 3), 1))
    bounds = mean.select("organization", "valid_from", until.alias("valid_to"), F.explode(F.array(
        F.struct(F.lit("orders").alias("field"), F.floor(F.col("orders") * 0.5).alias("low"),
                 F.floor(F.col("orders") * 2).alias("high")),
        F.struct(F.lit("amount").alias("field"), F.lit(None).cast("bigint").alias("low"),
                 F.floor(F.col("amount") * 2).alias("high")))).alias("b")).select(
                     "organization", "valid_from", "valid_to", "b.*")
    return quality.bound_violations(daily, bounds, ["orders", "amount"], ["organization"])


def _overstated(spark, sf):
    """User-days whose accepted blocks also count agent edits."""
    return _user_days(spark, sf).withColumn(ACCEPTED, F.col(ACCEPTED) + F.col(AGENT_EDIT))


@query
def accept_violations(spark, sf):
    return quality.accept_violations(_overstated(spark, sf))


@query
def clamp_accepted(spark, sf):
    return quality.clamp_accepted(_overstated(spark, sf))


@query
def missing_members(spark, sf):
    customers = spark.read.parquet(f"{sf}/customer.parquet")
    known = customers.select(
        F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("user_login"),
        F.col("c_name").alias("name"),
    )
    return quality.missing_members(known, _user_days(spark, sf))


@query
def duplicate_user_days(spark, sf):
    """User-days that would be doubled if every event were taken as a report row."""
    ev = model.events(spark, sf)
    rows = ev.selectExpr(
        "cast(date as string) as day", "concat('u', cast(user_id as string)) as user_login"
    )
    return quality.duplicate_user_days(rows)


@query
def period_comparison(spark, sf):
    return quality.period_comparison(_sums(spark, sf), fields=METRICS)


@query
def swing(spark, sf):
    return quality.swing(_sums(spark, sf))


# --- ledger ----------------------------------------------------------------


def _text_times(df):
    times = {c: utc_text(c) for c in ("started_at", "completed_at", "updated_at") if c in df.columns}
    return df.withColumns(times)


@query
def run_ledger_current(spark, sf):
    return _text_times(ledger.current_runs(run_events(spark, sf)))


@query
def latest_per_source(spark, sf):
    return _text_times(ledger.latest_per_source(run_events(spark, sf)))


@query
def latest_per_org_source(spark, sf):
    return _text_times(ledger.latest_per_source(run_events(spark, sf), by=["org"]))


@query
def run_metrics(spark, sf):
    return _text_times(ledger.run_metrics(ledger.current_runs(run_events(spark, sf))))


# --- sources and sinks -----------------------------------------------------


def _views(spark, sf):
    ev = model.events(spark, sf)
    per_user = model.user_days(ev)
    return {
        "daily_summary": views.daily_summary(model.org_days(ev)),
        "user_summary": views.user_summary(per_user),
        "user_daily_summary": views.user_daily_summary(per_user),
        "language_summary": views.language_totals(model.org_entries(ev)),
    }


@query
def record_counts(spark, sf):
    ev = model.events(spark, sf)
    raw = {"org_metrics": model.event_days(ev), "user_metrics": model.user_days(ev)}
    return snapshots.record_counts({**raw, **_views(spark, sf)})


@query
def ndjson_roundtrip(spark, sf):
    path = scratch.fresh_dir(spark, "ndjson")
    reports = model.user_reports(model.events(spark, sf))
    ndjson.write_ndjson(reports, path)
    back = ndjson.read_ndjson(spark, path)
    return views.user_daily_summary(back)


@query
def drift_union(spark, sf):
    """Two deliveries: the earlier half of the month lacks the agent columns."""
    full = _user_days(spark, sf)
    early = full.where("day < '2024-01-16'").drop(AGENT_EDIT, FLAG_AGENT)
    late = full.where("day >= '2024-01-16'")
    return ndjson.drift_union([early, late])


@query
def history_latest(spark, sf):
    """Publish twice; the latest copy holds the second run."""
    root = scratch.fresh_dir(spark, "views")
    published = {"user_daily_summary": _views(spark, sf)["user_daily_summary"]}
    partial = {"user_daily_summary": published["user_daily_summary"].where("day < '2024-01-10'")}
    snapshots.publish(partial, root, "mock", "events", "run-1")
    snapshots.publish(published, root, "mock", "events", "run-2")
    return snapshots.read_view(spark, "user_daily_summary", [root], "mock", "events")


@query
def pinned_version(spark, sf):
    """Users by day of a version that a reader holds while the next run is published."""
    root = scratch.fresh_dir(spark, "views")
    whole = _views(spark, sf)
    early = {n: whole[n].where("day < '2024-01-10'") for n in ("user_daily_summary", "daily_summary")}
    snapshots.publish(early, root, "mock", "events", "run-1")
    held = snapshots.latest(spark, [root], "mock", "events")
    snapshots.publish({n: whole[n] for n in early}, root, "mock", "events", "run-2")
    new = snapshots.latest(spark, [root], "mock", "events")
    counted = [
        version.read("user_daily_summary").groupBy("day").agg(F.count("*").alias("user_days"))
        .join(version.read("daily_summary").select("day", ACTIVE_USERS), "day")
        .withColumn("version", F.lit(version.version.number)) for version in (held, new)]
    return counted[0].unionByName(counted[1])


@query
def snapshot_read(spark, sf):
    """The first root has no copy, so the second one serves the view."""
    root = scratch.fresh_dir(spark, "views")
    view = _views(spark, sf)["language_summary"]
    snapshots.publish({"language_summary": view}, root, "mock", "events", "run-1", fmt="json")
    return snapshots.read_view(
        spark, "language_summary", [f"{root}-absent", root], "mock", "events", fmt="json"
    )


@query
def view_documents(spark, sf):
    docs = snapshots.view_documents(
        _views(spark, sf), None, "events", "run-1", "2024-02-01T00:00:00Z"
    )
    keys = ["id", "document_type", "organization", "source", "run_id", "updated_at", "view_type"]
    return docs.groupBy(*keys).agg(F.count("item").alias("items"))


@query
def view_documents_bounded(spark, sf):
    """Three views as documents of at most 4,000 bytes, with their items."""
    views_ = _views(spark, sf)
    del views_["user_daily_summary"]
    log = manifest.Log(spark, scratch.fresh_dir(spark, "documents"))
    return snapshots.bounded_documents(
        views_, log, "acme", "events", "run-1", "2024-02-01T00:00:00Z", max_bytes=4000)


def _refreshed(spark, sf):
    """A first delivery of every day without its late events, then every day restated in full."""
    root = scratch.fresh_dir(spark, "refresh")
    landing, out, checkpoint = f"{root}/landing", f"{root}/out", f"{root}/checkpoint"
    ev = model.events(spark, sf)
    for delivery, part in (("0001", ev.where("hour < 20")), ("0002", ev)):
        streaming.land(model.user_reports(part), landing, "user_metrics", delivery)
        streaming.refresh(spark, landing, out, "user_metrics", f"{checkpoint}/user")
    return out


@query
def refresh_available_now(spark, sf):
    return streaming.read_days(spark, _refreshed(spark, sf), "user_daily_summary")


@query
def refresh_org_rows(spark, sf):
    return streaming.read_days(spark, _refreshed(spark, sf), "org_from_users")


@query
def refresh_user_totals(spark, sf):
    return views.sort_view(
        streaming.user_summary(spark, _refreshed(spark, sf)), "user_summary")


def _refreshed_org(spark, sf):
    """Every day lands with its breakdown; then days of even date are restated without one."""
    root = scratch.fresh_dir(spark, "refresh")
    landing, out = f"{root}/landing", f"{root}/out"
    reports = model.org_reports(model.events(spark, sf))
    streaming.land(reports, landing, "org_metrics", "0001")
    streaming.refresh(spark, landing, out, "org_metrics", f"{root}/checkpoint")
    empty = F.array().cast(reports.schema[BREAKDOWN].dataType)
    even = F.dayofmonth(F.col("day").cast("date")) % 2 == 0
    restated = reports.withColumn(BREAKDOWN, F.when(even, empty).otherwise(F.col(BREAKDOWN)))
    streaming.land(restated, landing, "org_metrics", "0002")
    streaming.refresh(spark, landing, out, "org_metrics", f"{root}/checkpoint")
    return out


@query
def refresh_restated_languages(spark, sf):
    """Languages after a restatement that empties the breakdown of every second day."""
    return streaming.read_days(spark, _refreshed_org(spark, sf), "language_summary")


def _published(spark, sf):
    """Views of an ingestion run, read back from their latest copies."""
    root = scratch.fresh_dir(spark, "views")
    snapshots.publish(_views(spark, sf), root, "mock", "events", "run-1")

    def read(name):
        return snapshots.read_view(spark, name, [root], "mock", "events")
    return read


@query
def published_summary_kpis(spark, sf):
    return kpis.summary_kpis(windows.visible_days(_published(spark, sf)("daily_summary")))


@query
def published_user_table(spark, sf):
    read = _published(spark, sf)
    visible = windows.visible_days(read("daily_summary"))
    detail = windows.restrict_to_days(read("user_daily_summary"), visible)
    return _as_text(users.user_table(users.window_user_summary(detail)))


@query
def published_language_ranking(spark, sf):
    read = _published(spark, sf)
    visible = windows.visible_days(read("daily_summary"))
    return languages.language_ranking(
        windows.restrict_to_days(read("language_summary"), visible))


@query
def ingest_window(spark, sf):
    """An ingestion run over the last 14 of all landed days."""
    root = scratch.fresh_dir(spark, "ingest")
    ev = model.events(spark, sf)
    ndjson.write_ndjson(model.org_reports(ev), f"{root}/org")
    ndjson.write_ndjson(model.user_reports(ev), f"{root}/user")
    ingestion.ingest(spark, f"{root}/org", f"{root}/user", f"{root}/out", org="acme",
                     report_window_days=14)
    return snapshots.read_view(spark, "user_daily_summary", [f"{root}/out"], "acme", "reports")


@query
def ingest_landed_window(spark, sf):
    """The same window from a landing area where every day was delivered twice, once in part."""
    root = scratch.fresh_dir(spark, "ingest")
    ev = model.events(spark, sf)
    for delivery, part in (("0001", ev.where("hour < 20")), ("0002", ev)):
        streaming.land(model.user_reports(part), f"{root}/landing", "user_metrics", delivery)
    streaming.land(model.org_reports(ev), f"{root}/landing", "org_metrics", "0001")
    ingestion.ingest_landed(spark, f"{root}/landing", f"{root}/out", org="acme",
                            report_window_days=14)
    return snapshots.read_view(spark, "user_daily_summary", [f"{root}/out"], "acme", "reports")
