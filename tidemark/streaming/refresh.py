"""Incremental refresh of the day-partitioned views as deliveries land.

Layout of the landing area, per raw table::

    {landing}/{table}/day=2025-01-31/delivery=0001/part-*.json

A delivery replaces earlier ones of its day; deliveries are ordered by name. The
stream only tells which days have new files. Each touched day is then read again
in full from its newest delivery, so parts of one day in several micro-batches end
in the same state.

A delivery that withdraws all rows of its day holds one blank line: Spark's file
source does not report files of zero bytes.

A micro-batch is a run: the ledger has it as running, then as succeeded or failed. It
writes new folders and names them all in one version of the manifest log at ``out``, under
the id of the stream and the number of the batch. A batch that is killed between any two
writes and repeated therefore leaves one version and one run, and readers see the views of
before or of after, all together.

What a day of user reports changes elsewhere is worked out from its old and new rows:

* ``user_state``, cut into buckets by user, holds the totals of each user and the days on which
  they qualify for the rolling counts. Old rows of the touched days are subtracted, new ones
  added; only buckets with touched users are read and written.
* ``cells`` counts, over all users, qualifying days by the one that follows. Touched users
  change a few of them. They and the sums by day make the organization rows, whatever days are
  listed in between, so neither the users nor the other days are read again.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fields import (
    BREAKDOWN, BREAKDOWN_TYPE, FLAGS, METRICS, ORG_METRICS, RAW_TABLES, VIEW_SCHEMAS,
)
from ..operators import rollups, views
from ..sources import landing as landed
from ..sources import ledger
from ..sources.files import text_of
from ..sources.manifest import Log, Snapshot, Table, Version, Written

_VIEWS_OF: Mapping[str, dict[str, Callable[[DataFrame], DataFrame]]] = {
    "user_metrics": {"user_daily_summary": views.user_daily_summary},
    "org_metrics": {
        "daily_summary": views.daily_summary,
        "language_summary": views.language_summary,
    },
}
_KNOWN_TYPES = {
    **{c: T.LongType() for c in METRICS + ORG_METRICS},
    **{c: T.BooleanType() for c in FLAGS},
    "user_login": T.StringType(),
    BREAKDOWN: BREAKDOWN_TYPE,
}
BUCKETS = 64  # of user_state, when it is made; a table keeps the number that it was made with


class ConcurrentRefresh(RuntimeError):
    """Another writer changed the tables that this batch was worked out from."""


class _Batch:
    """What one micro-batch writes, worked out from one version."""

    def __init__(self, spark: SparkSession, landing: str, out: str, table: str, buckets: int):
        self.spark, self.landing, self.table, self.buckets = spark, landing, table, buckets
        self.log = Log(spark, out)
        self.before = self.log.open() or Snapshot(spark, self.log.root, Version())
        self.staged: dict[str, Written] = {}
        self.gone: dict[str, set[str]] = {}

    def old(self, name: str, schema, keys: list[str] | None = None) -> DataFrame:
        """A table of the version before, empty if it has none."""
        if name not in self.before:
            return self.spark.createDataFrame([], schema)
        return self.before.read(name, keys)

    def write(self, name: str, df: DataFrame, key: str | None = None, **options) -> DataFrame:
        self.staged[name] = written = self.log.write(df, name, key, options=options)
        return self.log.staged(name, written)

    def listed(self) -> dict[str, landed.Delivery]:
        """The newest delivery of each listed day, with its schema: one row a day."""
        rows = self.old(f"days_{self.table}", landed.DELIVERIES).collect()
        return {r.day: landed.Delivery.of(r) for r in rows}

    def run(self, touched: list[str]) -> None:
        root, listed = f"{self.landing}/{self.table}", self.listed()
        now = landed.registered(self.spark, root, landed.newest(self.spark, root, touched))
        redone = {d.day for d in now}
        after = {day: d for day, d in listed.items() if day not in redone}
        after |= {d.day: d for d in now if d.schema is not None}
        schema = landed.merged(root, after.values())

        def seen(of: T.StructType) -> set[str]:
            return set(of.names) & set(_KNOWN_TYPES)

        if listed and seen(landed.merged(root, listed.values())) != seen(schema):
            # A field came or went, which decides null or default on every other day.
            redone |= set(listed)
        filled = sorted(redone & set(after))
        rows = None
        if filled:
            rows = landed.scan(self.spark, root, [after[d] for d in filled], schema, _KNOWN_TYPES)
        for view, build in _VIEWS_OF[self.table].items():
            if rows is not None:
                self.write(view, build(rows), "day")
            # a day with rows may have none in this view, for instance an empty breakdown
            kept = set(self.staged[view].table.parts) if view in self.staged else set()
            self.gone[view] = redone - kept
        days = self.spark.createDataFrame([after[d].row() for d in sorted(after)],
                                          landed.DELIVERIES)
        self.write(f"days_{self.table}", days.coalesce(1))
        if self.table == "user_metrics":
            self._users(sorted(redone), sorted(after))

    def _users(self, redone: list[str], listed: list[str]) -> None:
        """Totals, rolling counts and organization rows from the old and new rows of some days."""
        view, schema = "user_daily_summary", VIEW_SCHEMAS["user_daily_summary"]
        new = self.spark.createDataFrame([], schema)
        if view in self.staged:
            new = self.log.staged(view, self.staged[view], schema=schema)
        old = self.old(view, schema, redone).select(*schema.names)
        self._state(_contributions(new, 1).unionByName(_contributions(old, -1)), redone)
        sums = self.old("day_sums", T.StructType(
            [T.StructField("day", T.StringType())]
            + [T.StructField(m, T.LongType()) for m in METRICS]))
        fresh = new.groupBy("day").agg(*[F.sum(m).cast("bigint").alias(m) for m in METRICS])
        kept = sums.where(~F.col("day").isin(redone)) if redone else sums
        sums = self.write("day_sums", kept.unionByName(fresh).coalesce(1))
        cells = self.log.staged("cells", self.staged["cells"])
        spine = self.spark.createDataFrame([(d,) for d in listed], "day string")
        rows = rollups.org_from_cells(cells, sums, spine)
        self.write("org_from_users", rows.select(*VIEW_SCHEMAS["daily_summary"].names).coalesce(1))

    def _state(self, changes: DataFrame, redone: list[str]) -> None:
        table = self.before.version.tables.get("user_state")
        buckets = int(table.options["buckets"]) if table else self.buckets
        bucket = F.pmod(F.xxhash64("user_login"), F.lit(buckets)).cast("string")
        changes = self._stored(changes.withColumn("bucket", bucket))
        touched = [r.bucket for r in changes.select("bucket").distinct().collect()]
        state = self.old("user_state", _STATE, touched).drop("changes")
        none = F.array().cast("array<string>")
        both = state.withColumns({"touched": F.lit(False), **{f"new_{p}": none for p in _KINDS}})
        both = both.unionByName(changes.withColumns(
            {"touched": F.lit(True), **{p: none for p in _KINDS}}))

        def all_of(column: str) -> Column:
            return F.array_distinct(F.flatten(F.collect_list(column)))

        merged = both.groupBy("bucket", "user_login").agg(
            *[F.sum(c).alias(c) for c in _TOTALS], F.bool_or("touched").alias("touched"),
            *[F.sort_array(all_of(p)).alias(p) for p in _KINDS],
            *[all_of(f"new_{p}").alias(f"new_{p}") for p in _KINDS])
        again = F.array(*[F.lit(d) for d in redone]).cast("array<string>")
        after = {p: F.sort_array(F.array_union(F.array_except(p, again), f"new_{p}"))
                 for p in _KINDS}
        cells = [rollups.qualifying_cells(p, F.col(p), F.col(f"after_{p}")) for p in _KINDS]
        merged = merged.withColumns(
            {f"after_{p}": F.when(F.col("touched"), c).otherwise(F.col(p))
             for p, c in after.items()})
        merged = merged.select("bucket", "user_login", *_TOTALS,
                               *[F.col(f"after_{p}").alias(p) for p in _KINDS],
                               F.concat(*cells).alias("changes"))
        written = self.write("user_state", merged.where(
            (F.col("active_days") != 0) | (F.size("changes") > 0)), "bucket", buckets=str(buckets))
        self.gone["user_state"] = set(touched) - set(self.staged["user_state"].table.parts)
        moved = written.select(F.explode("changes").alias("c")).select("c.*")
        old = self.old("cells", moved.schema)
        cells = old.unionByName(moved).groupBy("predicate", "day", "next").agg(
            F.sum("n").alias("n"))
        self.write("cells", cells.where("n <> 0"))

    def _stored(self, df: DataFrame) -> DataFrame:
        """Written once, as it is read twice; no version names it, so it goes with old folders."""
        return self.log.staged("scratch", self.log.write(df, "scratch"))

    def change(self, base: Version) -> dict[str, Table]:
        """The tables of the next version; those read must still be as they were."""
        tables = {}
        for name in {*self.staged, *self.gone}:
            was = self.before.version.tables.get(name)
            if base.tables.get(name) != was:
                raise ConcurrentRefresh(f"{name} was changed by version {base.number}")
            made = self.staged[name].table if name in self.staged else None
            if made is None and was is None:
                continue
            if (made or was).key is None:
                tables[name] = made
            else:
                parts = made.parts if made else {}
                tables[name] = (was or made).with_parts(parts, sorted(self.gone.get(name, ())))
        return tables


_KINDS = (rollups.USES_AGENT, rollups.ANY_AGENT)
_TOTALS = ["active_days", *METRICS[1:], *[f"{f}_days" for f in FLAGS]]
_STATE = T.StructType(
    [T.StructField("user_login", T.StringType())]
    + [T.StructField(c, T.LongType()) for c in _TOTALS]
    + [T.StructField(p, T.ArrayType(T.StringType())) for p in _KINDS]
    + [T.StructField("bucket", T.StringType()),
       T.StructField("changes", T.ArrayType(T.StringType()))]
)


def _contributions(rows: DataFrame, sign: int) -> DataFrame:
    """Per user what some user-days add to the totals (or take away), and the days they qualify."""
    kinds = rollups.agent_predicates()
    count = F.lit(sign).cast("bigint")
    days = {p: F.collect_set(F.when(kinds[p], F.col("day"))) for p in _KINDS}
    return rows.groupBy("user_login").agg(
        (F.count(F.lit(1)) * count).alias("active_days"),
        *[(F.coalesce(F.sum(m), F.lit(0)) * count).cast("bigint").alias(m) for m in METRICS[1:]],
        *[(F.count_if(F.col(f)) * count).alias(f"{f}_days") for f in FLAGS],
        *[(d if sign > 0 else F.array().cast("array<string>")).alias(f"new_{p}")
          for p, d in days.items()],
    )


def refresh(
    spark: SparkSession, landing: str, out: str, table: str, checkpoint: str,
    org: str | None = None, buckets: int = BUCKETS,
) -> None:
    """Process every delivery that landed since the last call, then stop.

    Run it on a schedule. The checkpoint remembers which files have been seen. One refresh of a
    table runs at a time.
    """
    if table not in RAW_TABLES:
        raise ValueError(f"unknown raw table: {table}")

    def apply(batch: DataFrame, number: int) -> None:
        touched = [r.day for r in batch.select("day").distinct().collect()]  # days, not rows
        if touched:
            stream = json.loads(text_of(spark, f"{checkpoint}/metadata"))["id"]
            refresh_batch(spark, landing, out, table, touched, stream, number, org, buckets)

    files = spark.readStream.format("binaryFile").schema(landed.FILES).load(f"{landing}/{table}")
    # A batch is computed with all columns of the stream, whatever is selected from it later: with
    # the content among them, each task would hold a whole file several times over.
    stream = (
        files.select("day").writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    stream.awaitTermination()


def refresh_batch(
    spark: SparkSession, landing: str, out: str, table: str, touched: list[str],
    stream: str, number: int, org: str | None = None, buckets: int = BUCKETS,
) -> dict:
    """Bring the views up to date for the touched days, as one run of the ledger.

    The stream and the number of its batch name the run and its commit, so one that is repeated
    after any failure commits once.
    """
    started = dt.datetime.now(dt.timezone.utc).replace(microsecond=0)
    path = f"{out}/ledger"
    run = {"id": f"{table}-{stream}-{number}", "source": f"refresh:{table}", "status": "running",
           "trigger": "stream", "started_at": started, "org": org, "invocation_id": stream}
    ledger.append_event(spark, path, run)
    try:
        head = Log(spark, out).head()
        if head is None or head.sequences.get(stream, -1) < number:
            batch = _Batch(spark, landing, out, table, buckets)
            batch.run(touched)
            version = batch.log.commit(batch.change, run["id"], (stream, number))
            run["snapshot_records"] = {n: w.rows for n, w in batch.staged.items()}
            run["snapshot_places"] = {
                n: {"history": ",".join(sorted({p.path.split("/attempt=")[0] for p in
                                                w.table.parts.values()})) or None,
                    "latest": f"{out}#{version.number}"} for n, w in batch.staged.items()}
        run["status"] = "succeeded"
    except BaseException as e:
        run.update(status="failed", error=str(e))
        raise
    finally:
        run["completed_at"] = dt.datetime.now(dt.timezone.utc).replace(microsecond=0)
        ledger.append_event(spark, path, run)
    return run


def open_views(spark: SparkSession, out: str) -> Snapshot:
    """All refreshed tables as of now; they belong together, whatever is refreshed meanwhile."""
    return Log(spark, out).open() or Snapshot(spark, out, Version())


def read_days(
    spark: SparkSession, out: str, view: str, days: list[str] | None = None
) -> DataFrame:
    """A refreshed view, or some days of it."""
    snapshot = open_views(spark, out)
    schema = VIEW_SCHEMAS.get(view, VIEW_SCHEMAS["daily_summary"])
    if view not in snapshot:
        return spark.createDataFrame([], schema)
    if view == "org_from_users" and days is not None:
        return snapshot.read(view, schema=schema).where(F.col("day").isin(days))
    return snapshot.read(view, days, schema)


def user_summary(spark: SparkSession, out: str) -> DataFrame:
    """Whole-period user totals, from the kept state: one row per user is read, no user-days."""
    snapshot = open_views(spark, out)
    schema = VIEW_SCHEMAS["user_summary"]
    if "user_state" not in snapshot:
        return spark.createDataFrame([], schema)
    flags = [(F.col(f"{f}_days") > 0).alias(f) for f in FLAGS]
    totals = snapshot.read("user_state").where("active_days <> 0")
    return totals.select("user_login", *_TOTALS, *flags).select(*schema.names)


def land(df: DataFrame, landing: str, table: str, delivery: str) -> None:
    """Write report rows as one delivery per day (for feeds that arrive as frames)."""
    (
        df.withColumn("delivery", F.lit(delivery))
        .hint("rebalance", F.col("day"))
        .write.mode("append")
        .option("ignoreNullFields", "false")
        .partitionBy("day", "delivery")
        .json(f"{landing}/{table}")
    )
