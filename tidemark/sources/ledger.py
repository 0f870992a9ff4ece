"""Run ledger: append-only events, current state per run, latest run per source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_COUNTS = T.MapType(T.StringType(), T.LongType())
_PLACES = T.MapType(
    T.StringType(),
    T.StructType(
        [T.StructField("history", T.StringType()), T.StructField("latest", T.StringType())]
    ),
)

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("trigger", T.StringType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("completed_at", T.TimestampType()),
        T.StructField("report_window_days", T.IntegerType()),
        T.StructField("org", T.StringType()),
        T.StructField("invocation_id", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("raw_records", _COUNTS),
        T.StructField("snapshot_records", _COUNTS),
        T.StructField("raw_places", _PLACES),
        T.StructField("snapshot_places", _PLACES),
    ]
)


def _state_order():
    """Later states win when two events of a run carry the same time."""
    return F.when(F.col("status") == "running", 0).otherwise(1)


def append_event(spark: SparkSession, path: str, event: dict) -> None:
    """Add one state of one run."""
    row = tuple(event.get(f.name) for f in LEDGER_SCHEMA.fields)
    spark.createDataFrame([row], LEDGER_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def updated_at():
    return F.coalesce(F.col("completed_at"), F.col("started_at"))


def _newest(events: DataFrame, keys: Sequence[str], order) -> DataFrame:
    """The last event per key: combined map-side, by a sort, as a row of events is not hashable."""
    row = F.max_by(F.struct(*events.columns), order)
    return events.groupBy(*keys).agg(row.alias("_r")).select("_r.*")


def current_runs(events: DataFrame) -> DataFrame:
    """One row per run id: its last written state."""
    return _newest(events, ["id"], F.struct(updated_at(), _state_order()))


def latest_per_source(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per source: the state written last, with its update time.

    The time and state of the last event are one number, so they are found by hash aggregation;
    the events of that number, a few per source, are then told apart by their ids.
    """
    keys = [*by, "source"]
    place = F.unix_micros(updated_at().cast("timestamp")) * 2 + _state_order()
    timed = events.withColumn("_place", place)
    last = timed.groupBy(*keys).agg(F.max("_place").alias("_last"))
    same = [timed[k].eqNullSafe(last[k]) for k in keys]
    few = timed.join(last, [*same, timed["_place"].eqNullSafe(last["_last"])], "left_semi")
    newest = _newest(few.drop("_place"), keys, F.col("id"))
    return newest.select(
        F.concat(F.lit("latest:"), F.col("source")).alias("latest_id"),
        F.col("id").alias("run_id"),
        *[c for c in events.columns if c != "id"],
        updated_at().alias("updated_at"),
    )


def run_metrics(runs: DataFrame) -> DataFrame:
    """Run summaries keyed by organization, for finished and running runs alike."""
    kept = [
        c for c in ("raw_records", "snapshot_records", "raw_places", "snapshot_places")
        if c in runs.columns
    ]
    return runs.select(
        F.concat(F.lit("run:"), F.col("id")).alias("id"),
        F.lit("usage-metrics-run").alias("document_type"),
        F.coalesce(F.col("org"), F.lit("mock")).alias("organization"),
        "source",
        F.col("id").alias("run_id"),
        "trigger", "started_at", "completed_at", "status",
        *kept,
    )


def write_run_metrics(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("append").partitionBy("organization").parquet(path)
