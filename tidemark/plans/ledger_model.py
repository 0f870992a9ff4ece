"""Ingestion-run events derived from the orders table.

Each order stands for one run: it starts at a time within its order date, and the
order status tells whether it is still running, succeeded or failed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import run_id


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")

    def later(ts, seconds):
        return ts + F.make_dt_interval(secs=seconds)

    started = later(F.col("o_orderdate"), key % 86400)
    failed = F.col("o_orderstatus") == "P"
    base = orders.select(
        started.alias("started_at"),
        F.lpad(key.cast("string"), 8, "0").alias("invocation_id"),
        F.col("o_orderpriority").alias("source"),
        F.lit("timer").alias("trigger"),
        F.when(cust % 10 != 0, F.concat(F.lit("org"), (cust % 10).cast("string"))).alias("org"),
        later(started, cust % 600).alias("ended_at"),
        F.col("o_orderstatus"),
        F.when(failed, F.concat(F.lit("failed at "), cust.cast("string"))).alias("message"),
    ).withColumn("id", run_id("started_at", "invocation_id"))
    final = F.when(F.col("o_orderstatus") == "P", "failed").otherwise("succeeded")
    running = F.struct(
        F.lit("running").alias("status"),
        F.lit(None).cast("timestamp_ntz").alias("completed_at"),
        F.lit(None).cast("string").alias("error"),
    )
    done = F.struct(
        final.alias("status"), F.col("ended_at").alias("completed_at"),
        F.col("message").alias("error"),
    )
    states = F.when(F.col("o_orderstatus") == "O", F.array(running)).otherwise(
        F.array(running, done)
    )
    return base.select(
        "id", "source", "trigger", "started_at", "org", "invocation_id",
        F.explode(states).alias("s"),
    ).select("id", "source", "trigger", "started_at", "org", "invocation_id", "s.*")
