"""The apportionment queries over larger files: as many rows in a task, and the same results."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import allocate
from tidemark.plans.queries import QUERIES


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    spark.range(24_000, numPartitions=4).select(
        (F.col("id") % 6000).alias("l_orderkey"), (F.col("id") % 7919).alias("l_partkey"),
        (F.col("id") % 50 + 1).cast("double").alias("l_quantity"),
        F.when(F.col("id") % 4 == 0, "R").otherwise("N").alias("l_returnflag"),
    ).write.parquet(f"{folder}/lineitem.parquet")
    spark.range(5900).select(
        F.col("id").alias("o_orderkey"), (F.col("id") * 1.5 + 900).alias("o_totalprice"),
    ).write.parquet(f"{folder}/orders.parquet")
    return folder


@pytest.mark.parametrize("name", ["apportion", "apportion_any_scale", "normalised_weights"])
def test_tasks_hold_as_many_rows_of_larger_files(spark, monkeypatch, tables, name):
    want = sorted(QUERIES[name](spark, tables).collect())
    assert len(want) == 4 * 5900
    size = allocate.bytes_read(spark.read.parquet(f"{tables}/lineitem.parquet"))
    monkeypatch.setattr(allocate, "PART", -(-size // 100))
    many = QUERIES[name](spark, tables)
    counted = many.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n"))
    assert max(r.n for r in counted.collect()) < 700
    # nor does a task get all orders, though they are few bytes
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [l_orderkey" in plan
    assert "BroadcastHashJoin [l_orderkey" not in plan
    assert sorted(many.collect()) == want


def test_well_packed_files_make_no_large_tasks(spark, tmp_path):
    path = str(tmp_path / "items")
    spark.range(3_000_000, numPartitions=4).select(F.rand(1).alias("x")).write.parquet(path)
    parts = allocate.parts_of(spark.read.parquet(path))
    assert parts is not None and 3_000_000 / parts < 400_000
