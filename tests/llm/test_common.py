"""Helpers that several operators share."""

import glob
import os
import time

from pyspark.sql import functions as F

from tidemark.llm.common import bucketed, stored


def shuffle_files(spark):
    jvm_dir = spark.sparkContext._jvm.java.lang.System.getProperty("java.io.tmpdir")
    folders = {os.environ.get("SPARK_LOCAL_DIRS", jvm_dir), jvm_dir}
    return {f for d in folders for f in glob.glob(f"{d}/**/blockmgr-*/*/shuffle_*.data",
                                                  recursive=True)}


def test_shuffles_go_when_a_frame_is_stored(spark):
    keyed = spark.range(5000).withColumn("key", F.col("id") % 7)
    for made in (stored(keyed.groupBy("key").agg(F.collect_list("id").alias("ids")), "sums"),
                 bucketed(keyed, "key", "buckets")):
        assert made.count() in (7, 5000)
    before = shuffle_files(spark)
    kept = stored(keyed.groupBy("key").agg(F.collect_list("id").alias("ids")), "sums")
    dealt = bucketed(keyed, "key", "buckets")
    end = time.time() + 20  # they are removed in the background
    while shuffle_files(spark) - before and time.time() < end:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert kept.count() == 7 and dealt.count() == 5000
    assert sorted(r["key"] for r in kept.collect()) == list(range(7))
