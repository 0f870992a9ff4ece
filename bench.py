"""Times the library's own queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))

    from pyspark.sql import SparkSession

    from tidemark.plans.queries import QUERIES

    only = sys.argv[1:] or list(QUERIES)

    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in only:
        measured = []
        for _ in range(runs + 1):  # the first run warms up and is not counted
            start = time.perf_counter()
            # the noop sink computes every column of every row
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            measured.append(time.perf_counter() - start)
        times[name] = round(statistics.median(measured[1:]), 3)
    spark.stop()
    print(json.dumps({
        "metric": "sum of median query times",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
