import pytest
from pyspark.sql import functions as F

from tidemark.operators import windows


def daily(spark, n, org=None):
    df = spark.range(n).select(
        F.date_add(F.lit("2025-01-01").cast("date"), F.col("id").cast("int")).cast("string").alias("day")
    )
    return df if org is None else df.withColumn("org", F.lit(org))


@pytest.mark.parametrize("total,offered,default", [
    (0, [28, 60, 100], 60), (1, [1], 1), (27, [27], 27), (28, [28], 28), (59, [28], 28),
    (60, [28, 60], 60), (100, [28, 60, 100], 60), (500, [28, 60, 100], 60),
])
def test_window_rule(total, offered, default):
    assert windows.window_options(total) == offered
    assert windows.resolve_window(total) == default


@pytest.mark.parametrize("total", [1, 5, 27, 28, 59, 60, 99, 100, 130])
@pytest.mark.parametrize("selected", [None, 5, 28, 60, 100])
def test_visible_days_follow_the_rule(spark, total, selected):
    got = sorted(r.day for r in windows.visible_days(daily(spark, total), selected).collect())
    want = sorted(r.day for r in daily(spark, total).collect())[-windows.resolve_window(total, selected):]
    assert got == want


def test_empty_table(spark):
    assert windows.visible_days(daily(spark, 0)).count() == 0


def test_last_days_by_position(spark, rows):
    df = spark.createDataFrame([("2025-01-01",), ("2025-03-01",), ("2025-02-01",)], "day string")
    assert rows(windows.last_days(df, 2)) == [("2025-02-01",), ("2025-03-01",)]


def test_windows_per_organization(spark):
    both = daily(spark, 30, "x").unionByName(daily(spark, 70, "y"))
    out = windows.visible_days(both, by=["org"]).groupBy("org").count().collect()
    assert {r.org: r["count"] for r in out} == {"x": 28, "y": 60}
    detail = both.withColumn("v", F.lit(1))
    kept = windows.restrict_to_days(detail, windows.last_days(both, 3, ["org"]), ["org"])
    assert kept.count() == 6


def test_restrict_is_a_broadcast_semi_join(spark):
    detail = daily(spark, 50).withColumn("v", F.lit(1))
    out = windows.restrict_to_days(detail, windows.last_days(daily(spark, 50), 14))
    assert out.count() == 14 and out.columns == ["day", "v"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
