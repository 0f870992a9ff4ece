import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tidemark.operators import allocate
from tidemark.sources import files


def plain_split(total, shares):
    """Independent rule: floors, then one each to the largest fractions."""
    if total <= 0:
        return [0] * len(shares)
    raw = [total * s for s in shares]
    out = [math.floor(r) for r in raw]
    order = sorted(range(len(raw)), key=lambda i: (-(raw[i] - out[i]), i))
    for i in order[: total - sum(out)]:
        out[i] += 1
    return out


def groups(seed, n_groups, sizes, ties=False):
    rng = random.Random(seed)
    made = {}
    for g in range(n_groups):
        n = rng.choice(sizes)
        weights = [1 if ties else rng.randint(1, 50) for _ in range(n)]
        shares = [w / sum(weights) for w in weights]
        made[g] = (rng.choice([0, -3, 1, 17, 1000, n + 3]), shares)
    return made


@pytest.fixture(params=[1, 1 << 20], ids=["most whole", "all cut"])
def cut(request, monkeypatch):
    """Groups above a share of all rows are cut into cells: few of them, or every one."""
    monkeypatch.setattr(allocate, "SHARE", request.param)
    monkeypatch.setattr(allocate, "_BLOCK", 4)


@pytest.mark.parametrize("ties", [False, True])
def test_apportion_matches_plain_rule(spark, cut, ties):
    made = groups(7, 30, [1, 2, 3, 8, 40], ties)
    data = [(g, i, t, s) for g, (t, shares) in made.items() for i, s in enumerate(shares)]
    df = spark.createDataFrame(data, "g bigint, pos bigint, total bigint, share double")
    got = {
        (r.g, r.pos): r.allotted
        for r in allocate.apportion(df, ["g"], "total", "share", "pos").collect()
    }
    want = {
        (g, i): v for g, (t, s) in made.items() for i, v in enumerate(plain_split(t, s))
    }
    assert got == want


def test_apportion_one_group_holds_most_rows(spark):
    n = 5000
    df = spark.range(n).select(
        F.when(F.col("id") < 4000, 0).otherwise(F.col("id") % 50 + 1).alias("g"),
        F.col("id").alias("pos"),
        F.lit(1234567).alias("total"),
        (F.col("id") % 7 + 1).alias("w"),
    )
    shares = allocate.normalised_weights(df, ["g"], "w", "pos")
    out = allocate.apportion(shares, ["g"], "total", "share", "pos")
    data = out.collect()
    fused = allocate.apportion_by_weight(df, ["g"], "total", "w", "pos")
    assert fused.columns == out.columns == ["g", "pos", "total", "w", "share", "allotted"]
    assert sorted(map(tuple, fused.collect())) == sorted(map(tuple, data))
    assert len(data) == n
    by_group = {}
    for r in sorted(data, key=lambda r: r.pos):
        by_group.setdefault(r.g, []).append(r)
    for group in by_group.values():
        s = sum(r.w for r in group)
        assert [r.share for r in group] == [r.w / s for r in group]
        assert [r.allotted for r in group] == plain_split(1234567, [r.share for r in group])


def test_weights_fall_back_to_equal(spark, rows, cut):
    df = spark.createDataFrame(
        [("a", 0, 0.0), ("a", 1, 0.0), ("b", 0, 1.0), ("b", 1, 3.0)],
        "g string, pos int, w double",
    )
    out = allocate.normalised_weights(df, ["g"], "w", "pos")
    assert rows(out, "g", "pos", "share") == [
        ("a", 0, 0.5), ("a", 1, 0.5), ("b", 0, 0.25), ("b", 1, 0.75),
    ]


def close(a, b):
    return a == b or abs(a - b) <= 2 * math.ulp(max(abs(a), abs(b)))


def test_weights_of_any_scale(spark, cut):
    """Against exact fractions: from the smallest doubles to the largest, mixed and alike."""
    rng = random.Random(11)
    made = {
        "small": [3e-13, 1e-13], "large": [1e27, 3e27], "tiny": [5e-324, 1.5e-323],
        "huge": [1.7e308, 1.7e308, 1.0], "apart": [1e300, 1e-300, 1.0, 2.0],
        "signs": [1e10, 1.0, -1e10, 1.0], "below zero": [-3.0, 1.0], "near zero": [1.0, -1.0],
        "tenths": [0.1] * 10, "denormal": [2.0**-1060, 3 * 2.0**-1062],
        "mixed": [rng.uniform(1, 2) * 10.0 ** rng.randint(-300, 300) for _ in range(60)],
        "alike": [rng.uniform(1, 2) * 10.0 ** rng.randint(-9, 9) for _ in range(300)],
        "low": [rng.uniform(1, 2) * 10.0 ** rng.randint(-305, -290) for _ in range(80)],
    }
    data = [(g, i, 10_007, w) for g, ws in made.items() for i, w in enumerate(ws)]
    df = spark.createDataFrame(data, "g string, pos int, total bigint, w double").repartition(7)
    got = {}
    for r in allocate.apportion_by_weight(df, ["g"], "total", "w", "pos").collect():
        got[r.g, r.pos] = (r.share, r.allotted)
    alone = {(r.g, r.pos): r.share
             for r in allocate.normalised_weights(df, ["g"], "w", "pos").collect()}
    assert alone == {k: share for k, (share, _) in got.items()}
    for g, ws in made.items():
        whole = sum(map(Fraction, ws))
        want = [float(Fraction(w) / whole) if whole > 0 else 1 / len(ws) for w in ws]
        shares = [got[g, i][0] for i in range(len(ws))]
        assert all(map(close, shares, want)), g
        assert [got[g, i][1] for i in range(len(ws))] == plain_split(10_007, shares), g
    assert [got["small", i][1] for i in (0, 1)] == [7505, 2502]


def test_weights_that_are_no_numbers_count_as_zero(spark, rows, cut):
    bad = [float("nan"), float("inf"), -float("inf"), None]
    df = spark.createDataFrame(
        [("a", i, 10, w) for i, w in enumerate([*bad, 1.0, 3.0])]
        + [("b", i, 10, w) for i, w in enumerate(bad)],
        "g string, pos int, total int, w double")
    out = allocate.apportion_by_weight(df, ["g"], "total", "w", "pos")
    assert rows(out, "g", "pos", "share", "allotted") == [
        *[("a", i, 0.0, 0) for i in range(4)], ("a", 4, 0.25, 3), ("a", 5, 0.75, 7),
        *[("b", i, 0.25, 3 if i < 2 else 2) for i in range(4)]]


def test_order_of_rows_does_not_matter(spark):
    rng = random.Random(3)
    data = [(1, i, rng.uniform(0, 1) * 10.0 ** rng.randint(-12, 3)) for i in range(3000)]
    seen = set()
    for seed, parts in ((1, 1), (2, 5), (3, 8)):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "g int, pos int, w double").repartition(parts)
        out = allocate.normalised_weights(df, ["g"], "w", "pos").collect()
        seen.add(tuple(r.share for r in sorted(out, key=lambda r: r.pos)))
    assert len(seen) == 1


def test_no_job_runs_while_the_plan_is_made(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("pos"),
                                  F.rand(1).alias("w"), F.lit(50).alias("total"))
    spark.sparkContext.setJobGroup("plan", "plan")
    try:
        out = allocate.apportion_by_weight(df, ["g"], "total", "w", "pos")
        out = allocate.apportion(out, ["g"], "total", "share", "pos", out="again")
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("plan")
        assert out.count() == 1000
        assert spark.sparkContext.statusTracker().getJobIdsForGroup("plan")
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_a_large_group_is_dealt_out(spark):
    """Half of the rows in one group: no task of the last stage gets more than a few percent."""
    df = spark.range(40_000).select(
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("g"),
        F.col("id").alias("pos"), F.lit(1_000_003).alias("total"),
        (F.col("id") % 1000 / 7).alias("w"))
    out = allocate.apportion_by_weight(df, ["g"], "total", "w", "pos")
    with_cells = spark.conf.get("spark.sql.adaptive.enabled"), spark.conf.get(
        "spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        by_task = out.withColumn("task", F.spark_partition_id()).groupBy("task").agg(
            F.count("*").alias("n"), F.sum("allotted"))
        sizes = [r.n for r in by_task.collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", with_cells[0])
        spark.conf.set("spark.sql.shuffle.partitions", with_cells[1])
    assert sum(sizes) == 40_000 and max(sizes) < 2000


def test_boost_changes_share(spark, rows):
    df = spark.createDataFrame([("a", 0, 1.0), ("a", 1, 1.0)], "g string, pos int, w double")
    boost = F.when(F.col("pos") == 0, F.lit(3.0))
    out = allocate.normalised_weights(df, ["g"], "w", "pos", boost)
    assert rows(out, "pos", "share") == [(0, 0.75), (1, 0.25)]


def test_feature_of(spark, rows):
    df = spark.createDataFrame(
        [("hcl", "agent-rollout"), ("hcl", "baseline"), ("yaml", "delivery-sprint"), ("go", "x")],
        "language string, phase string",
    )
    out = df.withColumn("f", allocate.feature_of(F.col("language"), F.col("phase")))
    assert rows(out) == [
        ("go", "x", "code_completion"),
        ("hcl", "agent-rollout", "chat_panel_agent_mode"),
        ("hcl", "baseline", "code_completion"),
        ("yaml", "delivery-sprint", "chat_panel_ask_mode"),
    ]


def test_calendar_phases(spark):
    spine = spark.createDataFrame([(f"2024-01-{d:02d}",) for d in range(1, 27)], "day string")
    got = {r.day: r for r in allocate.calendar_phases(spine).collect()}
    assert got["2024-01-01"].weekday == 0 and not got["2024-01-01"].is_weekend
    assert got["2024-01-06"].is_weekend
    assert got["2024-01-01"].progress == 0.0 and got["2024-01-26"].progress == 1.0
    assert got["2024-01-05"].phase == "onboarding-drive"  # progress 0.16
    assert got["2024-01-26"].phase == "delivery-sprint"
    assert got["2024-01-10"].phase == "baseline"


def test_calendar_of_one_day(spark):
    spine = spark.createDataFrame([("2024-01-01",)], "day string")
    assert allocate.calendar_phases(spine).first().progress == 0.0


def exact(df):
    return sorted((r.g is None, r.g or 0, r.pos, r.share, r.allotted) for r in df.collect())


@pytest.mark.parametrize("spread", ["even", "ties", "close"])
def test_cut_and_whole_groups_give_the_same_to_the_last_bit(spark, monkeypatch, spread):
    """A null hot key, and groups of many cells, against groups in one piece."""
    weight = {"even": F.rand(3) * 50, "ties": F.lit(0.1),
              "close": 1 + F.col("id") * F.lit(1e-7)}[spread]
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 3).alias("g"),
        F.col("id").alias("pos"), F.lit(777_771).alias("total"), weight.alias("w"))
    df = spark.createDataFrame(df.collect(), df.schema)
    cut = exact(allocate.apportion_by_weight(df, ["g"], "total", "w", "pos"))
    monkeypatch.setattr(allocate, "SHARE", 1)  # no group has more than all rows
    assert exact(allocate.apportion_by_weight(df, ["g"], "total", "w", "pos")) == cut
    totals = {}
    for _, g, _, _, n in cut:
        totals[g] = totals.get(g, 0) + n
    assert set(totals.values()) == {777_771}


def rows_by_task(df):
    counted = df.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n"))
    return [r.n for r in counted.collect()]


@pytest.mark.parametrize("name", ["normalised_weights", "apportion", "apportion_by_weight"])
def test_larger_files_are_dealt_to_more_tasks(spark, monkeypatch, tmp_path, name):
    """Rows of a task do not grow with the files; the shares stay the same."""
    spark.range(20_000, numPartitions=3).select(
        (F.col("id") % 6000).alias("g"), F.col("id").alias("pos"), F.lit(1001).alias("total"),
        (F.col("id") % 97 + 1).cast("double").alias("w"), (1 / (1 + F.col("id") % 3)).alias("share"),
    ).write.parquet(f"{tmp_path}/of rows")
    df = spark.read.parquet(f"{tmp_path}/of rows")
    size = files.bytes_read(df)
    assert size == sum(p.stat().st_size for p in (tmp_path / "of rows").glob("*.parquet"))
    assert allocate.parts_of(df) is None
    weight = {"apportion": ["total", "share"], "apportion_by_weight": ["total", "w"],
              "normalised_weights": ["w"]}[name]
    items = df if name == "apportion" else df.drop("share")
    few = getattr(allocate, name)(items, ["g"], *weight, "pos")
    want = sorted(few.collect())
    monkeypatch.setattr(allocate, "PART", -(-size // 100))
    many = getattr(allocate, name)(items, ["g"], *weight, "pos")
    sizes = rows_by_task(many)
    assert sum(sizes) == 20_000 and max(sizes) < 600
    assert sorted(many.collect()) == want
