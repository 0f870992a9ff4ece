"""Sketches against exact counts."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import rollups, sketches
from tidemark.sources.manifest import Log

DAYS = [f"2025-01-{d:02d}" for d in range(1, 13)]
WINDOWS = {"any_1": ("any", 1), "any_7": ("any", 7), "some_5": ("some", 5)}


@pytest.fixture(scope="module")
def users(spark):
    """40,000 user-days of 20,000 users, a day without any, and null users."""
    rows = spark.range(40_000).select(
        F.element_at(F.array(*map(F.lit, DAYS)), (F.pmod(F.xxhash64("id"), F.lit(12)) + 1)
                     .cast("int")).alias("day"),
        F.concat(F.lit("u"), (F.col("id") % 20_000).cast("string")).alias("user_login"),
        (F.col("id") % 3 == 0).alias("flag"), (F.col("id") % 2).alias("org"))
    blank = spark.createDataFrame([(DAYS[0], None, True, 0)], rows.schema)
    return rows.where(F.col("day") != DAYS[4]).unionByName(blank)


def predicates():
    return {"any": F.lit(True), "some": F.col("flag")}


def spine(spark):
    return spark.createDataFrame([(d,) for d in DAYS], "day string")


def exact(users, spine, by=()):
    kept = users.where("user_login is not null")
    return rollups.day_measures(kept, spine, predicates=predicates(), windows=WINDOWS, by=by)


def test_trailing_windows_within_the_stated_error(spark, users):
    daily = sketches.user_sketches(users, predicates(), ["day"])
    got = {r.day: r for r in sketches.trailing(daily, spine(spark), WINDOWS).collect()}
    want = {r.day: r for r in exact(users, spine(spark)).collect()}
    assert sorted(got) == sorted(want) == DAYS and got[DAYS[4]].any_1 == 0
    off = [abs(got[d][m] - want[d][m]) / max(1, want[d][m]) for d in DAYS for m in WINDOWS]
    assert max(want[d]["any_7"] for d in DAYS) > 10_000
    assert max(off) < 4 * sketches.relative_error()
    assert sum(off) / len(off) < sketches.relative_error()


def test_keys_merge_to_the_whole(spark, users):
    by_key = sketches.user_sketches(users, predicates(), ["org", "day"])
    whole = sketches.estimates(sketches.merged(by_key, ["predicate"]))
    direct = sketches.estimates(sketches.user_sketches(users, predicates()))
    whole, direct = ({r.predicate: r.users for r in df.collect()} for df in (whole, direct))
    true = {"any": 20_000, "some": 20_000 * 2 / 3}  # of two days of a user one may be flagged
    assert set(whole) == set(direct) == set(true)
    assert all(abs(whole[p] - direct[p]) < 4 * sketches.relative_error() * true[p] for p in whole)
    spread = spine(spark).crossJoin(spark.createDataFrame([(0,), (1,)], "org long"))
    got = sketches.trailing(by_key, spread, WINDOWS, ["org"])
    want = {(r.org, r.day): r for r in exact(users, spread, ["org"]).collect()}
    for r in got.collect():
        for m in WINDOWS:
            assert abs(r[m] - want[r.org, r.day][m]) <= 4 * sketches.relative_error() * max(
                25, want[r.org, r.day][m])


def test_small_sets_are_exact(spark):
    rng = random.Random(1)
    rows = [(rng.choice(DAYS), f"u{rng.randrange(30)}", rng.random() < 0.4) for _ in range(120)]
    few = spark.createDataFrame(rows, "day string, user_login string, flag boolean")
    daily = sketches.user_sketches(few, predicates(), ["day"])
    got = sketches.trailing(daily, spine(spark), WINDOWS).collect()
    want = exact(few, spine(spark)).select(*got[0].__fields__).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_a_restated_day_replaces_its_own_sketch(spark, users, tmp_path):
    log = Log(spark, str(tmp_path))
    sketches.store(log, "daily", sketches.user_sketches(users, predicates(), ["day"]))
    before = dict(log.head().tables["daily"].parts)
    restated = users.where((F.col("day") == DAYS[2]) & (F.hash("user_login") % 2 == 0))
    sketches.store(log, "daily", sketches.user_sketches(restated, predicates(), ["day"]),
                   gone=[DAYS[7]])
    after = log.head().tables["daily"].parts
    assert {d for d in before if before[d] != after.get(d)} == {DAYS[2], DAYS[7]}
    kept = users.where(~F.col("day").isin(DAYS[2], DAYS[7])).unionByName(restated)
    got = {r.day: r for r in sketches.trailing(
        log.open().read("daily"), spine(spark), WINDOWS).collect()}
    want = {r.day: r for r in exact(kept, spine(spark)).collect()}
    assert sorted(got) == sorted(want) and got[DAYS[7]].any_1 == 0
    assert want[DAYS[2]].any_1 < 2000 < exact(users, spine(spark)).where(
        F.col("day") == DAYS[2]).first().any_1
    for d in DAYS:
        for m in WINDOWS:
            assert abs(got[d][m] - want[d][m]) <= 4 * sketches.relative_error() * want[d][m]


def test_nothing(spark, users):
    none = sketches.user_sketches(users.where("false"), predicates(), ["day"])
    got = sketches.trailing(none, spine(spark), WINDOWS).collect()
    assert len(got) == 12 and {r[m] for r in got for m in WINDOWS} == {0}
