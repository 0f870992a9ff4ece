"""Incremental refresh against full rebuilds, killed and repeated batches, and what is read."""

import random

import pytest
from test_refresh import Landing

from tidemark.fields import AGENT_EDIT, AGENT_MODE, FLAG_ACTIVE, FLAG_AGENT, PROMPTS, VIEW_SCHEMAS
from tidemark.operators import rollups, views
from tidemark.sources import ledger, manifest
from tidemark.sources.manifest import Log
from tidemark.streaming import refresh


class Runs(Landing):
    """Batches without a stream, numbered like its own."""

    number = -1

    def batch(self, touched, number=None):
        if number is None:
            number = self.number = self.number + 1
        return refresh.refresh_batch(self.spark, self.landing, self.out, self.table, touched,
                                     "stream", number, buckets=3)


def rows_of(df, schema):
    return sorted(map(tuple, df.select(*schema.names).collect()), key=repr)


def result(area):
    """Everything that readers see of the user reports."""
    return {
        "days": rows_of(area.view(), VIEW_SCHEMAS["user_daily_summary"]),
        "org": rows_of(area.view("org_from_users"), VIEW_SCHEMAS["daily_summary"]),
        "users": rows_of(refresh.user_summary(area.spark, area.out), VIEW_SCHEMAS["user_summary"]),
    }


def rebuilt(spark, area, listed):
    """The same from all user-days that are there."""
    days = area.view()
    spine = spark.createDataFrame([(d,) for d in sorted(listed)], "day string")
    return {
        "days": rows_of(days, VIEW_SCHEMAS["user_daily_summary"]),
        "org": rows_of(rollups.org_daily(days, spine), VIEW_SCHEMAS["daily_summary"]),
        "users": rows_of(views.user_summary(days), VIEW_SCHEMAS["user_summary"]),
    }


def some_rows(day, rng):
    made = []
    for u in range(8):
        for _ in range(rng.choice([0, 0, 1, 1, 1, 2])):
            made.append({
                "day": day, "user_login": None if u == 7 else f"u{u}", PROMPTS: rng.randint(0, 9),
                FLAG_AGENT: rng.choice([True, False, False, None]),
                FLAG_ACTIVE: rng.random() < 0.3, AGENT_MODE: rng.choice([0, 0, 3]),
                AGENT_EDIT: rng.choice([None, 0, 2])})
    return made


def test_random_restatements_equal_a_rebuild(spark, tmp_path):
    """Late days in between, restated and withdrawn ones, days of equal and of fewer users."""
    rng = random.Random(5)
    area = Runs(spark, tmp_path)
    every = [f"2025-{m:02d}-{d:02d}" for m in (1, 2, 3) for d in range(1, 26)]
    listed, delivery = set(), 0
    first = every[10:45:2]
    steps = [first, [every[60]], [every[11], every[12]], [every[20]], first[3:6], [every[0]],
             [every[60], every[30]], [every[12], every[74], every[40]]]
    for k, days in enumerate(steps):
        delivery += 1
        for day in days:
            rows = [] if k and rng.random() < 0.3 else some_rows(day, rng)
            area.put(day, f"{delivery:02d}", rows or [""])
            (listed.add if rows else listed.discard)(day)
        area.batch(days)
        assert result(area) == rebuilt(spark, area, listed), k
    assert {r[0] for r in result(area)["org"]} == listed and len(listed) > 15


def test_only_touched_buckets_are_written(spark, tmp_path):
    area = Runs(spark, tmp_path)
    day, other = "2025-01-01", "2025-01-02"
    area.put(day, "01", [{"day": day, "user_login": f"u{i}", PROMPTS: 1} for i in range(40)])
    area.put(other, "01", [{"day": other, "user_login": "u1", PROMPTS: 1}])
    area.batch([day, other])
    before = refresh.open_views(spark, area.out).version.tables
    area.put(other, "02", [{"day": other, "user_login": "u1", PROMPTS: 5}])
    area.batch([other])
    after = refresh.open_views(spark, area.out).version.tables
    state = [before["user_state"].parts, after["user_state"].parts]
    assert sum(state[0][b] != state[1][b] for b in state[0]) == 1
    assert set(state[0]) == set(state[1]) and len(state[0]) == 3
    days = [before["user_daily_summary"].parts, after["user_daily_summary"].parts]
    assert days[0][day] == days[1][day] and days[0][other] != days[1][other]
    assert [r.prompts for r in refresh.user_summary(spark, area.out).where(
        "user_login = 'u1'").selectExpr(f"{PROMPTS} as prompts").collect()] == [6]


class Killed(BaseException):
    pass


def landed_twice(spark, tmp_path):
    rng = random.Random(9)
    area = Runs(spark, tmp_path)
    for d in range(1, 5):
        area.put(f"2025-01-{d:02d}", "01", some_rows(f"2025-01-{d:02d}", rng))
    area.batch([f"2025-01-{d:02d}" for d in range(1, 5)])
    area.put("2025-01-02", "02", some_rows("2025-01-02", rng))
    area.put("2025-01-04", "02", [""])
    area.put("2025-01-06", "01", some_rows("2025-01-06", rng))
    return area, ["2025-01-02", "2025-01-04", "2025-01-06"]


def test_a_batch_killed_between_any_two_writes(spark, tmp_path, monkeypatch):
    area, touched = landed_twice(spark, tmp_path)
    old = result(area)
    write, put_new, append = Log.write, manifest.put_new, ledger.append_event
    longest = []
    for stop_at in range(100):
        steps = []

        def step(of, stop_at=stop_at, steps=steps):
            def stopping(*args, **options):
                steps.append(of)
                if len(steps) > stop_at:  # dead from here on: no failed state is written either
                    raise Killed
                return of(*args, **options)
            return stopping

        with monkeypatch.context() as m:
            m.setattr(Log, "write", step(write))
            m.setattr(manifest, "put_new", step(put_new))
            m.setattr(ledger, "append_event", step(append))
            try:
                area.batch(touched, number=1)
            except Killed:
                longest = max(longest, steps, key=len)
                committed = put_new in steps[:-1]
                if not committed:
                    assert len(Log(spark, area.out).numbers()) == 1
                    if stop_at in (1, 4):
                        assert result(area) == old
                continue
        break
    assert longest.count(write) >= 6 and longest.count(put_new) == 1
    assert longest[-1] is append and steps == [append, append]
    new = result(area)
    listed = [f"2025-01-{d:02d}" for d in (1, 2, 3, 6)]
    assert new == rebuilt(spark, area, listed) != old
    assert Log(spark, area.out).numbers() == [1, 2]
    area.batch(touched, number=1)  # and once more, after all went well
    assert result(area) == new and Log(spark, area.out).numbers() == [1, 2]
    runs = ledger.current_runs(ledger.read_ledger(spark, f"{area.out}/ledger"))
    assert {(r.id, r.status) for r in runs.collect()} == {
        ("user_metrics-stream-0", "succeeded"), ("user_metrics-stream-1", "succeeded")}


def test_readers_see_one_version_of_all_views(spark, tmp_path):
    area, touched = landed_twice(spark, tmp_path)
    held = refresh.open_views(spark, area.out)
    before = {n: sorted(map(repr, held.read(n).collect())) for n in held.version.tables}
    area.batch(touched)
    assert {n: sorted(map(repr, held.read(n).collect())) for n in before} == before
    now = refresh.open_views(spark, area.out)
    assert now.version.number == held.version.number + 1
    assert now.keys("user_daily_summary") == [f"2025-01-{d:02d}" for d in (1, 2, 3, 6)]


def test_a_second_writer_is_noticed(spark, tmp_path, monkeypatch):
    area, touched = landed_twice(spark, tmp_path)
    commit = Log.commit

    def after_another(self, change, *args, **options):
        commit(self, lambda base: {"user_state": base.tables["cells"]})
        return commit(self, change, *args, **options)

    monkeypatch.setattr(Log, "commit", after_another)
    with pytest.raises(refresh.ConcurrentRefresh):
        area.batch(touched)
    runs = ledger.current_runs(ledger.read_ledger(spark, f"{area.out}/ledger"))
    assert {r.status for r in runs.collect()} == {"succeeded", "failed"}


def test_ledger_of_a_stream(spark, tmp_path, rows):
    area = Landing(spark, tmp_path)
    area.put("2025-01-01", "01", [{"day": "2025-01-01", "user_login": "a", PROMPTS: 1}])
    area.refresh()
    area.put("2025-01-02", "01", [{"day": "2025-01-02", "user_login": "a", PROMPTS: 1}])
    area.refresh()
    area.refresh()
    events = ledger.read_ledger(spark, f"{area.out}/ledger")
    runs = ledger.current_runs(events).collect()
    assert len(runs) == 2 and {r.status for r in runs} == {"succeeded"}
    assert sorted(r.snapshot_records["user_daily_summary"] for r in runs) == [1, 1]
    assert {r.snapshot_records["org_from_users"] for r in runs} == {1, 2}
    latest = ledger.latest_per_source(events).first()
    assert latest.latest_id == "latest:refresh:user_metrics" and latest.status == "succeeded"
