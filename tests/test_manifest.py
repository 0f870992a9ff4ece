"""Versions of tables: whole or not at all, pinned readers, concurrent and repeated writers, age."""

import datetime as dt
import os
import threading

import pytest
from pyspark.sql import functions as F

from tidemark.operators import views
from tidemark.sources import manifest, snapshots
from tidemark.sources.files import delete, put_new
from tidemark.sources.manifest import Log

LATER = dt.datetime(2100, 1, 1, tzinfo=dt.timezone.utc)


def frame(spark, *values):
    return spark.createDataFrame([(v, f"k{v % 3}") for v in values], "v long, k string")


def values(snapshot, name="t", **options):
    return sorted(r.v for r in snapshot.read(name, **options).collect())


def committed(log, df, name="t", **options):
    written = log.write(df, name, **options)
    log.commit(lambda _: {name: written.table})
    return written


def files_below(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names}


def test_put_new_is_whole_and_only_once(spark, tmp_path):
    path = f"{tmp_path}/new/one"
    won = []

    def put(i):
        if put_new(spark, path, str(i) * 10_000):
            won.append(i)

    threads = [threading.Thread(target=put, args=(i,)) for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1 and open(path).read() == str(won[0]) * 10_000
    assert os.listdir(f"{tmp_path}/new") == ["one"]
    delete(spark, path)
    delete(spark, path)
    assert os.listdir(f"{tmp_path}/new") == []


def test_readers_stay_with_their_version(spark, tmp_path):
    log = Log(spark, str(tmp_path))
    assert log.open() is None and log.numbers() == []
    assert committed(log, frame(spark, 1, 2)).rows == 2
    first = log.open()
    before = files_below(tmp_path)
    written = log.write(frame(spark, 3), "t")  # a writer that dies here changes nothing
    assert before < files_below(tmp_path) and values(log.open()) == [1, 2]
    log.commit(lambda _: {"t": written.table})
    assert before < files_below(tmp_path)
    assert values(first) == [1, 2] and values(log.open()) == [3]
    assert values(log.open(1)) == [1, 2] and log.numbers() == [1, 2]


def test_parts_are_replaced_added_and_dropped(spark, tmp_path):
    log = Log(spark, str(tmp_path))
    committed(log, frame(spark, 1, 2, 3, 4), key="k")
    assert log.open().keys("t") == ["k0", "k1", "k2"]
    written = log.write(frame(spark, 10, 13), "t", key="k")
    log.commit(lambda v: {"t": v.tables["t"].with_parts(written.table.parts, gone=["k2"])})
    now = log.open()
    assert values(now) == [3, 10, 13] and values(now, keys=["k1", "absent"]) == [10, 13]
    assert sorted(now.read("t").columns) == ["k", "v"]
    assert {r.k for r in now.read("t", ["k0"]).collect()} == {"k0"}
    log.commit(lambda _: {"t": None})
    assert "t" not in log.open() and log.open().keys("t") == []
    assert values(now) == [3, 10, 13]


def test_awkward_keys_and_empty_frames(spark, tmp_path):
    log = Log(spark, str(tmp_path))
    df = spark.createDataFrame([(1, "a/b"), (2, None), (3, "ü =:%"), (4, "plain")],
                               "v long, k string")
    committed(log, df, key="k")
    assert sorted(map(str, log.open().read("t").select("v", "k").collect())) == sorted(
        map(str, df.collect()))
    assert values(log.open(), keys=["a/b"]) == [1]
    assert committed(log, df.where("false"), key="k").rows == 0
    assert values(log.open()) == [] and log.open().read("t").columns == ["v", "k"]
    assert committed(log, spark.createDataFrame([], "v long"), "e").rows == 0
    assert log.open().read("e").count() == 0


def test_concurrent_writers_lose_nothing(spark, tmp_path):
    log = Log(spark, str(tmp_path))
    made = {f"t{i}": log.write(frame(spark, i), f"t{i}").table for i in range(6)}
    failed = []

    def work(name):
        try:
            Log(spark, str(tmp_path)).commit(lambda _: {name: made[name]})
        except Exception as e:
            failed.append(e)

    threads = [threading.Thread(target=work, args=(n,)) for n in made]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed and log.numbers() == [1, 2, 3, 4, 5, 6]
    assert {n: values(log.open(), n) for n in made} == {f"t{i}": [i] for i in range(6)}


def test_a_repeated_commit_is_ignored(spark, tmp_path):
    log = Log(spark, str(tmp_path))
    for sequence, value in [(0, 1), (1, 2), (1, 3), (0, 4)]:
        written = log.write(frame(spark, value), "t")
        log.commit(lambda _: {"t": written.table}, sequence=("w", sequence))
    assert values(log.open()) == [2] and log.numbers() == [1, 2]
    written = log.write(frame(spark, 5), "t")
    log.commit(lambda _: {"t": written.table}, sequence=("other", 0))
    assert values(log.open()) == [5]
    assert log.head().sequences == {"w": 1, "other": 0}


def test_old_versions_go_by_age(spark, tmp_path):
    log = Log(spark, str(tmp_path))
    committed(log, frame(spark, 1, 2, 3), key="k")
    part = log.write(frame(spark, 4), "t", key="k").table
    log.commit(lambda v: {"t": v.tables["t"].with_parts(part.parts)})
    log.write(frame(spark, 9), "t")  # never committed
    held = log.open(1)
    middle = dt.datetime.now(dt.timezone.utc)
    assert log.vacuum(middle - dt.timedelta(hours=1)) == []
    assert values(held) == [1, 2, 3] and log.numbers() == [1, 2]
    gone = log.vacuum(LATER)
    assert len(gone) == 2 and log.numbers() == [2]  # the part replaced, and the dead writer's
    assert values(log.open()) == [2, 3, 4]
    assert log.vacuum(LATER) == []


# --- published views


def view_of(spark, login):
    raw = spark.createDataFrame([("2025-01-01", login)], "day string, user_login string")
    return {"user_daily_summary": views.user_daily_summary(raw),
            "user_summary": views.user_summary(raw)}


def logins(snapshot):
    return {n: [r.user_login for r in snapshot.read(n).collect()]
            for n in ("user_daily_summary", "user_summary")}


@pytest.mark.parametrize("stop_at", ["second write", "manifest"])
def test_a_publish_stopped_half_way(spark, tmp_path, monkeypatch, stop_at):
    root = str(tmp_path)
    snapshots.publish(view_of(spark, "a"), root, "o", "s", "r1")
    pinned = snapshots.latest(spark, [root], "o", "s")

    class Killed(Exception):
        pass

    write, seen = Log.write, []

    def stopping(self, df, name, **options):
        seen.append(name)
        if stop_at == "second write" and len(seen) == 2:
            raise Killed
        return write(self, df, name, **options)

    def no_file(*_):
        raise Killed

    with monkeypatch.context() as m:
        m.setattr(Log, "write", stopping)
        if stop_at == "manifest":
            m.setattr(manifest, "put_new", no_file)
        with pytest.raises(Killed):
            snapshots.publish(view_of(spark, "b"), root, "o", "s", "r2")
    whole = {"user_daily_summary": ["a"], "user_summary": ["a"]}
    assert logins(pinned) == logins(snapshots.latest(spark, [root], "o", "s")) == whole
    places = snapshots.publish(view_of(spark, "b"), root, "o", "s", "r2")
    assert logins(pinned) == whole
    assert logins(snapshots.latest(spark, [root], "o", "s")) == {
        "user_daily_summary": ["b"], "user_summary": ["b"]}
    one = snapshots.read_path(spark, "user_summary", places["user_summary"]["history"])
    assert [r.user_login for r in one.collect()] == ["b"]
    log = Log(spark, snapshots.log_root(root, "views", "o", "s"))
    assert log.vacuum(LATER) and logins(snapshots.latest(spark, [root], "o", "s"))[
        "user_summary"] == ["b"]


def test_latest_of_a_root_without_any(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        snapshots.latest(spark, [str(tmp_path)], "o", "s")
    snapshots.publish(view_of(spark, "a"), str(tmp_path), "o", "s", "r1", fmt="json")
    with pytest.raises(ValueError):
        snapshots.read_view(spark, "user_summary", [str(tmp_path)], "o", "s", "parquet")
    got = snapshots.latest(spark, [f"{tmp_path}/none", str(tmp_path)], "o", "s")
    assert logins(got)["user_summary"] == ["a"]
    assert got.read("user_summary").where(F.col("active_days") == 1).count() == 1
