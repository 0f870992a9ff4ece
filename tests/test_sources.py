import datetime as dt
import json

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.fields import AGENT_EDIT, FLAG_AGENT, PROMPTS, VIEW_SCHEMAS
from tidemark.functions.scalars import run_id, utc_text
from tidemark.operators import views
from tidemark.plans.ingest import ingest, new_run_id
from tidemark.sources import days, ledger, ndjson, scratch, snapshots
from tidemark.sources.manifest import Log

# Schema inference reports a bad line as a Java error, a read as a Spark error.
MALFORMED = (PySparkException, Py4JJavaError)


def lines(path, rows):
    path.write_text("".join(json.dumps(r, ensure_ascii=False) + "\n" for r in rows), "utf-8")
    return str(path)


# --- scan, union, sink


def test_parts_with_different_fields(spark, tmp_path, rows):
    a = lines(tmp_path / "a.json", [{"day": "2025-01-01", "x": 1}])
    b = lines(tmp_path / "b.json", [{"day": "2025-01-02", "y": 2}])
    df = ndjson.read_ndjson(spark, [a, b])
    assert rows(df, "day", "x", "y") == [("2025-01-01", 1, None), ("2025-01-02", None, 2)]


def test_malformed_line_is_an_error(spark, tmp_path):
    p = tmp_path / "bad.json"
    p.write_text('{"day": "2025-01-01"}\n{"day": \n')
    with pytest.raises(MALFORMED):
        ndjson.read_ndjson(spark, str(p)).collect()


def test_union_of_none_one_many(spark, rows):
    a = spark.createDataFrame([(1, "x")], "id bigint, val string")
    b = spark.createDataFrame([(2,)], "id bigint")
    assert ndjson.drift_union([]) is None
    assert ndjson.drift_union([a]) is a
    assert rows(ndjson.drift_union([a, b])) == [(1, "x"), (2, None)]


def test_union_of_nested_drift(spark, rows):
    a = spark.createDataFrame([([(1, "p")],)], "e array<struct<n bigint, s string>>")
    b = spark.createDataFrame([([(2,)],)], "e array<struct<n bigint>>")
    out = ndjson.drift_union([a, b]).select(F.explode("e").alias("e")).select("e.*")
    assert rows(out) == [(1, "p"), (2, None)]


def test_union_type_clash_fails_early(spark):
    a = spark.createDataFrame([(1,)], "v bigint")
    b = spark.createDataFrame([("x",)], "v string")
    with pytest.raises(ndjson.SchemaClash):
        ndjson.drift_union([a, b])


def test_sink_writes_nulls_and_text(spark, tmp_path):
    df = spark.createDataFrame([("日本語", None)], "name string, n bigint")
    path = str(tmp_path / "out")
    ndjson.write_ndjson(df, path)
    text = spark.read.text(path).first().value
    assert text == '{"name":"日本語","n":null}'


def test_sink_of_empty_frame(spark, tmp_path):
    path = str(tmp_path / "out")
    ndjson.write_ndjson(spark.createDataFrame([], "a bigint"), path)
    assert spark.read.text(path).count() == 0


def test_json_array_keeps_order(spark):
    df = spark.createDataFrame([("b", None), ("a", 1)], "day string, n bigint")
    assert json.loads(ndjson.json_array(df, ["day"]).first().json) == [
        {"day": "a", "n": 1}, {"day": "b", "n": None},
    ]
    with pytest.raises(ValueError):
        ndjson.json_array(df, ["day"], max_rows=1)


# --- days


def test_report_days(spark):
    got = [r.day for r in days.report_days(spark, 3, dt.date(2025, 3, 1)).collect()]
    assert got == ["2025-02-27", "2025-02-28", "2025-03-01"]
    today = dt.date.today()
    assert days.report_days(spark, 1).first().day == str(today - dt.timedelta(days=2))
    assert days.report_days(spark).count() == 100
    for bad in (0, 101):
        with pytest.raises(ValueError):
            days.report_days(spark, bad)


def test_observed_days_fill_gaps(spark, rows):
    df = spark.createDataFrame([("2025-01-01",), ("2025-01-03",)], "day string")
    assert len(rows(days.observed_days(df))) == 3
    assert days.observed_days(df.where("false")).count() == 0


# --- scratch


def test_scratch_uses_the_session_setting(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert scratch.fresh_dir(spark, "x").startswith(f"{base}/x-")


# --- ledger


def event(i, status, second, **more):
    t = dt.datetime(2025, 1, 1, 0, 0, second)
    base = {"id": i, "source": "s", "status": status, "trigger": "timer", "started_at": t}
    return {**base, **more}


def test_ledger_states(spark, tmp_path, rows):
    path = str(tmp_path / "ledger")
    done = dt.datetime(2025, 1, 1, 0, 1)
    for e in [
        event("r1", "running", 0),
        event("r1", "succeeded", 0, completed_at=done, raw_records={"org_metrics": 2}),
        event("r2", "running", 5),
        event("r2", "failed", 5, completed_at=done, error="boom"),
        event("r3", "running", 9, source="t"),
    ]:
        ledger.append_event(spark, path, e)
    log = ledger.read_ledger(spark, path)
    assert rows(ledger.current_runs(log), "id", "status", "error") == [
        ("r1", "succeeded", None), ("r2", "failed", "boom"), ("r3", "running", None),
    ]
    latest = ledger.latest_per_source(log)
    assert rows(latest, "latest_id", "run_id", "status") == [
        ("latest:s", "r2", "failed"), ("latest:t", "r3", "running"),
    ]
    assert {r.source: r.updated_at for r in latest.collect()} == {
        "s": done, "t": dt.datetime(2025, 1, 1, 0, 0, 9),
    }
    metrics = ledger.run_metrics(ledger.current_runs(log))
    assert rows(metrics, "id", "organization")[0] == ("run:r1", "mock")
    ledger.write_run_metrics(metrics, str(tmp_path / "metrics"))
    back = spark.read.parquet(str(tmp_path / "metrics"))
    assert back.where("organization = 'mock'").count() == 3


def test_run_id_text(spark):
    started = dt.datetime(2025, 1, 2, 3, 4, 5, 999999, tzinfo=dt.timezone.utc)
    assert new_run_id(started, "abcdefghij") == "20250102T030405Z-abcdefgh"
    df = spark.createDataFrame([(started, "abcdefghij")], "t timestamp, i string")
    r = df.select(run_id("t", "i").alias("a"), utc_text("t").alias("b")).first()
    assert r == ("20250102T030405Z-abcdefgh", "2025-01-02T03:04:05Z")


# --- snapshots


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_publish_and_read(spark, tmp_path, rows, fmt):
    root = str(tmp_path)
    first = spark.createDataFrame([("2025-01-01", "a")], "day string, user_login string")
    view = views.user_daily_summary(first)
    snapshots.publish({"user_daily_summary": view}, root, "o", "s", "r1", fmt=fmt)
    other = views.user_daily_summary(first.withColumn("user_login", F.lit("b")))
    snapshots.publish({"user_daily_summary": other}, root, "o", "s", "r2", fmt=fmt)
    snapshots.publish({"user_daily_summary": view}, root, "o2", "s", "r3", fmt=fmt)

    def read(org, roots):
        return rows(
            snapshots.read_view(spark, "user_daily_summary", roots, org, "s", fmt),
            "day", "user_login", PROMPTS, FLAG_AGENT,
        )

    assert read("o", [root]) == [("2025-01-01", "b", 0, False)]
    assert read("o", [f"{root}/absent", root]) == [("2025-01-01", "b", 0, False)]
    assert read("o2", [root]) == [("2025-01-01", "a", 0, False)]
    old = snapshots.history_path(root, "views", "o", "s", "r1", "user_daily_summary")
    assert snapshots.read_path(spark, "user_daily_summary", old, fmt).first().user_login == "a"


def test_only_known_views(spark, tmp_path):
    with pytest.raises(ValueError):
        snapshots.read_view(spark, "secrets", [str(tmp_path)], "o", "s")
    with pytest.raises(ValueError):
        snapshots.publish({"secrets": spark.range(1)}, str(tmp_path), "o", "s", "r")
    with pytest.raises(FileNotFoundError):
        snapshots.read_view(spark, "daily_summary", [str(tmp_path)], "o", "s")


def test_view_documents_keep_items_as_rows(spark, tmp_path, rows):
    view = spark.createDataFrame([("2025-01-01", None), ("2025-01-02", 2)], "day string, n bigint")
    docs = snapshots.view_documents({"daily_summary": view}, None, "s", "r1", "t")
    assert rows(docs, "id", "organization", "item") == [
        ("latest:daily_summary", "mock", '{"day":"2025-01-01","n":null}'),
        ("latest:daily_summary", "mock", '{"day":"2025-01-02","n":2}'),
        ("r1:daily_summary", "mock", '{"day":"2025-01-01","n":null}'),
        ("r1:daily_summary", "mock", '{"day":"2025-01-02","n":2}'),
    ]
    snapshots.write_documents(docs, str(tmp_path / "docs"))
    back = spark.read.parquet(str(tmp_path / "docs"))
    assert back.where("view_type = 'daily_summary'").count() == 4


@pytest.mark.parametrize("max_bytes", [60, 100, 1000, 100_000])
def test_bounded_documents(spark, tmp_path, max_bytes):
    """All items in view order, none twice, no document above the size."""
    names = [("x" * (i * 7 % 40)) + f"{i:03d}" for i in range(200)]
    view = spark.createDataFrame(
        [(f"2025-{i % 12 + 1:02d}-{i // 12 + 1:02d}", n) for i, n in enumerate(names)],
        "day string, n string").repartition(5)
    view = view.unionByName(spark.createDataFrame([("2026-01-01", None)], view.schema))
    if max_bytes == 60:
        with pytest.raises(Exception, match="does not fit"):
            snapshots.bounded_documents({"daily_summary": view}, Log(spark, str(tmp_path)), None,
                                        "s", "r", "t", max_bytes).collect()
        return
    docs = snapshots.bounded_documents({"daily_summary": view}, Log(spark, str(tmp_path)), None,
                                       "s", "r", "t", max_bytes).collect()
    latest = sorted((d for d in docs if d.id.startswith("latest:")), key=lambda d: d.number)
    assert len(docs) == 2 * len(latest)
    assert [d.number for d in latest] == list(range(1, len(latest) + 1))
    assert {d.total for d in docs} == {len(latest)}
    items = [i for d in latest for i in json.loads(d.items)]
    assert [(i["day"], i["n"]) for i in items] == sorted(map(tuple, view.collect()))
    assert all(len(d.items.encode()) <= max_bytes + 1 for d in latest)
    assert all(d.item_count == len(json.loads(d.items)) for d in latest)
    if max_bytes == 100_000:
        assert {d.id for d in docs} == {"latest:daily_summary", "r:daily_summary"}
    else:
        assert latest[1].id == "latest:daily_summary:2"
    if max_bytes == 1000:
        assert len(latest) < 2.2 * sum(len(d.items) for d in latest) / max_bytes


def test_bounded_documents_of_an_empty_view(spark, tmp_path):
    view = spark.createDataFrame([], "day string, n string")
    assert snapshots.bounded_documents({"daily_summary": view}, Log(spark, str(tmp_path)), None,
                                       "s", "r", "t").count() == 0


def test_record_counts(spark, rows):
    frames = {"a": spark.range(3), "b": spark.range(0)}
    assert rows(snapshots.record_counts(frames)) == [("a", 3), ("b", 0)]


# --- a whole run


def test_ingest_run(spark, tmp_path, rows):
    org = lines(tmp_path / "org.json", [
        {"day": "2025-01-02", PROMPTS: 3, "totals_by_language_feature": [
            {"language": "python", "feature": "code_completion", PROMPTS: 2,
             "code_generation_activity_count": 5, "code_acceptance_activity_count": 1}]},
        {"day": "2025-01-01", PROMPTS: 4},
    ])
    user = lines(tmp_path / "user.json", [
        {"day": "2025-01-01", "user_id": 9, "user_login": "日本", PROMPTS: 1, AGENT_EDIT: None},
        {"day": "2025-01-02", "user_id": 9, "user_login": "日本", PROMPTS: 2, AGENT_EDIT: 4},
    ])
    root = str(tmp_path / "out")
    run = ingest(spark, org, user, root, org="acme", invocation_id="0123456789")
    assert run["status"] == "succeeded" and run["id"].endswith("-01234567")
    assert run["raw_records"] == {"org_metrics": 2, "user_metrics": 2}
    assert run["snapshot_records"] == {
        "daily_summary": 2, "language_summary": 1, "user_daily_summary": 2, "user_summary": 1,
    }

    def read(name):
        return snapshots.read_view(spark, name, [root], "acme", "reports")

    assert rows(read("daily_summary"), "day", PROMPTS) == [("2025-01-01", 4), ("2025-01-02", 3)]
    assert rows(read("user_daily_summary"), "day", AGENT_EDIT) == [
        ("2025-01-01", None), ("2025-01-02", 4),
    ]
    assert "user_id" not in read("user_daily_summary").columns
    assert rows(read("user_summary"), "user_login", "active_days", PROMPTS, AGENT_EDIT) == [
        ("日本", 2, 3, 4)
    ]
    assert rows(read("language_summary"), "language", "activity_score") == [("python", 8)]
    log = ledger.read_ledger(spark, f"{root}/ledger")
    assert rows(log, "status") == [("running",), ("succeeded",)]
    assert ledger.current_runs(log).first().snapshot_records["daily_summary"] == 2


def test_failed_run_is_recorded(spark, tmp_path, rows):
    bad = tmp_path / "bad.json"
    bad.write_text('{"day": \n')
    root = str(tmp_path / "out")
    with pytest.raises(MALFORMED):
        ingest(spark, str(bad), str(bad), root)
    log = ledger.read_ledger(spark, f"{root}/ledger")
    current = ledger.current_runs(log).first()
    assert current.status == "failed" and current.error
    assert ledger.run_metrics(ledger.current_runs(log)).first().organization == "mock"


def test_empty_reports_give_empty_views(spark, tmp_path):
    empty = lines(tmp_path / "empty.json", [])
    root = str(tmp_path / "out")
    run = ingest(spark, empty, empty, root)
    assert run["status"] == "succeeded"
    assert set(run["snapshot_records"].values()) == {0}
    assert set(run["raw_records"].values()) == {0}
    for name in VIEW_SCHEMAS:
        assert snapshots.read_view(spark, name, [root], "mock", "reports").count() == 0
