"""Landed deliveries: which files are opened, and the registry of their schemas."""

import json
import os

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from tidemark.fields import PROMPTS
from tidemark.plans.ingest import ingest_landed
from tidemark.sources import landing, ledger, snapshots
from tidemark.sources.landing import Registry
from tidemark.sources.ndjson import SchemaClash


def put(root, day, delivery, rows, part="part-0", table="user_metrics"):
    folder = f"{root}/{table}/day={day}/delivery={delivery}"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{part}.json", "w", encoding="utf-8") as f:
        f.writelines((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in rows)


@pytest.fixture
def registry(spark, tmp_path):
    return Registry(spark, f"{tmp_path}/user_metrics", f"{tmp_path}/home")


def fields(registry, days=100):
    deliveries = registry.window(days)
    return {f.name: f.dataType.simpleString() for f in registry.read(deliveries).schema}


def test_only_the_newest_deliveries_of_the_window_are_opened(spark, tmp_path, registry):
    for d in range(1, 9):
        for delivery in ("01", "02"):
            for part in ("a", "b"):
                put(tmp_path, f"2025-01-0{d}", delivery, [{"user_login": f"{d}{delivery}"}], part)
    put(tmp_path, "2025-01-08", "03", [{"user_login": "last"}])
    open(f"{tmp_path}/user_metrics/day=2025-01-08/delivery=03/empty.json", "w").close()
    rows = registry.read(registry.window(3))
    opened = {f.removeprefix("file://") for f in rows.inputFiles()}
    base = f"{tmp_path}/user_metrics"
    assert opened == {f"{base}/day=2025-01-0{d}/delivery=02/{p}.json"
                      for d in (6, 7) for p in "ab"} | {
                          f"{base}/day=2025-01-08/delivery=03/{p}.json" for p in ("part-0", "empty")}
    assert sorted(map(tuple, rows.select("day", "user_login").collect())) == [
        ("2025-01-06", "602"), ("2025-01-06", "602"), ("2025-01-07", "702"),
        ("2025-01-07", "702"), ("2025-01-08", "last")]
    assert set(registry.known()) == {f"2025-01-0{d}" for d in (6, 7, 8)}


def test_a_delivery_is_registered_once(spark, tmp_path, registry, monkeypatch):
    put(tmp_path, "2025-01-01", "01", [{"a": 1}])
    put(tmp_path, "2025-01-02", "01", [{"b": "x"}])
    assert fields(registry) == {"day": "string", "a": "bigint", "b": "string"}
    asked = []
    registered = landing.registered

    def counted(spark, root, deliveries):
        asked.append([d.day for d in deliveries])
        return registered(spark, root, deliveries)

    monkeypatch.setattr(landing, "registered", counted)
    assert fields(registry) == {"day": "string", "a": "bigint", "b": "string"}
    put(tmp_path, "2025-01-02", "01", [{"c": True}], "late")  # another part of a known delivery
    assert fields(registry)["c"] == "boolean"
    put(tmp_path, "2025-01-01", "02", [{"d": 1}])  # a restated day
    assert set(fields(registry)) == {"day", "b", "c", "d"}
    assert asked == [[], ["2025-01-02"], ["2025-01-01"]]
    assert registry.log.numbers() == [1, 2, 3]


def test_types_widen_within_and_between_deliveries(tmp_path, registry, rows):
    put(tmp_path, "2025-01-01", "01", [{"a": 1, "n": None, "t": []}, {"a": 2}])
    put(tmp_path, "2025-01-02", "01", [{"a": 2.5, "n": None, "t": [{"x": 1, "y": None}, None]}])
    put(tmp_path, "2025-01-03", "01", [
        {"a": None, "o": {"k v": 1, "l": {"m": 12345678901234567890123}}}, {"t": [{"x": 0.5}]}])
    assert fields(registry, 1) == {
        "day": "string", "a": "string", "o": "struct<k v:bigint,l:struct<m:double>>",
        "t": "array<struct<x:double>>"}
    assert fields(registry) == {
        "day": "string", "a": "double", "n": "string",
        "t": "array<struct<x:double,y:string>>", "o": "struct<k v:bigint,l:struct<m:double>>"}
    read = registry.read(registry.window(100))
    assert rows(read, "day", "a") == [
        ("2025-01-01", 1.0), ("2025-01-01", 2.0), ("2025-01-02", 2.5), ("2025-01-03", None),
        ("2025-01-03", None)]


@pytest.mark.parametrize("first, second, field", [
    ({"t": [{"x": {"y": 1}}]}, {"t": [{"x": {"y": "s"}}]}, ".t[].x.y"),
    ({"a": True}, {"a": 1}, ".a"), ({"a": [1]}, {"a": {"b": 1}}, ".a"),
])
def test_clashes_name_field_and_delivery(tmp_path, registry, first, second, field):
    put(tmp_path, "2025-01-01", "01", [first])
    put(tmp_path, "2025-01-02", "07", [second])
    with pytest.raises(SchemaClash) as e:
        registry.window(100)
    assert f"2025-01-02, delivery 07{field}" in str(e.value)
    assert registry.log.numbers() == []
    put(tmp_path, "2025-01-02", "08", [first])
    assert len(registry.window(100)) == 2
    put(tmp_path, "2025-01-03", "01", [first, second])  # both in one delivery
    with pytest.raises(SchemaClash) as e:
        registry.window(100)
    assert f"2025-01-03, delivery 01{field}" in str(e.value)


def test_blank_malformed_and_absent_deliveries(spark, tmp_path, registry):
    assert registry.window(7) == [] and registry.read([]).columns == ["day"]
    put(tmp_path, "2025-01-01", "01", ["", "  "])
    assert registry.read(registry.window(7)).count() == 0
    put(tmp_path, "2025-01-02", "01", ['{"a": '])
    with pytest.raises((PySparkException, Py4JJavaError)):
        registry.window(7)
    assert set(registry.known()) == {"2025-01-01"}


def test_known_fields_only(spark, tmp_path):
    put(tmp_path, "2025-01-01", "01", [{"a": None, "b": 1, "day": "2099-01-01"}])
    root = f"{tmp_path}/user_metrics"
    deliveries = landing.registered(spark, root, landing.newest(spark, root, ["2025-01-01"]))
    read = landing.scan(spark, root, deliveries, landing.merged(root, deliveries),
                        {"a": T.BooleanType()})
    assert read.dtypes == [("day", "string"), ("a", "boolean")]
    assert read.first().day == "2025-01-01"


def test_a_run_over_a_landing_area(spark, tmp_path, rows, monkeypatch):
    root = f"{tmp_path}/out"
    for d in range(1, 6):
        day = f"2025-01-0{d}"
        put(tmp_path, day, "01", [{"user_login": "a", PROMPTS: d}, {"user_login": "b"}])
        put(tmp_path, day, "01", [{PROMPTS: d, "totals_by_language_feature": [
            {"language": "go", PROMPTS: d}]}], table="org_metrics")
    put(tmp_path, "2025-01-06", "01", [{"user_login": "c", PROMPTS: 1}])

    def run():
        return ingest_landed(spark, str(tmp_path), root, report_window_days=3, org="o")

    first = run()
    assert first["status"] == "succeeded"
    assert first["raw_records"] == {"org_metrics": 2, "user_metrics": 5}
    monkeypatch.setattr(landing, "registered", lambda spark, root, new: [] if not new else 1 / 0)
    assert run()["snapshot_records"] == first["snapshot_records"]
    latest = snapshots.latest(spark, [root], "o", "reports")
    assert rows(latest.read("user_daily_summary"), "day", "user_login", PROMPTS) == [
        ("2025-01-04", "a", 4), ("2025-01-04", "b", None), ("2025-01-05", "a", 5),
        ("2025-01-05", "b", None), ("2025-01-06", "c", 1)]
    assert rows(latest.read("daily_summary"), "day") == [("2025-01-04",), ("2025-01-05",)]
    assert rows(latest.read("language_summary"), "day", PROMPTS) == [
        ("2025-01-04", 4), ("2025-01-05", 5)]
    runs = ledger.current_runs(ledger.read_ledger(spark, f"{root}/ledger"))
    assert runs.where("status = 'succeeded'").count() >= 1
