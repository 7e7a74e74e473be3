"""Ids of new sensors, and one registry for discovery and health."""

from __future__ import annotations

import json

from footfall.operators.health import last_data_time, latest_status, merged_recency
from footfall.operators.ingest import parse_payloads
from footfall.operators.registry import discover_sensors, highest_id, new_ids, register_readings
from footfall.plans.jobs import check_stream_health
from footfall.streaming.ingest import StreamTables, ingest_batch
from tests.conftest import at, rows


def reading(device, count, when="2024-01-01T08:00:00", place="B1"):
    return json.dumps([{"Device": device, "Data": [{"Location": place, "Total_IN": count, "TimeStamp": when, "ipaddr": "10.0.0.1"}]}])


def test_ids_are_dense_and_the_same_each_time(spark):
    devices = spark.sql("SELECT concat('dev-', id) AS device FROM range(3000)")
    first = {r.device: r.id for r in new_ids(devices, 41).collect()}
    assert sorted(first.values()) == list(range(42, 3042))
    again = {r.device: r.id for r in new_ids(devices.orderBy("device").repartition(7), 41).collect()}
    assert again == first
    assert new_ids(devices.limit(0), 5).collect() == []


def test_discovery_goes_on_above_the_highest_id(t):
    sensors = t.sensors(("a", "B9", "10.0.0.9", "2024-01-01", "Idle"), ("b", "B9", "10.0.0.9", None, "Idle"))
    assert highest_id(sensors) == 1 and highest_id(sensors.limit(0)) == -1
    readings = parse_payloads(t.messages(*[reading(d, 1) for d in "cabdc"]))
    found = discover_sensors(readings, sensors, "2024-02-01")
    assert sorted(r.id for r in found.collect()) == [2, 3]
    # An id that was given once and whose sensor is gone is not given again.
    assert sorted(r.id for r in discover_sensors(readings, sensors, "2024-02-01", 50).collect()) == [51, 52]
    after = register_readings(readings, sensors, "2024-02-01")
    assert dict(rows(after, "device", "id")) == {"a": 0, "b": 1, **{r.device: r.id for r in found.collect()}}


def test_ids_of_a_stream(spark, t, tmp_path):
    tables = StreamTables(str(tmp_path / "tables"))
    sensors = t.sensors(("z", "B9", "10.0.0.9", "2024-01-01", "Idle"))
    batches = [["a", "b"], ["b"], ["c", "a"], ["d"]]
    for batch, devices in enumerate(batches):
        raw = t.messages(*[reading(d, batch) for d in devices], start=batch * 10)
        ingest_batch(raw, batch, tables, t.resets(), sensors, at(f"2024-02-0{batch + 1}"))
    ids = dict(rows(tables.registry.after(spark, 3), "device", "id"))
    assert ids["z"] == 0 and {ids["a"], ids["b"]} == {1, 2} and (ids["c"], ids["d"]) == (3, 4)
    # A batch that is replayed from the version before gives the same ids.
    known = tables.registry.highest_before(spark, 2)
    raw = t.messages(*[reading(d, 2) for d in batches[2]], start=20)
    replayed = register_readings(parse_payloads(raw), tables.registry.before(spark, 2), at("2024-02-03"), known)
    assert rows(replayed, "device", "id") == rows(tables.registry.after(spark, 2), "device", "id")


def test_the_later_of_batch_and_check_holds(spark, t):
    sensors = t.sensors(
        ("a", "B1", "", "2024-01-05", "Online"), ("b", "B1", "", "2024-01-01", "Online"),
        ("c", "B1", "", None, "Online"), ("d", "B1", "", "2024-01-01", "Online"))
    checks = spark.createDataFrame(
        [("a", "Idle", None, at("2024-01-03")), ("b", "Offline", at("2023-12-01"), at("2024-01-03")),
         ("c", "Idle", None, at("2024-01-03"))],
        "device string, status string, last_data_time timestamp_ntz, checked_at timestamp_ntz")
    assert rows(latest_status(sensors, checks), "device", "status", "is_online", "last_seen") == [
        ("a", "Online", True, at("2024-01-05")), ("b", "Offline", False, at("2023-12-01")),
        ("c", "Idle", False, None), ("d", "Online", True, at("2024-01-01"))]


def test_health_of_a_stream_reads_no_log(spark, t, tmp_path):
    tables, none = StreamTables(str(tmp_path / "tables")), t.resets()
    sensors = t.sensors(("z", "B9", " ", "2024-01-01", "Online"))
    ingest_batch(t.messages(reading("a", 1), reading("b", 1)), 0, tables, none, sensors, at("2024-02-01 10:00"))
    ingest_batch(t.messages(reading("b", 2), start=5), 1, tables, none, sensors, at("2024-02-01 10:10"))
    recency = tables.recency(spark)
    assert rows(recency) == rows(last_data_time(tables.log(spark)))
    assert not any("/log/" in f for f in recency.inputFiles())
    probes = spark.createDataFrame([("a", True), ("z", True)], "device string, reachable boolean")
    summary = check_stream_health(spark, tables, probes, at("2024-02-01 10:12"))
    assert rows(summary, "online", "idle", "offline", "total") == [(1, 1, 1, 3)]
    assert rows(tables.sensors(spark), "device", "status") == [("a", "Idle"), ("b", "Online"), ("z", "Offline")]
    # A reading after the check brings its sensor back; the next check sees all.
    ingest_batch(t.messages(reading("a", 3), start=9), 2, tables, none, sensors, at("2024-02-01 10:20"))
    assert rows(tables.sensors(spark), "device", "status") == [("a", "Online"), ("b", "Online"), ("z", "Offline")]
    check_stream_health(spark, tables, probes, at("2024-02-01 10:30"))
    assert rows(tables.sensors(spark), "device", "status") == [("a", "Idle"), ("b", "Offline"), ("z", "Offline")]


def test_kept_recency_and_the_tail_of_a_log(t):
    log = t.log(*[(k, f"d{k % 4}", "B1", k, 0, f"2024-01-{k + 1:02d}") for k in range(12)])
    kept, tail = log.filter("id < 7"), log.filter("id >= 7")
    assert rows(merged_recency(last_data_time(kept), last_data_time(tail))) == rows(last_data_time(log))
