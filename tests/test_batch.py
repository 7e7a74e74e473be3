from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from footfall.operators.health import (
    apply_status,
    health_summary,
    last_data_time,
    recent_activity,
    sensor_health,
)
from footfall.operators.registry import (
    discover_sensors,
    role_membership,
    register_readings,
    sensor_lookup,
    sensor_status,
)
from footfall.operators.retention import archive_split, rows_to_delete
from footfall.plans import jobs
from footfall.plans.jobs import (
    run_building_reset,
    run_device_reset,
    run_health_check,
    run_retention,
)
from footfall.sources.tables import LOG_PARTITIONS as PARTITIONS
from footfall.sources.tables import with_month
from tests.conftest import at, rows

NOW = "2024-02-10 12:00:00"


def test_archive_split_moves_once_and_keeps_every_id(t):
    live = t.log(*[(n, "a", "B1", n, 0, f"2024-01-{n:02d}") for n in range(1, 21)])
    archive = live.filter("id in (2, 4)")
    split = archive_split(live, archive, "2024-01-10")
    assert rows(split.moved, "id") == [(n,) for n in (1, 3, 5, 6, 7, 8, 9)]
    assert sorted(r[0] for r in rows(split.live, "id") + rows(split.archive, "id")) == list(range(1, 21))
    again = archive_split(split.live, split.archive, "2024-01-10")
    assert rows(again.moved) == []
    assert rows(again.live) == rows(split.live) and rows(again.archive) == rows(split.archive)
    assert rows(rows_to_delete(live, archive, "2024-01-10"), "id") == [(2,), (4,)]


def test_archive_split_without_archive_and_exact_cutoff(t):
    live = t.log((1, "a", "B1", 1, 0, "2024-01-10"), (2, "a", "B1", 1, 0, "2024-01-09 23:59:59.999999"))
    split = archive_split(live, t.log(), "2024-01-10")
    assert rows(split.moved, "id") == [(2,)] and rows(split.live, "id") == [(1,)]


def test_retention_job_completes_an_interrupted_run(spark, t):
    log = t.log(
        (1, "a", "B1", 1, 0, "2023-12-31 23:59:59"),
        (2, "a", "B1", 2, 0, "2024-01-31"),
        (3, "a", "B1", 3, 0, "2024-02-01"),
    )
    save_log(log, "live")
    save_log(log.filter("id = 1"), "archive")
    assert run_retention(spark, "live", "archive", NOW) == 2
    assert rows(spark.table("live"), "id") == [(3,)]
    assert rows(spark.table("archive"), "id") == [(1,), (2,)]
    assert run_retention(spark, "live", "archive", NOW) == 0


def save_log(log, name, batch=0):
    """A log table in the layout of the stream."""
    columns = [c for c in log.columns if c not in PARTITIONS]
    placed = with_month(log).withColumn("ingest_batch", F.lit(batch).cast("long")).select(*columns, *PARTITIONS)
    placed.write.partitionBy(*PARTITIONS).mode("append").saveAsTable(name)


def test_retention_keeps_a_late_row_that_arrives_during_the_run(spark, t, monkeypatch):
    save_log(t.log((1, "a", "B1", 1, 0, "2024-01-05"), (3, "a", "B1", 3, 0, "2024-02-01")), "live_late")
    save_log(t.log((9, "z", "B1", 1, 0, "2023-01-05")), "archive_late")
    check = jobs.rows_to_delete

    def late(*args):
        save_log(t.log((2, "b", "B1", 2, 0, "2024-01-06")), "live_late", batch=1)
        return check(*args)

    monkeypatch.setattr(jobs, "rows_to_delete", late)
    assert run_retention(spark, "live_late", "archive_late", NOW) == 1
    spark.catalog.refreshTable("live_late")
    assert rows(spark.table("live_late"), "id") == [(2,), (3,)]
    assert rows(spark.table("archive_late"), "id") == [(1,), (9,)]
    monkeypatch.undo()
    assert run_retention(spark, "live_late", "archive_late", NOW) == 1
    assert rows(spark.table("live_late"), "id") == [(3,)]


def test_retention_needs_partitions_by_batch(spark, t):
    with_month(t.log((1, "a", "B1", 1, 0, "2024-01-05"))).write.partitionBy("event_month").saveAsTable("live_plain")
    with pytest.raises(ValueError):
        run_retention(spark, "live_plain", "live_plain", NOW)


def test_health(t, spark):
    sensors = t.sensors(
        ("a", "B1", "10.0.0.1", None, None),
        ("b", "B1", "10.0.0.2", "2024-01-01", "Online"),
        ("c", "B1", "  ", "2024-01-01", "Online"),
        ("d", "B1", "10.0.0.4", "2024-01-01", "Online"),
        ("e", "B1", None, None, "Idle"),
    )
    log = t.log(
        (1, "a", "B1", 1, 0, "2024-02-10 11:00:00", "2024-02-10 11:55:00"),
        (2, "b", "B1", 1, 0, "2024-02-10 11:59:00", "2024-02-10 11:54:59"),
        (3, "x", "B1", 1, 0, "2024-02-10 11:59:00", "2024-02-10 13:00:00"),
    )
    probes = spark.createDataFrame([("b", True), ("c", True), ("d", False), ("e", True)], "device string, reachable boolean")
    health = sensor_health(sensors, log, probes, NOW)
    assert rows(health, "device", "status") == [
        ("a", "Online"), ("b", "Idle"), ("c", "Offline"), ("d", "Offline"), ("e", "Offline")]
    assert rows(health_summary(health)) == [(1, 1, 3, 5)]
    assert rows(apply_status(sensors, health), "device", "is_online", "last_seen") == [
        ("a", True, at("2024-02-10 11:55:00")),
        ("b", False, at("2024-02-10 11:54:59")),
        ("c", False, at("2024-01-01")),
        ("d", False, at("2024-01-01")),
        ("e", False, None),
    ]
    known = t.sensors(*[(d, "B1", None, None, None) for d in ("a", "b", "silent", "x")])
    assert rows(recent_activity(log, known, NOW), "device_id", "is_active") == [
        ("a", False), ("b", False), ("silent", False), ("x", True)]
    assert rows(last_data_time(log)) == [
        ("a", at("2024-02-10 11:55:00")), ("b", at("2024-02-10 11:54:59")), ("x", at("2024-02-10 13:00:00"))]


def test_health_job(spark, t):
    t.sensors(("a", "B1", "10.0.0.1", None, None)).write.saveAsTable("sensors_in")
    t.log((1, "a", "B1", 1, 0, "2024-02-10 11:58:00")).write.saveAsTable("health_log")
    spark.createDataFrame([], "device string, reachable boolean").write.saveAsTable("probes")
    counts = run_health_check(spark, "sensors_in", "health_log", "probes", "sensors_out", NOW)
    assert rows(counts) == [(1, 0, 0, 1)]
    assert rows(spark.table("sensors_out"), "device", "status") == [("a", "Online")]


def test_reset_jobs_append_to_the_ledger(spark, t):
    t.log((1, "a", "B1", 5, 2, "2024-02-01"), (2, "b", "B1", 7, 3, "2024-02-01")).write.saveAsTable("reset_log")
    t.resets(("a", "2024-01-01", 1, 1)).write.saveAsTable("ledger")
    run_device_reset(spark, "reset_log", "ledger", ["a"], NOW)
    run_building_reset(spark, "reset_log", "ledger", "B1", "2024-02-11")
    assert rows(spark.table("ledger")) == [
        ("a", at("2024-01-01"), 1, 1), ("a", at("2024-02-10 12:00"), 5, 2),
        ("a", at("2024-02-11"), 5, 2), ("b", at("2024-02-11"), 7, 3)]


def test_listing_defaults(t):
    sensors = t.sensors(("a", None, None, None, None), ("b", "B1", "10.0.0.2", "2024-01-01", "Idle"))
    assert rows(sensor_status(sensors)) == [
        ("a", "", False, None, "", "Offline"), ("b", "B1", False, at("2024-01-01"), "10.0.0.2", "Idle")]
    assert rows(sensor_lookup(sensors, "b"), "device") == [("b",)]
    assert rows(sensor_lookup(sensors, "x")) == []


def readings(spark, *values):
    return spark.createDataFrame(list(values), "arrival long, position int, device_id string, location string, ip_address string")


def test_discovery_takes_the_first_reading_and_never_moves_a_sensor(spark, t):
    sensors = t.sensors(("a", "B1", "10.0.0.1", "2024-01-01", "Offline"), ("z", "B9", None, "2024-01-01", "Idle"))
    batch = readings(spark, (2, 0, "n", "B3", "10.0.0.3"), (1, 1, "n", "B2", ""), (1, 0, "a", "B7", "10.0.0.7"))
    assert rows(discover_sensors(batch, sensors, NOW), "device", "location", "ip_address", "status") == [
        ("n", "B2", "", "Online")]
    after = register_readings(batch, sensors, NOW)
    assert rows(after, "device", "location", "is_online", "last_seen", "status") == [
        ("a", "B1", True, at(NOW), "Online"),
        ("n", "B2", True, at(NOW), "Online"),
        ("z", "B9", False, at("2024-01-01"), "Idle"),
    ]


def test_roles(spark):
    users = spark.createDataFrame([(1, "u1", True), (2, "u2", False), (3, "u3", True)], "user_id int, username string, is_active boolean")
    roles = spark.createDataFrame([(1, "viewer"), (2, "admin")], "role_id int, role_name string")
    links = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "user_id int, role_id int")
    assert rows(role_membership(users, links, roles)) == [(1, "u1", ["admin", "viewer"])]


def test_cluster_without_shared_folder_is_refused(monkeypatch):
    from footfall import session

    class Context:
        master = "spark://x"

    class Conf:
        def get(self, name, default=None):
            return default

    class Fake:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        session.workspace(Fake(), "x")
