from __future__ import annotations

import json
from datetime import datetime, timedelta

import pytest

from footfall.operators.trend import sensor_trend
from footfall.plans.jobs import clean_up, run_retention
from footfall.sources import files
from footfall.sources.payloads import payload_files
from footfall.sources.tables import LOG_PARTITIONS, read_log
from footfall.streaming import ingest as stream
from footfall.streaming.ingest import StreamTables, ingest_batch, ingest_stream, summary_stream
from tests.conftest import at, rows


def clock(batch):
    return datetime(2024, 2, 1) + timedelta(hours=batch)


def message(device, place, count, when):
    return json.dumps([{"Device": device, "Data": [{"Location": place, "Total_IN": count, "TimeStamp": when}]}])


FIRST = [message("a", "B1", 5, "2024-01-01T08:00:00"), message("a", "B1", 5, "2024-01-01T08:05:00"),
         message("b", "B1", 7, "2024-01-01T08:00:00"), "broken"]
# A late reading that differs from the last one, an unchanged one, and a move.
SECOND = [message("a", "B1", 4, "2024-01-01T07:00:00"), message("b", "B1", 7, "2024-01-01T09:00:00"),
          message("a", "B2", 6, "2024-01-01T09:00:00")]


@pytest.fixture
def tables(tmp_path):
    return StreamTables(str(tmp_path / "tables"))


def run(spark, t, tables, source, resets=None):
    none = resets if resets is not None else t.resets(("a", "2024-01-01", 2, 0))
    sensors = t.sensors(("b", "B9", "10.0.0.2", "2024-01-01", "Offline"))
    ingest_stream(payload_files(spark, source), tables, lambda: none, sensors, clock, None).awaitTermination()
    summary_stream(spark, tables, lambda: none, clock, None).awaitTermination()


def check(spark, tables):
    assert rows(tables.log(spark), "device_id", "in_count", "event_time", "created_at") == [
        ("a", 4, at("2024-01-01 07:00"), clock(1)),
        ("a", 5, at("2024-01-01 08:00"), clock(0)),
        ("a", 6, at("2024-01-01 09:00"), clock(1)),
        ("b", 7, at("2024-01-01 08:00"), clock(0)),
    ]
    assert rows(tables.batches(spark, "device_feed"), "ingest_batch", "device_id", "display_in", "route") == [
        (0, "a", 3, "building:B1"), (0, "b", 7, "building:B1"), (1, "a", 4, "building:B2")]
    assert rows(tables.batches(spark, "summary_feed"), "ingest_batch", "building", "total_in", "route") == [
        (0, "B1", 10, "dashboard"), (1, "B1", 7, "dashboard"), (1, "B2", 4, "dashboard")]
    assert rows(tables.registry.after(spark, 1), "device", "location", "last_seen", "status") == [
        ("a", "B1", clock(1), "Online"), ("b", "B9", clock(1), "Online")]
    assert rows(tables.batches(spark, "rejects"), "ingest_batch", "reason") == [(0, "bad_message")]
    # Each device's newest row per building stays, so building lists still show who left.
    assert rows(tables.devices.after(spark, 1), "device_id", "location", "in_count") == [
        ("a", "B1", 4), ("a", "B2", 6), ("b", "B1", 7)]


def test_restart_between_batches(spark, t, tmp_path, tables):
    source = str(tmp_path / "in")
    t.messages(*FIRST).write.parquet(source)
    run(spark, t, tables, source)
    t.messages(*SECOND, start=10).write.mode("append").parquet(source)
    run(spark, t, tables, source)
    check(spark, tables)
    run(spark, t, tables, source)
    check(spark, tables)


@pytest.mark.parametrize("fails_at", ["newest_per_place", "latest_devices", "register_readings"])
def test_replay_after_a_failure_in_the_middle(spark, t, tmp_path, tables, monkeypatch, fails_at):
    source = str(tmp_path / "in")
    t.messages(*FIRST).write.parquet(source)
    run(spark, t, tables, source)
    t.messages(*SECOND, start=10).write.mode("append").parquet(source)

    def fail(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(stream, fails_at, fail)
        with pytest.raises(Exception, match="lost"):
            run(spark, t, tables, source)
    run(spark, t, tables, source)
    check(spark, tables)


def test_a_batch_without_valid_rows_keeps_the_state(spark, t, tables):
    sensors, resets = t.sensors(), t.resets()
    ingest_batch(t.messages(*FIRST), 0, tables, resets, sensors, clock(0))
    ingest_batch(t.messages("broken", ""), 1, tables, resets, sensors, clock(1))
    ingest_batch(t.messages(message("a", "B1", 5, "2024-01-01T10:00:00"), start=5), 2, tables, resets, sensors, clock(2))
    assert rows(tables.log(spark), "device_id") == [("a",), ("b",)]
    assert rows(tables.batches(spark, "rejects"), "ingest_batch", "reason") == [
        (0, "bad_message"), (1, "bad_message"), (1, "no_valid_rows")]
    # The unchanged reading is no log row, but a sign of life.
    assert rows(tables.registry.after(spark, 2), "device", "last_seen") == [("a", clock(2)), ("b", clock(0))]


def test_the_summary_survives_a_replay_of_batches_it_has_read(spark, t, tmp_path, tables, monkeypatch):
    """The ingest checkpoint is lost after its commit; the batch is replayed and the log, feeds
    and totals stay as they are."""
    source = str(tmp_path / "in")
    t.messages(*FIRST).write.parquet(source)
    run(spark, t, tables, source)
    none, sensors = t.resets(("a", "2024-01-01", 2, 0)), t.sensors(("b", "B9", "10.0.0.2", "2024-01-01", "Offline"))
    before = [f.name for f in (tmp_path / "tables" / "appended" / "ingest_batch=0").iterdir()]
    ingest_batch(t.messages(*FIRST), 0, tables, none, sensors, clock(5))
    assert [f.name for f in (tmp_path / "tables" / "appended" / "ingest_batch=0").iterdir()] == before
    t.messages(*SECOND, start=10).write.mode("append").parquet(source)
    run(spark, t, tables, source)
    check(spark, tables)


def test_a_replay_before_the_commit_while_the_summary_waits(spark, t, tmp_path, tables, monkeypatch):
    source = str(tmp_path / "in")
    t.messages(*FIRST).write.parquet(source)
    run(spark, t, tables, source)
    none, sensors = t.resets(("a", "2024-01-01", 2, 0)), t.sensors()
    rows_in = t.messages(*SECOND, start=10)

    def fail(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(stream, "latest_devices", fail)  # the log of the batch is written already
        with pytest.raises(RuntimeError):
            ingest_batch(rows_in, 1, tables, none, sensors, clock(1))
    summary_stream(spark, tables, lambda: none, clock, None).awaitTermination()
    assert rows(tables.batches(spark, "summary_feed"), "ingest_batch") == [(0,)]
    rows_in.write.mode("append").parquet(source)
    run(spark, t, tables, source)
    check(spark, tables)


def test_later_batches_win_whatever_the_clock_says(spark, t, tables):
    resets, sensors = t.resets(), t.sensors()
    ingest_batch(t.messages(message("a", "B1", 5, "2024-01-01T08:00:00")), 0, tables, resets, sensors, clock(9))
    ingest_batch(t.messages(message("a", "B1", 6, "2024-01-01T09:00:00"), start=5), 1, tables, resets, sensors, clock(1))
    assert rows(tables.devices.after(spark, 1), "device_id", "in_count") == [("a", 6)]


def test_streamed_rows_reach_trend_and_archive(spark, t, tmp_path, tables):
    source = str(tmp_path / "in")
    t.messages(*FIRST).write.parquet(source)
    run(spark, t, tables, source)
    log = read_log(spark, tables.folder("log"))
    names = t.log().columns
    assert rows(sensor_trend(log.select(*names), t.log(), t.resets(), "a", "2024-01-01", "2024-01-02")) == [
        (at("2024-01-01 08:00"), 0, 0)]
    log.write.partitionBy(*LOG_PARTITIONS).saveAsTable("streamed_live")
    log.limit(0).write.partitionBy(*LOG_PARTITIONS).saveAsTable("streamed_archive")
    assert run_retention(spark, "streamed_live", "streamed_archive", "2024-02-10") == 2
    assert spark.table("streamed_archive").count() == 2


def test_clean_up_keeps_the_log(spark, t, tables):
    resets, sensors = t.resets(), t.sensors()
    for batch in range(3):
        text = message("a", "B1", batch + 1, f"2024-01-01T0{batch}:00:00")
        ingest_batch(t.messages(text, start=batch), batch, tables, resets, sensors, clock(batch))
    assert clean_up(spark, tables, keep=1) == 8
    assert tables.log(spark).count() == 3
    assert rows(tables.batches(spark, "device_feed"), "ingest_batch") == [(2,)]


def test_a_crash_at_the_commit_loses_no_summary(spark, t, tmp_path, tables, monkeypatch):
    source = str(tmp_path / "in")
    t.messages(*FIRST).write.parquet(source)
    run(spark, t, tables, source)
    t.messages(*SECOND, start=10).write.mode("append").parquet(source)
    put = files.put_json

    def crash(session, path, value):
        if "commits" in path:
            # The draft is there, the file is not.
            (tmp_path / "tables" / "commits" / ".batch-1.json-draft").write_text('{"ingest_batch": 1}')
            raise RuntimeError("lost")
        return put(session, path, value)

    with monkeypatch.context() as broken:
        broken.setattr(files, "put_json", crash)
        with pytest.raises(Exception, match="lost"):
            run(spark, t, tables, source)
    assert tables.commits(spark) == [0]
    run(spark, t, tables, source)
    assert tables.commits(spark) == [0, 1]
    check(spark, tables)


def test_clean_up_waits_for_the_summary(spark, t, tables):
    none, sensors = t.resets(), t.sensors()

    def ingest(batch):
        text = message("a", "B1", batch + 1, f"2024-01-01T0{batch}:00:00")
        ingest_batch(t.messages(text, start=batch), batch, tables, none, sensors, clock(batch))

    ingest(0)
    summary_stream(spark, tables, lambda: none, clock, None).awaitTermination()
    ingest(1)
    ingest(2)
    assert clean_up(spark, tables, keep=0) == 4 and tables.commits(spark) == [1, 2]
    summary_stream(spark, tables, lambda: none, clock, None).awaitTermination()
    assert rows(tables.batches(spark, "summary_feed"), "ingest_batch", "total_in") == [(0, 1), (1, 3)]
    assert clean_up(spark, tables, keep=0) == 8
    ingest(3)
    assert rows(tables.devices.after(spark, 3), "in_count") == [(4,)] and tables.log(spark).count() == 4


def test_a_replay_keeps_the_time_of_the_first_try(spark, t, tables, monkeypatch):
    raw, none, sensors = t.messages(*FIRST), t.resets(), t.sensors()

    def fail(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(stream, "latest_devices", fail)
        with pytest.raises(RuntimeError):
            ingest_batch(raw, 0, tables, none, sensors, clock(0))
    ingest_batch(raw, 0, tables, none, sensors, clock(7))
    for df in (tables.log(spark), tables.appended(spark, [0]), tables.devices.after(spark, 0)):
        assert rows(df, "device_id", "created_at") == [("a", clock(0)), ("b", clock(0))]


def test_a_processing_time_trigger_takes_new_batches(spark, t, tmp_path, tables):
    source = str(tmp_path / "in")
    t.messages(*FIRST).write.parquet(source)
    query = ingest_stream(payload_files(spark, source), tables, t.resets, t.sensors(), clock, "1 second")
    try:
        query.processAllAvailable()
        t.messages(*SECOND, start=10).write.mode("append").parquet(source)
        query.processAllAvailable()
    finally:
        query.stop()
    assert rows(tables.log(spark), "device_id") == [("a",), ("a",), ("a",), ("b",)]
