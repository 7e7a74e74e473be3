"""Keys of rows, the state in buckets and the log store."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall import schemas
from footfall.operators.ingest import drop_unchanged, parse_payloads, to_log_rows
from footfall.operators.latest import latest_log
from footfall.operators.retention import rows_to_delete, rows_to_move
from footfall.sources import files
from footfall.sources.logstore import LogStore
from footfall.sources.payloads import topic_messages
from footfall.sources.tables import log_store, log_union, read_log, with_month
from footfall.streaming.state import StateTable
from tests.conftest import at, rows

FAR = 1 << 60


def topic(spark, *records):
    """``partition, offset, counts``: one message with a reading for each count."""
    made = [
        (partition, offset, json.dumps([{"Device": "a", "Data": [
            {"Location": "B1", "Total_IN": n, "TimeStamp": "2024-01-01T08:00:00"} for n in counts]}]).encode())
        for partition, offset, counts in records
    ]
    return topic_messages(spark.createDataFrame(made, "partition int, offset long, value binary"))


def test_far_offsets_and_many_partitions(spark):
    raw = topic(spark, (5000, FAR, [5, 5, 6]), (0, FAR, [7]), (2**31 - 1, 2**63 - 1, [8, 8]))
    log = to_log_rows(parse_payloads(raw), "2024-02-01")
    assert rows(log, "arrival", "source", "position", "in_count") == [
        (FAR, 0, 0, 7), (FAR, 5000, 0, 5), (FAR, 5000, 1, 5), (FAR, 5000, 2, 6),
        (2**63 - 1, 2**31 - 1, 0, 8), (2**63 - 1, 2**31 - 1, 1, 8)]
    # All at one event time: the key alone orders them.
    assert rows(drop_unchanged(log), "arrival", "source", "position") == [
        (FAR, 0, 0), (FAR, 5000, 0), (FAR, 5000, 2), (2**63 - 1, 2**31 - 1, 0)]
    assert rows(latest_log(log), "source", "position", "in_count") == [(2**31 - 1, 1, 8)]


def test_rows_are_archived_by_key_or_id(spark, t):
    raw = topic(spark, (1, 7, [1, 2]), (2, 7, [3]))
    streamed = to_log_rows(parse_payloads(raw), "2024-02-01").withColumn("id", F.lit(None).cast("long"))
    numbered = t.log((1, "a", "B1", 4, 0, "2024-01-01"), (2, "a", "B1", 5, 0, "2024-01-01"))
    live = streamed.unionByName(numbered, allowMissingColumns=True)
    archive = live.filter("in_count in (2, 3, 5)")
    assert rows(rows_to_move(live, archive, "2024-02-01"), "in_count") == [(1,), (4,)]
    assert rows(rows_to_delete(live, archive, "2024-02-01"), "in_count") == [(2,), (3,), (5,)]


STATE = T.StructType.fromJson(json.loads(
    '{"type":"struct","fields":[{"name":"device_id","type":"string","nullable":true,"metadata":{}},'
    '{"name":"n","type":"long","nullable":true,"metadata":{}}]}'
))


def devices(spark, n, value=0):
    return spark.range(n).select(F.concat(F.lit("dev-"), "id").alias("device_id"), F.lit(value).cast("long").alias("n"))


def test_a_small_batch_writes_little_whatever_the_size_of_the_state(spark, tmp_path):
    written = []
    for n in (1_000, 40_000):
        path = str(tmp_path / f"state-{n}")
        table = StateTable(path, STATE, bucket_bytes=4_000)
        table.write(devices(spark, n), 0)
        batch = devices(spark, 1, 7)
        touched = table.touched(spark, 1, batch, "device_id")
        assert touched.count() < n / 2
        merged = touched.filter("device_id <> 'dev-0'").unionByName(batch)
        table.write(merged, 1)
        folder = [f for f in files.names(spark, f"{path}/rows") if f.startswith(f"{1:020d}")]
        written.append(sum(files.size(spark, f"{path}/rows/{f}") for f in folder))
        after = table.after(spark, 1)
        assert after.count() == n and rows(after.filter("n > 0")) == [("dev-0", 7)]
        # The version before stays as it was.
        assert table.after(spark, 0).filter("n > 0").count() == 0
    assert written[1] < 2 * written[0]


def test_a_first_state_is_made_by_many_tasks(spark, tmp_path):
    table = StateTable(str(tmp_path / "state"), STATE)
    task = F.udf(lambda _: TaskContext.get().taskAttemptId(), "long")
    table.write(spark.range(0, 800, 1, 8).select(F.concat(F.lit("d"), "id").alias("device_id"), task("id").alias("n")), 0)
    kept = table.after(spark, 0)
    assert kept.count() == 800 and kept.select("n").distinct().count() == 8


def test_buckets_double_and_old_versions_go(spark, tmp_path):
    table = StateTable(str(tmp_path / "state"), STATE, bucket_bytes=2_000)
    for batch in range(4):
        table.write(devices(spark, 4 ** (batch + 2), batch), batch)
        table.write(devices(spark, 3, 99), batch)  # a replay changes nothing
        got = table.after(spark, batch)
        assert got.count() == 4 ** (batch + 2) and rows(got.select("n").distinct()) == [(batch,)]
    assert table._version(spark, 3)["buckets"] > table._version(spark, 0)["buckets"]
    assert table.clean_up(spark, 3) > 0 and table.clean_up(spark, 3) == 0
    assert table.after(spark, 3).count() == 1024 and not table.has(spark, 2)


def test_an_empty_batch_and_a_state_from_a_table(spark, tmp_path):
    table = StateTable(str(tmp_path / "state"), STATE)
    assert table.before(spark, 0).count() == 0
    initial = devices(spark, 5)
    table.write(table.touched(spark, 0, devices(spark, 1), "device_id", initial), 0)
    table.write(table.after(spark, 0).limit(0), 1)
    assert table.after(spark, 1).count() == 5


def log_rows(t, *months, start=0):
    made = [(start + k, f"d{k % 3}", "B1", k, 0, f"2024-{m:02d}-05") for k, m in enumerate(months)]
    return t.log(*made)


@pytest.fixture
def store(tmp_path):
    return LogStore(str(tmp_path / "store"), schemas.LOG)


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_every_reader_sees_each_row_once(spark, t, store, monkeypatch):
    for batch in range(4):
        store.append(log_rows(t, 1, 2, 3, start=batch * 10), batch)
    whole = ids(store.live(spark))
    assert len(whole) == 12 and store.archive(spark).count() == 0
    before = store.snapshot(spark)
    put, seen = files.put_json, []

    def watched(session, path, value):
        # What a reader sees just before each new version, when its folders are written already.
        now = store.snapshot(spark)
        seen.append(ids(log_union(now.live, now.archive)))
        return put(session, path, value)

    with monkeypatch.context() as eye:
        eye.setattr(files, "put_json", watched)
        assert store.archive_before(spark, "2024-03-20") == 8
        assert store.compact(spark, least=2) == 12
    assert seen and all(s == whole for s in seen)
    after = store.snapshot(spark)
    assert ids(log_union(after.live, after.archive)) == whole
    assert ids(after.live) == [2, 12, 22, 32]
    # A reader that has its version goes on with it until the clean-up.
    assert ids(before.live) == whole
    assert store.archive_before(spark, "2024-03-20") == 0 and store.compact(spark, least=2) == 0
    state = store._current(spark)[1]
    assert len(state["live"]) == 1 and len(state["archive"]) == 2
    assert store.clean_up(spark, keep=1) == 12
    assert ids(store.live(spark)) + ids(store.archive(spark)) == sorted(ids(after.live)) + sorted(ids(after.archive))


def test_months_are_pruned_and_null_times_stay(spark, t, store):
    odd = log_rows(t, 1, 2).withColumn("event_time", F.when(F.col("id") == 0, F.col("event_time")))
    store.append(odd)
    store.append(log_rows(t, 1, 2, 3, start=10))
    part = store.snapshot(spark, "2024-02-03", "2024-02-10")
    assert ids(part.live) == [1, 11]
    assert store.archive_before(spark, datetime(2024, 9, 1)) == 4 and ids(store.live(spark)) == [1]


def test_a_numbered_batch_is_added_once(spark, t, store):
    assert store.append(log_rows(t, 1), 0) and not store.append(log_rows(t, 1), 0)
    assert store.append(log_rows(t, 1, start=5), 1) and not store.append(log_rows(t, 1), 0)
    assert ids(store.live(spark)) == [0, 5]


def test_a_writer_that_comes_second_goes_on_from_the_first(spark, t, store, monkeypatch):
    store.append(log_rows(t, 1, 3), 0)
    put, met = files.put_json, []

    def meet(session, path, value):
        if not met:
            met.append(path)
            assert LogStore(store.path, schemas.LOG).append(log_rows(t, 1, start=50), 1)
        return put(session, path, value)

    monkeypatch.setattr(files, "put_json", meet)
    assert store.archive_before(spark, "2024-03-01") == 2  # the folder that the other writer added, too
    assert ids(store.archive(spark)) == [0, 50] and ids(store.live(spark)) == [1]


def test_streamed_rows_in_a_store_read_as_a_log(spark, t, tmp_path):
    path = str(tmp_path / "log")
    streamed = to_log_rows(parse_payloads(topic(spark, (3, 9, [1, 2]))), "2024-02-01")
    streamed = streamed.withColumn("id", F.lit(None).cast("long")).withColumn("ingest_batch", F.lit(4))
    log_store(path).append(with_month(streamed), 4)
    assert rows(read_log(spark, path), "arrival", "source", "position", "in_count", "ingest_batch", "event_time") == [
        (9, 3, 0, 1, 4, at("2024-01-01 08:00")), (9, 3, 1, 2, 4, at("2024-01-01 08:00"))]


def test_a_file_is_put_in_place_once(spark, tmp_path):
    path = str(tmp_path / "a" / "x.json")
    assert files.put_json(spark, path, {"n": "ü"}) and not files.put_json(spark, path, {"n": 2})
    assert files.read_json(spark, path) == {"n": "ü"} and files.names(spark, str(tmp_path / "a")) == ["x.json"]
    assert files.names(spark, str(tmp_path / "none")) == []
