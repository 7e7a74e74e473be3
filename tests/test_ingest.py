from __future__ import annotations

import json

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from footfall.operators.ingest import (
    decode_messages,
    drop_unchanged,
    last_counts,
    parse_payloads,
    payload_rejects,
    to_log_rows,
)
from footfall.operators.slices import slice_unit, with_previous
from tests.conftest import at, rows

GOOD = {"Location": "B1", "SubLocation": "F1", "Total_IN": 5, "Total_Out": 2, "Capacity": 9,
        "ipaddr": "10.0.0.1", "TimeStamp": "2024-01-01T08:00:00"}


def message(*readings, device="a"):
    return json.dumps([{"Device": device, "Data": list(readings)}])


def changed(**fields):
    return {**GOOD, **fields}


def without(name):
    return {k: v for k, v in GOOD.items() if k != name}


@pytest.mark.parametrize(
    "value",
    ["not json", " ", '{"Device":"a"}', "[1]", "[] x", "[]]", "[1] [2]", '[], "x": 1', "[]}", "[]} {]",
     '[{"Device":7,"Data":[]}]', '[{"Device":"a","Data":{}}]', '[{"Device":"a","Data":[5]}]',
     "[{'Device':'a'}]", '[{"Device":"a",}]',
     message(changed(Total_IN="7")), message(changed(Total_Out=1.0)), message(changed(Capacity=None)),
     message(changed(Total_IN=3_000_000_000)), message(changed(Total_IN=10**25)),
     message(changed(Total_IN=1e2)), message(changed(Location=3)), message(changed(TimeStamp=5)),
     message(GOOD, changed(Total_IN=True))],
)
def test_a_bad_message_is_rejected_whole(t, value):
    raw = t.messages(value, message(GOOD))
    assert rows(payload_rejects(raw), "arrival", "reason", "raw") == [(0, "bad_message", value)]
    assert rows(parse_payloads(raw), "arrival") == [(1,)]


@pytest.mark.parametrize("value", ["", "[]", " [ ] ", "null", '[{"Device":"a","Data":[]}]', None])
def test_an_empty_message_gives_nothing(t, value):
    assert rows(decode_messages(t.messages(value))) == []


def test_a_bad_element_is_rejected_alone(t):
    value = json.dumps([
        None,
        {"Device": "a", "Data": [None, GOOD, changed(TimeStamp="soon"), changed(TimeStamp=""),
                                 changed(TimeStamp=None), without("TimeStamp")]},
        {"Device": None, "Data": [GOOD]},
        {"Data": [GOOD]},
        {"Device": "b", "Data": None},
        {"Device": "c"},
        {"device": "d", "Data": [GOOD]},
    ])
    raw = t.messages(value)
    assert rows(parse_payloads(raw), "position", "device_id") == [(2, "a")]
    assert rows(payload_rejects(raw), "position", "reason") == [
        (0, "null_element"), (1, "null_element"), (3, "bad_timestamp"), (4, "bad_timestamp"),
        (5, "bad_timestamp"), (6, "bad_timestamp"), (7, "null_device"), (8, "null_device"),
        (9, "null_data"), (10, "null_data"), (11, "null_device")]


def test_defaults_and_names(t):
    raw = t.messages(
        message({"TimeStamp": "2024-01-01"}),
        message(changed(ipaddr=None, Location=None, total_in=7, Total_IN=-3)),
        '[{"Device":"x","Device":"y","Data":[{"TimeStamp":"2024-01-01"}]}]',
    )
    columns = ["device_id", "location", "in_count", "out_count", "capacity", "ip_address"]
    assert rows(parse_payloads(raw), *columns) == [
        ("a", None, -3, 2, 9, None), ("a", None, 0, 0, 0, ""), ("y", None, 0, 0, 0, "")]


@pytest.mark.parametrize(
    "text, expected",
    [("2024-01-05 10:11:12.5", "2024-01-05 10:11:12.5"), ("2024-01-05", "2024-01-05"),
     ("2024-01-05T10:11:12Z", "2024-01-05 10:11:12"),
     ("2024-01-05T10:11:12+05:00", "2024-01-05 05:11:12"), ("2024", None), ("10:11", None),
     ("T10:11", None), ("2024-13-01", None)],
)
def test_timestamps(t, text, expected):
    got = rows(decode_messages(t.messages(message(changed(TimeStamp=text)))), "event_time")
    assert got == [(expected and at(expected),)]


def test_ids_follow_arrival(t):
    raw = t.messages(message(GOOD, GOOD), message(GOOD))
    log = to_log_rows(parse_payloads(raw), "2024-02-01")
    assert rows(log, "arrival", "source", "position") == [(0, 0, 0), (0, 0, 1), (1, 0, 0)]


LOG = [
    (1, "a", "B1", 1, 0, "2024-01-01 08:00:00"),
    (2, "a", "B2", 1, 0, "2024-01-01 09:00:00"),
    (3, "a", "B1", 2, 0, "2024-01-03 10:00:00"),
    (4, "a", "B1", 1, 0, "2024-01-03 10:00:00"),
    (5, "a", "B1", 1, 0, "2024-01-05 10:00:00"),
    (6, "b", "B1", 1, 0, "2024-01-01 08:00:00"),
]


@pytest.mark.parametrize("unit", ["second", "hour", "day"])
def test_unchanged_readings_are_dropped_in_event_order(t, spark, unit):
    log = t.log(*LOG)
    assert rows(drop_unchanged(log, unit=unit), "id") == [(1,), (3,), (4,), (6,)]
    prior = spark.createDataFrame([("a", 1, 0), ("z", 4, 4)], "device_id string, in_count int, out_count int")
    kept = drop_unchanged(log, prior, unit=unit)
    assert rows(kept, "id") == [(3,), (4,), (6,)]
    assert kept.columns == log.columns
    assert rows(last_counts(log, prior)) == [("a", 1, 0), ("b", 1, 0), ("z", 4, 4)]


def test_slices_split_one_busy_device_and_agree_with_one_window(spark):
    log = spark.sql(
        """SELECT id, if(id % 3 = 0, concat('d', id % 5), 'hot') AS device_id,
            cast(id * 7 % 4 AS int) AS in_count, cast(0 AS int) AS out_count,
            timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, cast(id * 31 % 6000 AS int)) AS event_time
        FROM range(3000)"""
    )
    assert slice_unit(log, "device_id", "event_time") is None
    assert slice_unit(log, "device_id", "event_time", 600) == "day"
    assert slice_unit(log, "device_id", "event_time", 50) == "hour"
    order, columns = ["event_time", "id"], ["in_count", "out_count"]
    window = Window.partitionBy("device_id").orderBy(*order)
    whole = rows(log.withColumn("previous", F.lag(F.struct(*columns)).over(window)), "id", "previous")
    for unit in ("second", "minute", "hour", "day"):
        assert rows(with_previous(log, "device_id", order, columns, unit=unit), "id", "previous") == whole
    instant = log.withColumn("event_time", F.lit("2024-01-01").cast("timestamp_ntz"))
    whole = rows(instant.withColumn("previous", F.lag(F.struct(*columns)).over(window)), "id", "previous")
    assert rows(with_previous(instant, "device_id", order, columns), "id", "previous") == whole


@pytest.mark.parametrize("text", ["null", " null", "null\n", "\tnull \r\n"])
def test_a_json_null_is_ignored_whatever_white_space_is_around_it(t, text):
    assert decode_messages(t.messages(text)).count() == 0


def test_only_rejected_readings_carry_the_text_of_their_message(t):
    good, bad = '{"Total_IN": 1, "TimeStamp": "2024-01-01T08:00:00"}', '{"Total_IN": 1, "TimeStamp": "x"}'
    raw = t.messages(f'[{{"Device": "a", "Data": [{good}, {bad}]}}]')
    assert rows(decode_messages(raw).selectExpr("reason", "raw is not null as kept")) == [
        ("bad_timestamp", True), (None, False)]
