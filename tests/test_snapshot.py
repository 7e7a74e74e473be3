from __future__ import annotations

from footfall.functions.counters import display_count
from footfall.operators.latest import latest_reset
from footfall.operators.ledger import reset_building, reset_devices
from footfall.operators.snapshot import (
    building_devices,
    building_summary,
    device_building,
    latest_devices,
)
from pyspark.sql import functions as F
from tests.conftest import at, rows

NOW = "2024-02-10"


def test_display_count(spark):
    df = spark.createDataFrame([(5, None), (5, 7), (5, 5), (9, 4)], "c int, r int")
    assert rows(df, "c", "r", display_count(F.col("c"), F.col("r"))) == [
        (5, 5, 0), (5, 7, 5), (5, None, 5), (9, 4, 5)]


def test_moved_device_shows_in_both_building_lists_but_counts_once(t):
    log = t.log(
        (1, "a", "B1", 10, 1, "2024-02-01"),
        (2, "a", "B2", 20, 2, "2024-02-02"),
    )
    none = t.resets()
    assert rows(building_summary(log, none, NOW)) == [("B2", 20, 2, 18)]
    assert rows(building_devices(log, none, "B1", NOW), "device_id", "display_in") == [("a", 10)]
    assert rows(building_devices(log, none, "B2", NOW), "device_id", "inside") == [("a", 18)]


def test_newest_is_by_arrival_then_id_but_resets_take_event_time(t):
    log = t.log(
        (1, "a", "B1", 30, 0, "2024-02-03", "2024-02-03"),
        (2, "a", "B1", 20, 0, "2024-02-02", "2024-02-04"),
        (3, "a", "B1", 25, 0, "2024-02-01", "2024-02-04"),
    )
    assert rows(latest_devices(log, t.resets(), ["a"], NOW), "display_in") == [(25,)]
    assert rows(reset_devices(log, ["a"], NOW), "reset_in_count") == [(30,)]


def test_snapshot_uses_the_newest_reset_even_if_later_than_the_reading(t):
    log = t.log((1, "a", "B1", 10, 4, "2024-02-01"))
    resets = t.resets(("a", "2024-01-01", 1, 1), ("a", "2024-02-05", 8, 9))
    assert rows(building_summary(log, resets, NOW)) == [("B1", 2, 4, -2)]


def test_tied_resets_take_the_higher_counts(t):
    resets = t.resets(("a", "2024-02-05", 8, 1), ("a", "2024-02-05", 9, 0))
    assert rows(latest_reset(resets), "reset_in_count", "reset_out_count") == [(9, 0)]


def test_look_back_includes_its_limit_and_has_no_upper_bound(t):
    log = t.log(
        (1, "a", "B1", 1, 0, "2024-01-11"),
        (2, "b", "B1", 2, 0, "2024-01-10 23:59:59.999999"),
        (3, "c", "B1", 4, 0, "2024-03-01"),
    )
    assert rows(building_summary(log, t.resets(), NOW)) == [("B1", 5, 0, 5)]


def test_null_location_is_a_group(t):
    log = t.log((1, "a", None, 1, 0, "2024-02-01"), (2, "b", None, 2, 0, "2024-02-01"))
    assert rows(building_summary(log, t.resets(), NOW)) == [(None, 3, 0, 3)]
    assert rows(device_building(log, ["a"])) == []


def test_ids_as_list_frame_and_empty(t, spark):
    log = t.log((1, "a", "B1", 1, 0, "2024-02-01"), (2, "b", "B1", 2, 0, "2024-02-01"))
    frame = spark.createDataFrame([("b",), ("b",), ("x",)], "anything string")
    assert rows(latest_devices(log, t.resets(), frame, NOW), "device_id") == [("b",)]
    assert rows(latest_devices(log, t.resets(), [], NOW)) == []
    assert rows(device_building(log, ["a", "x"])) == [("a", "B1")]


def test_reset_of_unknown_device_gives_no_row(t):
    assert rows(reset_devices(t.log((1, "a", "B1", 1, 0, "2024-02-01")), ["x"], NOW)) == []


def test_building_reset_covers_devices_that_left_with_counts_from_anywhere(t):
    log = t.log(
        (1, "a", "B1", 1, 0, "2024-02-01"),
        (2, "a", "B2", 7, 3, "2024-02-02"),
        (3, "b", "B2", 9, 9, "2024-02-02"),
        (4, "c", None, 9, 9, "2024-02-02"),
    )
    assert rows(reset_building(log, "B1", NOW)) == [("a", at(NOW), 7, 3)]
    assert rows(reset_building(log, "B9", NOW)) == []
