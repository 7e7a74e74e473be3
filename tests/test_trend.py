from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from footfall.functions.times import MICROSECOND, SECOND, align_range
from footfall.operators.asof import AsofLimits, asof_reset, hour_seeds
from footfall.operators.compare import daily_comparison
from footfall.operators.trend import location_trend, sensor_trend
from tests.conftest import at, in_order, rows

# Intervals broadcast; many resets per device; a large ledger.
LIMITS = [AsofLimits(), AsofLimits(2_000_000, 1), AsofLimits(0, 100)]


@pytest.mark.parametrize("limits", LIMITS)
def test_asof_includes_the_exact_time_and_strict_does_not(t, limits):
    log = t.log(
        (1, "a", "B1", 9, 9, "2024-01-01 08:00:00"),
        (2, "a", "B1", 9, 9, "2024-01-01 07:59:59"),
        (3, "a", "B1", 9, 9, "2024-02-03 00:00:00"),
        (4, "b", "B1", 9, 9, "2024-01-01 08:00:00"),
        (5, "c", "B1", 9, 9, "2024-01-02 08:00:00"),
    )
    resets = t.resets(
        ("a", "2024-01-01 08:00:00", 1, 1),
        ("a", "2024-01-01 08:00:00", 2, 0),
        ("a", "2024-01-01 07:00:00", 5, 5),
        ("a", "2024-01-03 07:00:00", 6, 6),
        ("c", "2024-01-03 07:00:00", 7, 7),
    )
    inclusive = asof_reset(log, resets, limits=limits)
    assert rows(inclusive, "id", "reset_in_count") == [(1, 2), (2, 5), (3, 6), (4, None), (5, None)]
    strict = asof_reset(log, resets, inclusive=False, limits=limits)
    assert rows(strict, "id", "reset_in_count") == [(1, 5), (2, 5), (3, 6), (4, None), (5, None)]
    assert inclusive.columns == log.columns + ["reset_time", "reset_in_count", "reset_out_count"]


@pytest.mark.parametrize("limits", LIMITS[1:])
def test_asof_plans_agree_on_one_very_busy_device(spark, t, limits):
    log = spark.sql(
        """SELECT id, if(id % 3 = 0, concat('d', id % 7), 'hot') AS device_id,
            timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id * 37 % 5000) AS event_time
        FROM range(3000)"""
    )
    resets = spark.sql(
        """SELECT if(id % 4 = 0, concat('d', id % 7), 'hot') AS device_id,
            timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id * 53 % 5000) AS reset_time,
            cast(id AS int) AS reset_in_count, cast(id AS int) AS reset_out_count
        FROM range(600)"""
    )
    plain = rows(asof_reset(log, resets), "id", "reset_time", "reset_in_count")
    assert rows(asof_reset(log, resets, limits=limits), "id", "reset_time", "reset_in_count") == plain
    assert len(plain) == 3000


def trend(t, log, bucket="hour", resets=(), start="2024-01-01", end="2024-01-31"):
    live, archive = t.log(*log), t.log()
    return rows(sensor_trend(live, archive, t.resets(*resets), "a", start, end, bucket))


def test_first_bucket_counts_its_own_growth_and_gaps_are_skipped(t):
    log = [
        (1, "a", "B1", 10, 5, "2024-01-01 08:00:00"),
        (2, "a", "B1", 14, 6, "2024-01-01 08:30:00"),
        (3, "a", "B1", 20, 6, "2024-01-01 11:00:00"),
        (4, "b", "B1", 99, 99, "2024-01-01 11:00:00"),
    ]
    assert trend(t, log) == [(at("2024-01-01 08:00"), 4, 1), (at("2024-01-01 11:00"), 6, 0)]


def test_one_reading_gives_a_zero(t):
    assert trend(t, [(1, "a", "B1", 10, 5, "2024-01-01 08:00:00")]) == [(at("2024-01-01 08:00"), 0, 0)]


def test_reset_inside_a_bucket_loses_what_follows(t):
    log = [
        (1, "a", "B1", 10, 0, "2024-01-01 08:00:00"),
        (2, "a", "B1", 50, 0, "2024-01-01 09:10:00"),
        (3, "a", "B1", 58, 0, "2024-01-01 09:50:00"),
        (4, "a", "B1", 61, 0, "2024-01-01 10:10:00"),
    ]
    assert trend(t, log, resets=[("a", "2024-01-01 09:20:00", 50, 0)]) == [
        (at("2024-01-01 08:00"), 0, 0),
        (at("2024-01-01 09:00"), 40, 0),
        (at("2024-01-01 10:00"), 0, 0),
    ]


def test_archive_counts_and_range_ends_a_second_early(t):
    live = t.log(
        (2, "a", "B1", 20, 0, "2024-01-02 23:59:59"),
        (3, "a", "B1", 90, 0, "2024-01-02 23:59:59.500000"),
    )
    archive = t.log((1, "a", "B1", 5, 0, "2024-01-01 00:00:00"))
    out = sensor_trend(live, archive, t.resets(), "a", "2024-01-01 12:00", "2024-01-02", "DAY")
    assert rows(out) == [(at("2024-01-01"), 0, 0), (at("2024-01-02"), 15, 0)]
    place = location_trend(live, archive, t.resets(), "B1", "2024-01-01 12:00", "2024-01-02", "day")
    assert rows(place) == [(at("2024-01-01"), 0, 0), (at("2024-01-02"), 85, 0)]


def test_location_adds_clamped_growth_of_devices(t):
    log = t.log(
        (1, "a", "B1", 10, 0, "2024-01-01 08:00:00"),
        (2, "b", "B1", 10, 0, "2024-01-01 08:00:00"),
        (3, "a", "B1", 4, 0, "2024-01-01 09:00:00"),
        (4, "b", "B1", 15, 0, "2024-01-01 09:00:00"),
        (5, "b", "B2", 95, 0, "2024-01-01 09:00:00"),
    )
    out = location_trend(log, t.log(), t.resets(), "B1", "2024-01-01", "2024-01-02")
    assert rows(out) == [(at("2024-01-01 08:00"), 0, 0), (at("2024-01-01 09:00"), 5, 0)]


def test_device_and_location_trend_agree_where_a_building_has_one_device(t):
    log = [(n, "a", "B1", n * 3 % 40, n * 5 % 30, f"2024-01-{1 + n % 9:02d} {n % 24:02d}:00:00") for n in range(60)]
    resets = [("a", "2024-01-03 05:00:00", 9, 9), ("a", "2024-01-06", 20, 2)]
    for bucket in ("hour", "day", "month"):
        place = location_trend(t.log(*log), t.log(), t.resets(*resets), "B1", "2024-01-01", "2024-01-31", bucket)
        assert trend(t, log, bucket, resets) == rows(place)


def test_align_range():
    start, end = "2024-02-10 10:30", "2024-02-11 05:00"
    assert align_range(start, end, "hour") == (datetime(2024, 2, 10, 10, 30), datetime(2024, 2, 11, 5))
    assert align_range(start, end, "day") == (
        datetime(2024, 2, 10), datetime(2024, 2, 11, 23, 59, 59))
    assert align_range(start, "2024-12-31", "month", MICROSECOND) == (
        datetime(2024, 2, 1), datetime(2024, 12, 31, 23, 59, 59, 999999))
    assert align_range(start, end, "Month", SECOND)[1] == datetime(2024, 2, 29, 23, 59, 59)


def test_bad_arguments(t):
    log, resets = t.log(), t.resets()
    for args in (("a", "2024-01-02", "2024-01-01"), ("a", None, "2024-01-01"), (" ", "2024-01-01", "2024-01-02"),
                 ("a", "2024-01-01", "2024-01-02", "week")):
        with pytest.raises(ValueError):
            sensor_trend(log, log, resets, *args)
    with pytest.raises(ValueError):
        daily_comparison(log, log, resets, "2024-01-01", " ", None)


def test_daily_comparison(t):
    log = t.log(
        (1, "a", "B1", 10, 12, "2024-01-15 08:00:10", "2024-01-15", "F1"),
        (2, "a", "B1", 14, 11, "2024-01-15 08:00:50", "2024-01-15", "F1"),
        (3, "a", "B1", 14, 11, "2024-01-15 08:00:55", "2024-01-15"),
        (4, "a", "B1", 20, 20, "2024-01-15 08:01:00"),
        (5, "a", "B1", 99, 99, "2024-01-16 00:00:00"),
    )
    archive = t.log((6, "a", "B1", 3, 9, "2024-01-15 23:59:30"))
    # Exactly at the end of minute 08:00, so it is not in force before 08:01.
    resets = t.resets(("a", "2024-01-15 08:01:00", 15, 18), ("a", "2024-01-15 08:00:30", 4, 20))
    out = daily_comparison(log, archive, resets, "2024-01-15", "B1", "")
    assert rows(out.drop("device_id", "location")) == in_order([
        ("F1", at("2024-01-15 08:00"), 14, 12, 2, 10, 12, -2),
        (None, at("2024-01-15 08:00"), 14, 11, 3, 10, 11, -1),
        (None, at("2024-01-15 08:01"), 20, 20, 0, 5, 2, 3),
        (None, at("2024-01-15 23:59"), 3, 9, 0, 3, 9, -6),
    ])
    assert rows(daily_comparison(log, archive, resets, "2024-01-15", "B2", "a")) == []


def test_last_minute_of_the_day_sees_a_reset_within_it(t):
    log = t.log((1, "a", "B1", 10, 0, "2024-01-15 23:59:10"))
    resets = t.resets(("a", "2024-01-15 23:59:50", 4, 0))
    out = daily_comparison(log, t.log(), resets, datetime(2024, 1, 15), device="a")
    assert rows(out, "display_in") == [(6,)]


def test_month_folders_are_pruned(spark, t, tmp_path):
    from footfall.sources.tables import read_log, write_log

    path = str(tmp_path / "log")
    write_log(t.log((1, "a", "B1", 1, 0, "2024-01-05"), (2, "a", "B1", 2, 0, "2024-03-05")), path)
    log = read_log(spark, path)
    out = sensor_trend(log, log.limit(0), t.resets(), "a", "2024-03-01", "2024-03-31", "day")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_month" in plan and "PushedFilters: [IsNotNull(" in plan
    assert rows(out) == [(at("2024-03-05"), 0, 0)]


def test_large_ledgers_are_joined_by_device_and_hour(spark, t):
    """The readings of one device are dealt out by hour; nothing is broadcast."""
    log = t.log(*[(k, "hot", "B1", k, k, f"2024-01-01 {k % 24:02d}:30:00") for k in range(48)])
    resets = t.resets(("hot", "2024-01-01 03:00:00", 1, 1), ("hot", "2024-01-01 09:45:00", 2, 2))
    joined = asof_reset(log, resets, limits=AsofLimits(0))
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    physical = joined._jdf.queryExecution().sparkPlan().toString()
    assert "_slice" in plan and "ResolvedHint" not in plan and "hint=(strategy=broadcast)" not in plan
    assert "Window" in physical and "device_id" in physical
    counts = dict(rows(joined, "id", "reset_in_count"))
    assert [counts[k] for k in (2, 3, 9, 10, 26, 34)] == [None, 1, 1, 2, None, 2]


def test_hours_without_readings_make_no_rows(spark, t):
    """A hundred devices that report twice in a year, with resets between: two seeds each at most."""
    log = spark.sql(
        """SELECT id, concat('d', id % 100) AS device_id,
            timestamp_ntz'2024-01-01' + make_dt_interval(if(id < 100, 1, 364), cast(id % 24 AS int)) AS event_time
        FROM range(200)"""
    )
    resets = spark.sql(
        """SELECT concat('d', id % 100) AS device_id, timestamp_ntz'2024-01-01' + make_dt_interval(cast(id AS int)) AS reset_time,
            cast(id AS int) AS reset_in_count, 0 AS reset_out_count FROM range(300)"""
    )
    hours = log.select("device_id", F.date_trunc("hour", "event_time").cast("timestamp_ntz").alias("_slice")).distinct()
    seeds = hour_seeds(hours, resets)
    assert 100 <= seeds.count() <= 200
    joined = asof_reset(log, resets, limits=AsofLimits(0))
    assert "sequence(" not in joined._jdf.queryExecution().optimizedPlan().toString().lower()
    plain = rows(asof_reset(log, resets), "id", "reset_time", "reset_in_count")
    assert rows(joined, "id", "reset_time", "reset_in_count") == plain


def test_seeds_at_the_edges_of_hours_and_days(t):
    """Readings and resets at the very start of hours and days, and a null time."""
    log = t.log(*[
        (1, "a", "B1", 1, 0, "2024-01-02 00:00:00"), (2, "a", "B1", 1, 0, "2024-01-02 05:00:00"),
        (3, "a", "B1", 1, 0, "2024-01-02 05:30:00"), (4, "a", "B1", 1, 0, "2024-01-05 23:59:59"),
        (5, "b", "B1", 1, 0, "2024-01-02 05:00:00"),
    ])
    log = log.unionByName(log.limit(1).withColumns({"id": F.lit(9).cast("long"), "event_time": F.lit(None).cast("timestamp_ntz")}))
    resets = t.resets(
        ("a", "2024-01-01 23:59:59", 1, 0), ("a", "2024-01-02 00:00:00", 2, 0), ("a", "2024-01-02 05:00:00", 3, 0),
        ("a", "2024-01-03 00:00:00", 4, 0), ("a", "2024-01-06 00:00:00", 5, 0),
    )
    far = AsofLimits(0)
    assert rows(asof_reset(log, resets, limits=far), "id", "reset_in_count") == [
        (1, 2), (2, 3), (3, 3), (4, 4), (5, None), (9, None)]
    assert rows(asof_reset(log, resets, inclusive=False, limits=far), "id", "reset_in_count") == [
        (1, 1), (2, 2), (3, 3), (4, 4), (5, None), (9, None)]
