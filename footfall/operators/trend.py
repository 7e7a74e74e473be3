"""In and out per time bucket, from cumulative counters.

Readings are adjusted by the reset in force at their time, reduced to the
minimum and maximum of each device and bucket, and turned into growth since the
device's previous bucket. Empty buckets are skipped, and negative growth counts
as zero for each device before devices are added up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions.counters import bucket_delta, clamp_zero, with_display
from footfall.functions.times import (
    MICROSECOND,
    SECOND,
    align_range,
    check_bucket,
    floor_to,
    in_event_range,
)
from footfall.operators.asof import DEFAULT_LIMITS, AsofLimits, asof_reset, resets_for_range
from footfall.sources.tables import log_union


def sensor_trend(
    live: DataFrame,
    archive: DataFrame,
    resets: DataFrame,
    device: str | None,
    start,
    end,
    bucket: str = "hour",
    limits: AsofLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """``time, in, out`` of one device; with ``device=None`` of every device, by ``device_id``."""
    _check_name("device", device)
    start, end = align_range(start, end, bucket, SECOND)
    log = log_union(live, archive)
    if device is not None:
        log = log.filter(F.col("device_id") == F.lit(device))
        resets = resets.filter(F.col("device_id") == F.lit(device))
    growth = _growth(log, resets, start, end, bucket, [], limits)
    keys = ["device_id", "time"] if device is None else ["time"]
    return growth.select(*keys, "in", "out").orderBy(*keys)


def location_trend(
    live: DataFrame,
    archive: DataFrame,
    resets: DataFrame,
    location: str | None,
    start,
    end,
    bucket: str = "hour",
    limits: AsofLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """``time, in, out`` of one building; with ``location=None`` of every building, by
    ``location``. Only readings made in the building count."""
    _check_name("location", location)
    start, end = align_range(start, end, bucket, MICROSECOND)
    log = log_union(live, archive)
    if location is not None:
        log = log.filter(F.col("location") == F.lit(location))
    keys = ["location", "time"] if location is None else ["time"]
    growth = _growth(log, resets, start, end, bucket, keys[:-1], limits)
    return (
        growth.groupBy(*keys)
        .agg(F.sum("in").alias("in"), F.sum("out").alias("out"))
        .orderBy(*keys)
    )


def _growth(log, resets, start, end, bucket, extra, limits) -> DataFrame:
    unit = check_bucket(bucket)
    log = in_event_range(log, start, end).select(
        "device_id", *extra, "event_time", "in_count", "out_count"
    )
    adjusted = with_display(
        asof_reset(log, resets_for_range(resets, start, end), limits=limits)
    )
    series = ["device_id", *extra]
    buckets = adjusted.groupBy(*series, floor_to(F.col("event_time"), unit).alias("time")).agg(
        F.max("display_in").alias("peak_in"),
        F.max("display_out").alias("peak_out"),
        F.min("display_in").alias("low_in"),
        F.min("display_out").alias("low_out"),
    )
    # At most one row per device and bucket reaches this window.
    window = Window.partitionBy(*series).orderBy("time")
    before = buckets.withColumns(
        {
            "before_in": F.lag("peak_in").over(window),
            "before_out": F.lag("peak_out").over(window),
        }
    )
    deltas = {
        name: clamp_zero(
            bucket_delta(F.col(f"peak_{name}"), F.col(f"low_{name}"), F.col(f"before_{name}"))
        )
        for name in ("in", "out")
    }
    return before.select(*series, "time", *[delta.alias(name) for name, delta in deltas.items()])


def _check_name(what: str, value: str | None) -> None:
    if value is not None and not value.strip():
        raise ValueError(f"{what} is required")
