"""Raw against displayed counts of one day, by minute."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions.counters import clamp_zero, with_display
from footfall.functions.times import as_datetime, floor_to, on_day
from footfall.operators.asof import DEFAULT_LIMITS, AsofLimits, asof_reset, resets_for_range
from footfall.sources.tables import log_union, optional_filters


def daily_comparison(
    live: DataFrame,
    archive: DataFrame,
    resets: DataFrame,
    day,
    building: str | None = None,
    device: str | None = None,
    limits: AsofLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """Highest counts of each device, place and minute, raw and adjusted.

    The maximum is taken first and adjusted afterwards, by the last reset before
    the end of the minute. ``raw_inside`` is never negative; ``display_inside``
    may be. A blank filter counts as not given, and one filter is required.
    """
    building = building if building and building.strip() else None
    device = device if device and device.strip() else None
    if building is None and device is None:
        raise ValueError("either building or device is required")

    log = on_day(log_union(live, archive), day)
    log = optional_filters(log, location=building, device_id=device)
    resets = optional_filters(resets, device_id=device)
    minutes = log.groupBy(
        "device_id",
        "location",
        "sublocation",
        floor_to(F.col("event_time"), "minute").alias("bucket_time"),
    ).agg(F.max("in_count").alias("raw_in"), F.max("out_count").alias("raw_out"))
    minutes = minutes.withColumn(
        "minute_end", F.col("bucket_time") + F.expr("interval '1' minute")
    )

    first = floor_day(day)
    seen = resets_for_range(resets, first, first + timedelta(days=1))
    joined = asof_reset(minutes, seen, "minute_end", inclusive=False, limits=limits)
    return (
        with_display(joined, "raw_in", "raw_out")
        .select(
            "device_id",
            "location",
            "sublocation",
            "bucket_time",
            "raw_in",
            "raw_out",
            clamp_zero(F.col("raw_in") - F.col("raw_out")).alias("raw_inside"),
            "display_in",
            "display_out",
            (F.col("display_in") - F.col("display_out")).alias("display_inside"),
        )
        .orderBy("device_id", "bucket_time")
    )


def floor_day(day):
    moment = as_datetime(day)
    return moment.replace(hour=0, minute=0, second=0, microsecond=0)
