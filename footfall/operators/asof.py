"""As-of join: the reset in force at the time of a reading.

There are two plans, chosen by the size of the reset ledger alone; the readings are
not counted.

* A small ledger with few resets per device becomes validity intervals that are
  broadcast, so the log is not shuffled.
* Otherwise resets and readings are shuffled together by device and hour, and each
  reading takes the last reset before it in its hour. Every hour that holds readings of
  a device also gets the reset in force at its start; hours without readings make no rows.
  These seeds are found the same way from days: each day gets the reset in force at its start,
  and a day holds at most 24 hours and its own resets. So the work is linear in readings and
  resets, and the readings of one very active device spread over as many tasks as
  it has hours; nothing depends on adaptive skew handling.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions.times import floor_to, ts
from footfall.operators.latest import latest_by

RESET_COLUMNS = ["reset_time", "reset_in_count", "reset_out_count"]
RESET_ORDER = ("reset_time", "reset_in_count", "reset_out_count")

# Time slice of the shuffled plan; a fixed value.
SLICE = "hour"


@dataclass(frozen=True)
class AsofLimits:
    """When the intervals may be broadcast."""

    # About 50 bytes a row in a hash relation: 100 MB per executor.
    broadcast_rows: int = 2_000_000
    # A reading is compared with all intervals of its device.
    resets_per_device: int = 64


DEFAULT_LIMITS = AsofLimits()


def distinct_resets(resets: DataFrame) -> DataFrame:
    """One reset per device and time; of two at one time, the higher counts."""
    counts = ["reset_in_count", "reset_out_count"]
    return latest_by(resets, ["device_id", "reset_time"], tuple(counts), counts)


def resets_for_range(resets: DataFrame, start, end) -> DataFrame:
    """The resets that readings in ``[start, end]`` can see: those up to one minute
    after ``end`` (a minute bucket looks to its own end), and of those before
    ``start`` only each device's last one."""
    cut = F.col("reset_time") < ts(start)
    before = latest_by(resets.filter(cut), ["device_id"], RESET_ORDER, RESET_COLUMNS)
    within = resets.filter(~cut & (F.col("reset_time") <= ts(end + timedelta(minutes=1))))
    return before.unionByName(within.select("device_id", *RESET_COLUMNS))


def asof_reset(
    probe: DataFrame,
    resets: DataFrame,
    probe_time: str = "event_time",
    inclusive: bool = True,
    limits: AsofLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """Add the newest reset with ``reset_time <= probe_time`` (``<`` if not inclusive).

    Every probe row is kept; the reset columns are null where there is none.
    """
    resets = resets.select("device_id", *RESET_COLUMNS).filter("reset_time is not null")
    per_device = resets.groupBy("device_id").count()
    total, most = per_device.agg(F.sum("count"), F.max("count")).first()
    distinct = distinct_resets(resets)
    if (total or 0) <= limits.broadcast_rows and (most or 0) <= limits.resets_per_device:
        return _interval_join(probe, F.broadcast(_intervals(distinct)), probe_time, inclusive)
    return _sliced(probe, distinct, probe_time, inclusive)


def _last_before(rows: DataFrame, keys: list[str], order: list[str], through=Window.currentRow) -> DataFrame:
    """Add ``_last``, the newest ``_reset`` of a row and those before it."""
    window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, through)
    return rows.withColumn("_last", F.last("_reset", ignorenulls=True).over(window))


def _day_seeds(hours: DataFrame, resets: DataFrame) -> DataFrame:
    """``device_id, _day, _reset``: the reset in force when a day begins that has readings or resets."""
    of_day = resets.groupBy("device_id", "_day").agg(
        F.max_by(F.struct(*RESET_COLUMNS), "reset_time").alias("_reset")
    )
    days = hours.select("device_id", "_day").distinct().unionByName(of_day, allowMissingColumns=True)
    days = days.groupBy("device_id", "_day").agg(F.max("_reset").alias("_reset"))
    before = _last_before(days, ["device_id"], ["_day"], -1)
    return before.filter("_last is not null").select("device_id", "_day", F.col("_last").alias("_reset"))


def hour_seeds(hours: DataFrame, resets: DataFrame) -> DataFrame:
    """``device_id, _slice, _reset``: the reset in force when an hour begins, for those of ``hours``
    (``device_id, _slice``) that have one."""
    hours = hours.withColumn("_day", floor_to(F.col("_slice"), "day"))
    resets = resets.withColumn("_day", floor_to(F.col("reset_time"), "day"))
    # At one time: what the day began with, then the hour, then a reset, which is in the hour itself.
    marks = (
        _day_seeds(hours, resets).withColumns({"_time": F.col("_day"), "_order": F.lit(0)})
        .unionByName(hours.withColumns({"_time": F.col("_slice"), "_order": F.lit(1)}), allowMissingColumns=True)
        .unionByName(
            resets.select("device_id", "_day", F.col("reset_time").alias("_time"),
                          F.struct(*RESET_COLUMNS).alias("_reset"), F.lit(2).alias("_order")),
            allowMissingColumns=True,
        )
    )
    found = _last_before(marks, ["device_id", "_day"], ["_time", "_order"])
    return found.filter("_order = 1 and _last is not null").select(
        "device_id", "_slice", F.col("_last").alias("_reset")
    )


def _sliced(probe: DataFrame, resets: DataFrame, probe_time: str, inclusive: bool) -> DataFrame:
    def of_slice(time) -> Column:
        return floor_to(time, SLICE)

    side = "_probe"
    asked = probe.select(
        "device_id",
        F.col(probe_time).alias("_time"),
        of_slice(F.col(probe_time)).alias("_slice"),
        F.lit(1).alias("_order"),
        F.struct(*probe.columns).alias(side),
    )
    hours = asked.filter("_slice is not null").select("device_id", "_slice").distinct()
    seeds = hour_seeds(hours, resets).withColumns({"_time": F.col("_slice"), "_order": F.lit(-1)})
    # At one time a reset comes first if it is to count for the reading.
    own = resets.select(
        "device_id", F.col("reset_time").alias("_time"), of_slice(F.col("reset_time")).alias("_slice"),
        F.struct(*RESET_COLUMNS).alias("_reset"), F.lit(0 if inclusive else 2).alias("_order"),
    )
    rows = asked.unionByName(seeds, allowMissingColumns=True).unionByName(own, allowMissingColumns=True)
    found = _last_before(rows, ["device_id", "_slice"], ["_time", "_order"])
    return found.filter("_order = 1").select(f"{side}.*", "_last.*")


def _intervals(resets: DataFrame) -> DataFrame:
    """Add ``_until``, the device's next reset (null for the last)."""
    window = Window.partitionBy("device_id").orderBy("reset_time")
    return resets.withColumn("_until", F.lead("reset_time").over(window))


def _interval_join(
    probe: DataFrame, intervals: DataFrame, probe_time: str, inclusive: bool
) -> DataFrame:
    at = F.col(f"p.{probe_time}")
    start, until = F.col("r.reset_time"), F.col("r._until")
    if inclusive:
        on = (start <= at) & (until.isNull() | (at < until))
    else:
        on = (start < at) & (until.isNull() | (at <= until))
    on = (F.col("p.device_id") == F.col("r.device_id")) & on
    return probe.alias("p").join(intervals.alias("r"), on, "left").select(
        "p.*", *[f"r.{name}" for name in RESET_COLUMNS]
    )
