"""Sensor health from the age of the last data and from reachability.

Unchanged readings never reach the log, so a sensor with a steady count turns
Idle or Offline after the recency window although it still reports.
"""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions.times import as_datetime, ts

ONLINE, IDLE, OFFLINE = "Online", "Idle", "Offline"


def last_data_time(log: DataFrame) -> DataFrame:
    """Newest arrival of each device in the live log."""
    return log.groupBy("device_id").agg(F.max("created_at").alias("last_data_time"))


def recent_activity(log: DataFrame, sensors: DataFrame, as_of, minutes: int = 2) -> DataFrame:
    """Whether each sensor delivered data in the last ``minutes``; there is no upper bound.

    Only recent rows are read: the filter reaches the scan of the log.
    """
    cut = ts(as_datetime(as_of) - timedelta(minutes=minutes))
    recent = log.filter(F.col("created_at") >= cut).select("device_id").distinct()
    active = recent.withColumn("active", F.lit(True))
    return (
        sensors.select(F.col("device").alias("device_id"))
        .join(active, "device_id", "left")
        .select("device_id", F.coalesce("active", F.lit(False)).alias("is_active"))
    )


def has_address(ip):
    return F.trim(F.coalesce(ip, F.lit(""))) != ""


def merged_recency(*parts: DataFrame) -> DataFrame:
    """``device_id, last_data_time`` from several such tables, as a kept one and that of a log's tail."""
    whole = reduce(lambda a, b: a.unionByName(b), parts)
    return whole.groupBy("device_id").agg(F.max("last_data_time").alias("last_data_time"))


def sensor_health(
    sensors: DataFrame, log: DataFrame, probes: DataFrame, as_of, minutes: int = 5
) -> DataFrame:
    """``device, status, last_data_time`` of every sensor, from the whole live log.

    Recent data means Online; else a reachable sensor with an address is Idle,
    any other Offline. ``probes`` holds ``device, reachable``.
    """
    return health_by_recency(sensors, last_data_time(log), probes, as_of, minutes)


def health_by_recency(
    sensors: DataFrame, recency: DataFrame, probes: DataFrame, as_of, minutes: int = 5
) -> DataFrame:
    """The same from a kept table of each device's newest arrival (``device_id, last_data_time``)."""
    cut = ts(as_datetime(as_of) - timedelta(minutes=minutes))
    data = recency.withColumnRenamed("device_id", "device")
    reachable = probes.groupBy("device").agg(F.bool_or("reachable").alias("reachable"))
    status = (
        F.when(F.col("last_data_time") >= cut, F.lit(ONLINE))
        .when(has_address(F.col("ip_address")) & F.col("reachable"), F.lit(IDLE))
        .otherwise(F.lit(OFFLINE))
    )
    return (
        sensors.select("device", "ip_address")
        .join(data, "device", "left")
        .join(reachable, "device", "left")
        .select("device", status.alias("status"), "last_data_time")
    )


def health_summary(health: DataFrame) -> DataFrame:
    """Sensors per status, and all."""
    return health.agg(
        *[F.count_if(F.col("status") == s).alias(s.lower()) for s in (ONLINE, IDLE, OFFLINE)],
        F.count("*").alias("total"),
    )


def latest_status(sensors: DataFrame, checks: DataFrame) -> DataFrame:
    """One registry for discovery and health: of what a batch and a check (``device, status,
    last_data_time, checked_at``) say of a sensor, the later holds. A batch says so by the time it last saw
    the sensor."""
    found = checks.select("device", F.col("status").alias("new_status"), "last_data_time", "checked_at")
    later = F.col("checked_at").isNotNull() & F.coalesce(F.col("checked_at") > F.col("last_seen"), F.lit(True))
    return sensors.join(found, "device", "left").select(
        "id",
        "device",
        "location",
        "ip_address",
        F.when(later, F.col("new_status") == ONLINE).otherwise(F.col("is_online")).alias("is_online"),
        F.when(later, F.coalesce("last_data_time", "last_seen")).otherwise(F.col("last_seen")).alias("last_seen"),
        F.when(later, F.col("new_status")).otherwise(F.col("status")).alias("status"),
    )


def apply_status(sensors: DataFrame, health: DataFrame) -> DataFrame:
    """The registry after a health check: new status and online flag; last seen
    only where the check found data. Sensors not checked stay as they are."""
    found = health.select(
        "device", F.col("status").alias("new_status"), "last_data_time"
    )
    checked = F.col("new_status").isNotNull()
    return sensors.join(found, "device", "left").select(
        "id",
        "device",
        "location",
        "ip_address",
        F.when(checked, F.col("new_status") == ONLINE).otherwise(F.col("is_online")).alias("is_online"),
        F.coalesce("last_data_time", "last_seen").alias("last_seen"),
        F.coalesce("new_status", "status").alias("status"),
    )
