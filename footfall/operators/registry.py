"""Sensor registry: listings, lookup, discovery of new sensors.

A new sensor's id is the next above the highest one given so far. New sensors are dealt to
``ID_PARTS`` parts by their names' digest and numbered part by part, each in order of name, so the
ids are dense, the numbering is spread over tasks, and the same sensors get the same ids however
often a batch is replayed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall import schemas
from footfall.functions.times import ts
from footfall.operators.health import OFFLINE, ONLINE
from footfall.operators.latest import order_of


def device_list(sensors: DataFrame) -> DataFrame:
    return sensors.select("device").orderBy("device")


def location_list(sensors: DataFrame) -> DataFrame:
    return sensors.select("location").distinct().orderBy("location")


def sensor_status(sensors: DataFrame) -> DataFrame:
    """Registry listing: a missing place or address is empty, a missing status Offline."""
    return sensors.select(
        "device",
        F.coalesce("location", F.lit("")).alias("location"),
        "is_online",
        "last_seen",
        F.coalesce("ip_address", F.lit("")).alias("ip_address"),
        F.coalesce("status", F.lit(OFFLINE)).alias("status"),
    )


def sensor_lookup(sensors: DataFrame, device: str) -> DataFrame:
    """The sensor of this name, or no row."""
    found = sensors.filter(F.col("device") == F.lit(device))
    return sensor_status(found)


def reporting_devices(readings: DataFrame) -> DataFrame:
    """Place and address of each device's first reading in arrival order."""
    first = F.min_by(F.struct("location", "ip_address"), order_of(readings, schemas.KEY.fieldNames()))
    return (
        readings.groupBy(F.col("device_id").alias("device"))
        .agg(first.alias("first"))
        .select("device", "first.*")
    )


#: Hexadecimal digits of the digest that deal new sensors to parts, and so the number of parts.
ID_DIGITS = 2
ID_PARTS = 16**ID_DIGITS


def highest_id(sensors: DataFrame) -> int:
    """The highest id given; -1 if there is none."""
    found = sensors.agg(F.max("id")).first()[0]
    return -1 if found is None else found


def new_ids(devices: DataFrame, after: int) -> DataFrame:
    """``device, id`` for distinct ``devices``: dense ids from ``after + 1`` on."""
    dealt = devices.select("device", F.substring(F.md5(F.col("device").cast("binary")), 1, ID_DIGITS).alias("part"))
    sizes = dealt.groupBy("part").count()
    # ID_PARTS rows at most.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    place = F.row_number().over(Window.partitionBy("part").orderBy("device"))
    numbered = dealt.withColumn("place", place).join(F.broadcast(offsets), "part")
    return numbered.select("device", (F.col("offset") + F.col("place") + after).cast("int").alias("id"))


def discover_sensors(readings: DataFrame, sensors: DataFrame, as_of, after: int | None = None) -> DataFrame:
    """Registry rows for devices not known yet, Online and seen now, with ids above ``after`` (by
    default the highest id of ``sensors``)."""
    after = highest_id(sensors) if after is None else after
    unknown = reporting_devices(readings).join(sensors.select("device"), "device", "left_anti")
    return unknown.join(new_ids(unknown, after), "device").select(
        "id",
        "device",
        "location",
        "ip_address",
        F.lit(True).alias("is_online"),
        ts(as_of).alias("last_seen"),
        F.lit(ONLINE).alias("status"),
    )


def register_readings(readings: DataFrame, sensors: DataFrame, as_of, after: int | None = None) -> DataFrame:
    """The registry after a batch: new sensors added, reporting ones Online and seen
    now. The place of a known sensor is never updated. Unchanged readings count
    as reporting, too. New ids are above ``after``, by default the highest of ``sensors``."""
    after = highest_id(sensors) if after is None else after
    found = reporting_devices(readings)
    unknown = found.join(sensors.select("device"), "device", "left_anti")
    found = found.join(new_ids(unknown, after).withColumnRenamed("id", "new_id"), "device", "left")
    reporting = found.select(
        "new_id",
        "device",
        F.col("location").alias("new_location"),
        F.col("ip_address").alias("new_ip"),
        F.lit(True).alias("reports"),
    )
    known = sensors.withColumn("known", F.lit(True))
    merged = known.join(reporting, "device", "full")
    reports = F.coalesce("reports", F.lit(False))
    is_new = F.col("known").isNull()
    return merged.select(
        F.coalesce("id", "new_id").alias("id"),
        "device",
        F.when(is_new, F.col("new_location")).otherwise(F.col("location")).alias("location"),
        F.when(is_new, F.col("new_ip")).otherwise(F.col("ip_address")).alias("ip_address"),
        F.when(reports, F.lit(True)).otherwise(F.col("is_online")).alias("is_online"),
        F.when(reports, ts(as_of)).otherwise(F.col("last_seen")).alias("last_seen"),
        F.when(reports, F.lit(ONLINE)).otherwise(F.col("status")).alias("status"),
    ).select(*schemas.SENSORS.fieldNames())


def role_membership(users: DataFrame, user_roles: DataFrame, roles: DataFrame) -> DataFrame:
    """Active users with their role names, sorted; a user without a role has no row.

    The list of a user is no longer than the role table.
    """
    return (
        users.filter("is_active")
        .join(user_roles, "user_id")
        .join(roles, "role_id")
        .groupBy("user_id", "username")
        .agg(F.sort_array(F.collect_set("role_name")).alias("roles"))
    )
