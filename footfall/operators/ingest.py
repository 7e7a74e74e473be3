"""From JSON messages to log rows.

A message is an array of devices, each with an array of readings::

    [{"Device": "dev-1", "Data": [{"Location": "B1", "SubLocation": "F1",
      "Total_IN": 5, "Total_Out": 2, "Capacity": 100, "ipaddr": "10.0.0.1",
      "TimeStamp": "2024-01-01T08:00:00"}]}]

Text that is not such a structure, or has a field of the wrong type, rejects the
whole message. Names are case-sensitive, a missing number is 0, and numbers must
be written as 32-bit integers. Messages are checked row by row, without a shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall import schemas
from footfall.functions.times import ts
from footfall.operators.slices import SLICE, with_previous

# Names in the message; fixed values.
TEXT_FIELDS = ("Location", "SubLocation", "ipaddr", "TimeStamp")
INT_FIELDS = ("Total_IN", "Total_Out", "Capacity")
_COLUMN_OF = dict(zip(INT_FIELDS, ("in_count", "out_count", "capacity")))

BAD_MESSAGE = "bad_message"
BAD_TIMESTAMP = "bad_timestamp"
NULL_DEVICE = "null_device"
NULL_DATA = "null_data"
NULL_ELEMENT = "null_element"
NO_VALID_ROWS = "no_valid_rows"

_FULL_DATE = r"^\s*\d{4}-\d{1,2}-\d{1,2}"


# Objects are read as a whole; their leaves stay VARIANT, to be checked one by one. A
# leaf is SQL null if missing and variant null if JSON null. An element that is not
# an object is read as SQL null, like JSON null.
_DEVICES_TYPE = "array<struct<Device:variant,Data:variant>>"
_READINGS_TYPE = "array<struct<{}>>".format(
    ",".join(f"{name}:variant" for name in (*TEXT_FIELDS, *INT_FIELDS))
)


def _only_objects(elements: Column, source: Column) -> Column:
    """Whether every null among ``elements`` is a JSON null of ``source``, an array."""
    plain = F.try_variant_get(source, "$", "array<variant>")
    same = F.size(F.filter(elements, lambda e: e.isNull())) == F.size(
        F.filter(plain, F.is_variant_null)
    )
    return F.forall(elements, lambda e: e.isNotNull()) | same


def _text_ok(value: Column) -> Column:
    return value.isNull() | F.schema_of_variant(value).isin("STRING", "VOID")


def _int_ok(value: Column) -> Column:
    fits = F.try_variant_get(value, "$", "int").isNotNull()
    return value.isNull() | ((F.schema_of_variant(value) == "BIGINT") & fits)


def _reading_ok(reading: Column) -> Column:
    good = reading.isNull()
    fields = [_text_ok(reading[name]) for name in TEXT_FIELDS]
    fields += [_int_ok(reading[name]) for name in INT_FIELDS]
    return good | reduce(lambda a, b: a & b, fields)


def _with_readings(device: Column) -> Column:
    readings = F.try_variant_get(device["Data"], "$", _READINGS_TYPE)
    return F.when(
        device.isNotNull(),
        F.struct(
            device["Device"].alias("Device"), device["Data"].alias("Data"), readings.alias("readings")
        ),
    )


def _device_ok(device: Column) -> Column:
    data, readings = device["Data"], device["readings"]
    no_data = data.isNull() | F.is_variant_null(data)
    readings_ok = F.forall(readings, _reading_ok) & _only_objects(readings, data)
    return device.isNull() | (
        _text_ok(device["Device"]) & (no_data | F.coalesce(readings_ok, F.lit(False)))
    )


def _event_time(text: Column) -> Column:
    """ISO date and time; an offset is applied, giving UTC."""
    parsed = F.when(text.rlike(_FULL_DATE), F.try_to_timestamp(text))
    return parsed.cast("timestamp_ntz")


def _item(device: Column, reading: Column, reason: Column) -> Column:
    """What is filtered on is read here, once; the rest only for rows that stay."""
    moment = F.try_variant_get(reading["TimeStamp"], "$", "string")
    return F.struct(
        F.try_variant_get(device["Device"], "$", "string").alias("device_id"),
        _event_time(moment).alias("event_time"),
        reading.alias("reading"),
        reason.alias("reason"),
    )


def _judged(item: Column) -> Column:
    """The item with its final reason, and the message's text only if it is rejected."""
    reason = (
        F.when(item["reason"].isNotNull(), item["reason"])
        .when(item["device_id"].isNull(), F.lit(NULL_DEVICE))
        .when(item["event_time"].isNull(), F.lit(BAD_TIMESTAMP))
    )
    return F.struct(
        item["device_id"].alias("device_id"),
        item["event_time"].alias("event_time"),
        item["reading"].alias("reading"),
        reason.alias("reason"),
        F.when(reason.isNotNull(), F.col("value")).alias("raw"),
    )


def _device_items(device: Column) -> Column:
    """One item per reading; an element without readings gives one rejected item."""
    no_reading = F.get(device["readings"], F.lit(-1))
    no_reason = F.lit(None).cast("string")

    def item(reading: Column) -> Column:
        reason = F.when(reading.isNull(), F.lit(NULL_ELEMENT)).otherwise(no_reason)
        return _item(device, reading, reason)

    missing = F.when(device.isNull(), F.lit(NULL_ELEMENT)).otherwise(F.lit(NULL_DATA))
    return F.coalesce(
        F.transform(device["readings"], item), F.array(_item(device, no_reading, missing))
    )


def decode_messages(raw: DataFrame) -> DataFrame:
    """One row per reading of ``raw`` (``arrival, value`` and, if it has parts, ``source``),
    good or rejected.

    ``reason`` is null for a good reading. An empty message, JSON null and an empty
    array give no rows. ``position`` numbers the readings of a message.
    """
    # The parser stops at the end of the first JSON value, so the text is followed by a
    # number of its own: found in second place, nothing else stood after the message.
    seal = F.xxhash64("value")
    sealed = F.try_parse_json(
        F.concat(F.lit("["), "value", F.lit(","), seal.cast("string"), F.lit("]"))
    )
    found = F.when(
        F.try_variant_get("sealed", "$[1]", "bigint") == seal,
        F.try_variant_get("sealed", "$[0]", "variant"),
    )
    source = F.col("source").cast("int") if "source" in raw.columns else F.lit(0)
    messages = (
        raw.filter(F.length("value") > 0)
        .select("arrival", source.alias("source"), "value", sealed.alias("sealed"))
        .select("arrival", "source", "value", found.alias("found"))
        .withColumn("devices", F.try_variant_get("found", "$", _DEVICES_TYPE))
        .withColumn("detailed", F.transform("devices", _with_readings))
    )
    good = F.forall("detailed", _device_ok) & _only_objects(F.col("devices"), F.col("found"))
    good = F.coalesce(good, F.lit(False))
    no_device = F.get("detailed", F.lit(-1))
    no_reading = F.get(no_device["readings"], F.lit(-1))
    rejected = F.array(_item(no_device, no_reading, F.lit(BAD_MESSAGE)))
    items = (
        F.when(F.is_variant_null("found"), F.slice(rejected, 1, 0))
        .when(good, F.flatten(F.transform("detailed", _device_items)))
        .otherwise(rejected)
    )
    # The outer form keeps the optimizer from testing the items before exploding them,
    # which would decode every message twice.
    exploded = messages.select(
        "arrival", "source", F.posexplode_outer(F.transform(items, _judged)).alias("position", "item")
    ).filter("position is not null")

    def text(name: str) -> Column:
        return F.try_variant_get(F.col(f"item.reading.{name}"), "$", "string")

    def whole(name: str) -> Column:
        number = F.try_variant_get(F.col(f"item.reading.{name}"), "$", "int")
        return F.coalesce(number, F.lit(0)).alias(_COLUMN_OF[name])

    no_ip = F.col("item.reading.ipaddr").isNull()
    return exploded.select(
        "arrival",
        "source",
        "position",
        "item.device_id",
        text("Location").alias("location"),
        text("SubLocation").alias("sublocation"),
        *[whole(name) for name in INT_FIELDS],
        F.when(no_ip, F.lit("")).otherwise(text("ipaddr")).alias("ip_address"),
        "item.event_time",
        "item.reason",
        "item.raw",
    )


def parse_payloads(raw: DataFrame) -> DataFrame:
    """The good readings of the messages."""
    return decode_messages(raw).filter("reason is null").drop("reason", "raw")


def payload_rejects(raw: DataFrame) -> DataFrame:
    """What was rejected, why, and the message it came from."""
    return (
        decode_messages(raw)
        .filter("reason is not null")
        .select(*schemas.KEY.fieldNames(), "device_id", "reason", "raw")
    )


def to_log_rows(readings: DataFrame, as_of) -> DataFrame:
    """Readings as log rows that arrive at ``as_of``, told by their key in order of arrival."""
    return readings.select(
        *schemas.KEY.fieldNames(),
        "device_id",
        "location",
        "sublocation",
        "in_count",
        "out_count",
        "capacity",
        "event_time",
        ts(as_of).alias("created_at"),
    )


COUNTS = ["in_count", "out_count"]
EVENT_ORDER = ("event_time", *schemas.ROW_KEY)


def _own(order: tuple[str, ...], df: DataFrame) -> tuple[str, ...]:
    """The columns of an order that a table has: rows have an id, a key, or both."""
    return tuple(name for name in order if name in df.columns)


def drop_unchanged(
    readings: DataFrame,
    prior: DataFrame | None = None,
    order: tuple[str, ...] = EVENT_ORDER,
    unit: str = SLICE,
) -> DataFrame:
    """Drop readings whose counts equal the device's reading before.

    A dropped reading has the counts of the last kept one, so comparing with the
    row before is the same as comparing with the last kept row. ``prior``
    (``device_id, in_count, out_count``) is the state left by earlier batches.
    """
    compared = with_previous(readings, "device_id", list(_own(order, readings)), COUNTS, prior, unit)
    changed = ~F.struct(*COUNTS).eqNullSafe(F.col("previous"))
    return compared.filter(changed).drop("previous")


def last_counts(
    readings: DataFrame, prior: DataFrame, order: tuple[str, ...] = EVENT_ORDER
) -> DataFrame:
    """The state after a batch: each device's last counts, whatever its earlier times."""
    newest = readings.groupBy("device_id").agg(
        F.max_by(F.struct(*COUNTS), F.struct(*_own(order, readings))).alias("last")
    )
    old = prior.select("device_id", F.struct(*COUNTS).alias("old"))
    return (
        newest.join(old, "device_id", "full")
        .withColumn("now", F.coalesce("last", "old"))
        .select("device_id", "now.*")
    )
