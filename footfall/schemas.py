"""Schemas of the tables. All times are wall clock times without a zone."""

from __future__ import annotations

from pyspark.sql import types as T

LOG = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("device_id", T.StringType(), False),
        T.StructField("location", T.StringType()),
        T.StructField("sublocation", T.StringType()),
        T.StructField("in_count", T.IntegerType()),
        T.StructField("out_count", T.IntegerType()),
        T.StructField("capacity", T.IntegerType()),
        T.StructField("event_time", T.TimestampNTZType()),
        T.StructField("created_at", T.TimestampNTZType()),
    ]
)

RESETS = T.StructType(
    [
        T.StructField("device_id", T.StringType()),
        T.StructField("reset_time", T.TimestampNTZType()),
        T.StructField("reset_in_count", T.IntegerType()),
        T.StructField("reset_out_count", T.IntegerType()),
    ]
)

SENSORS = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("device", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("ip_address", T.StringType()),
        T.StructField("is_online", T.BooleanType()),
        T.StructField("last_seen", T.TimestampNTZType()),
        T.StructField("status", T.StringType()),
    ]
)

PROBES = T.StructType(
    [
        T.StructField("device", T.StringType()),
        T.StructField("reachable", T.BooleanType()),
    ]
)

# What tells a reading that came as a message, in order of arrival: the source's own increasing
# number of the message (offset, sequence), the part of the source that counts it (a topic's
# partition; 0 if there is one only), and its place in the message. The values are
# kept side by side, so none of them has a bound but its type's.
KEY = T.StructType(
    [
        T.StructField("arrival", T.LongType()),
        T.StructField("source", T.IntegerType()),
        T.StructField("position", T.IntegerType()),
    ]
)

# A row of the log is told by its ``id`` where a table gave it one, else by its key.
ROW_KEY = ["id", *KEY.fieldNames()]

# One message: ``value`` is the JSON text. A topic's messages also have their ``source``.
RAW = T.StructType(
    [
        T.StructField("arrival", T.LongType()),
        T.StructField("value", T.StringType()),
    ]
)
