"""Newest row per key.

``max_by`` keeps one candidate per key and map task, so only those cross the
shuffle, however many rows one key has. A struct as ordering compares its
fields in turn, nulls lowest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall import schemas

# Rows have an id, a key, or both; the columns that a table lacks are left out of the order.
BY_ARRIVAL = ("created_at", *schemas.ROW_KEY)
BY_EVENT = ("event_time", *schemas.ROW_KEY)


def order_of(df: DataFrame, order: tuple[str, ...]) -> Column:
    return F.struct(*[name for name in order if name in df.columns])


def latest_by(
    df: DataFrame, keys: list[str], order: tuple[str, ...], columns: list[str] | None = None
) -> DataFrame:
    """The row with the highest ``order`` for each of ``keys``."""
    columns = columns or [name for name in df.columns if name not in keys]
    newest = F.max_by(F.struct(*columns), order_of(df, order)).alias("newest")
    return df.groupBy(*keys).agg(newest).select(*keys, "newest.*")


def latest_log(log: DataFrame, order: tuple[str, ...] = BY_ARRIVAL) -> DataFrame:
    """Newest log row of each device."""
    return latest_by(log, ["device_id"], order)


def latest_reset(resets: DataFrame) -> DataFrame:
    """Newest reset of each device; of two at one time, the higher counts."""
    return latest_by(
        resets,
        ["device_id"],
        ("reset_time", "reset_in_count", "reset_out_count"),
        ["reset_time", "reset_in_count", "reset_out_count"],
    )
