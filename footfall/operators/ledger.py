"""New reset ledger rows: the counts at reset time are those of the newest reading by event time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions.times import ts
from footfall.operators.latest import BY_EVENT, order_of
from footfall.sources.tables import in_frame, in_list


def _ledger_rows(newest: DataFrame, as_of) -> DataFrame:
    return newest.select(
        "device_id",
        ts(as_of).alias("reset_time"),
        F.col("newest.in_count").alias("reset_in_count"),
        F.col("newest.out_count").alias("reset_out_count"),
    )


def _newest_counts(log: DataFrame):
    return F.max_by(F.struct("in_count", "out_count"), order_of(log, BY_EVENT)).alias("newest")


def reset_devices(log: DataFrame, ids: list[str] | DataFrame, as_of) -> DataFrame:
    """Ledger rows for the given devices; a device without readings gets none."""
    listed = in_list(log, "device_id", ids)
    newest = listed.groupBy("device_id").agg(_newest_counts(listed))
    return _ledger_rows(in_frame(newest, "device_id", ids), as_of)


def building_device_ids(log: DataFrame, building: str) -> DataFrame:
    """Devices that ever logged in the building."""
    return log.filter(F.col("location") == F.lit(building)).select("device_id").distinct()


def reset_building(log: DataFrame, building: str, as_of) -> DataFrame:
    """Ledger rows for every device that ever logged in the building, with its
    newest counts from anywhere. One aggregation answers both, without a join."""
    here = F.coalesce(F.col("location") == F.lit(building), F.lit(False))
    devices = log.groupBy("device_id").agg(_newest_counts(log), F.bool_or(here).alias("was_here"))
    return _ledger_rows(devices.filter("was_here"), as_of)
