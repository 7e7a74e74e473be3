"""Current counts: each device's newest reading, adjusted by its newest reset.

The newest reset applies even when it is later than the reading. Only readings
that arrived in the 30 days before ``as_of`` count, and only the live log is
read. ``log`` may also be the small table of newest rows per device and
location that the stream maintains: the results are the same.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions.counters import with_display
from footfall.functions.times import as_datetime
from footfall.operators.latest import BY_ARRIVAL, latest_by, latest_reset
from footfall.sources.tables import created_since, in_frame, in_list

LOOK_BACK = timedelta(days=30)


def _adjusted(
    log: DataFrame,
    resets: DataFrame,
    as_of,
    order: tuple[str, ...],
    columns: list[str],
    ids: list[str] | DataFrame | None = None,
) -> DataFrame:
    recent = created_since(log, as_datetime(as_of) - LOOK_BACK)
    # Naming the columns lets the scan skip the others.
    newest = latest_by(recent, ["device_id"], order, [*columns, "in_count", "out_count"])
    newest = newest if ids is None else in_frame(newest, "device_id", ids)
    # Both sides are aggregated by device, so the join needs no further shuffle.
    return with_display(newest.join(latest_reset(resets), "device_id", "left"))


def _devices(
    log: DataFrame,
    resets: DataFrame,
    as_of,
    order: tuple[str, ...],
    ids: list[str] | DataFrame | None = None,
) -> DataFrame:
    columns = ["location", "sublocation", "event_time"]
    return _adjusted(log, resets, as_of, order, columns, ids).select(
        "device_id",
        *columns,
        "display_in",
        "display_out",
        (F.col("display_in") - F.col("display_out")).alias("inside"),
    )


def building_summary(
    log: DataFrame, resets: DataFrame, as_of, order: tuple[str, ...] = BY_ARRIVAL
) -> DataFrame:
    """Totals per building. A device counts where its newest reading is; the
    occupancy may be negative."""
    total_in, total_out = F.sum("display_in"), F.sum("display_out")
    return (
        _adjusted(log, resets, as_of, order, ["location"])
        .groupBy(F.col("location").alias("building"))
        .agg(
            total_in.alias("total_in"),
            total_out.alias("total_out"),
            (total_in - total_out).alias("total_capacity"),
        )
    )


def building_devices(
    log: DataFrame, resets: DataFrame, building: str, as_of, order: tuple[str, ...] = BY_ARRIVAL
) -> DataFrame:
    """Devices by their newest reading in this building. The building is filtered
    first, so a device that has moved away still shows here."""
    here = log.filter(F.col("location") == F.lit(building))
    return _devices(here, resets, as_of, order)


def latest_devices(
    log: DataFrame,
    resets: DataFrame,
    ids: list[str] | DataFrame,
    as_of,
    order: tuple[str, ...] = BY_ARRIVAL,
) -> DataFrame:
    """Current counts of the given devices; no ids give no rows."""
    listed = in_list(log, "device_id", ids)
    return _devices(listed, in_list(resets, "device_id", ids), as_of, order, ids)


def device_building(log: DataFrame, ids: list[str] | DataFrame) -> DataFrame:
    """Building of each device's newest reading; a device without one has no row."""
    listed = in_list(log, "device_id", ids)
    newest = in_frame(
        latest_by(listed, ["device_id"], BY_ARRIVAL, ["location"]), "device_id", ids
    )
    return newest.filter("location is not null").select("device_id", "location")
