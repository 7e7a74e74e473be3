"""Per-device windows over logs in which one device may hold much of the data.

A window partitioned by device sorts all rows of a device in one task. So rows are
cut into time slices that are windowed separately, and each slice gets the last
value of the slice before it. The slice values are aggregated before they are
shuffled, so they are as many as the slices, not as the rows. The slice is the same
whatever the data, so nothing is counted first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions.times import floor_to

# The slice of `with_previous`. A sensor that reports every second has 3,600 rows in it.
SLICE = "hour"

# Rows one group may hold before `slice_unit` cuts it into smaller slices.
MAX_GROUP_ROWS = 1_000_000

UNITS = ("day", "hour", "minute", "second")


def slice_unit(
    df: DataFrame, key: str, time: str, max_rows: int = MAX_GROUP_ROWS
) -> str | None:
    """The coarsest slice in which no group exceeds ``max_rows``; None if no cut is needed.

    Counts are pre-aggregated on two columns. Rows of one device within one
    second are never split further; such a group is still handled, in one task.
    """
    for unit in UNITS:
        per_slice = df.groupBy(key, floor_to(F.col(time), unit).alias("slice")).count()
        per_key = per_slice.groupBy(key).agg(
            F.sum("count").alias("rows"), F.max("count").alias("slice_rows")
        )
        whole, largest = per_key.agg(F.max("rows"), F.max("slice_rows")).first()
        if (whole or 0) <= max_rows:
            return None
        if largest <= max_rows:
            return unit
    return UNITS[-1]


def with_previous(
    df: DataFrame,
    key: str,
    order: list[str],
    columns: list[str],
    prior: DataFrame | None = None,
    unit: str = SLICE,
) -> DataFrame:
    """Add ``previous``, a struct of the ``columns`` of the row before in ``order``.

    The first of ``order`` is the time that rows are sliced by. ``prior`` (``key``
    plus ``columns``) stands before the first row of its key; without it that
    row's ``previous`` is null.
    """
    rows = df.withColumn("_slice", floor_to(F.col(order[0]), unit)).withColumn("_seed", F.lit(1))
    seeds = _slice_seeds(rows, key, order, columns, prior)
    window = Window.partitionBy(key, "_slice").orderBy("_seed", *order)
    return (
        rows.unionByName(seeds, allowMissingColumns=True)
        .withColumn("previous", F.lag(F.struct(*columns)).over(window))
        .filter(F.col("_seed") == 1)
        .drop("_slice", "_seed")
    )


def _slice_seeds(sliced, key, order, columns, prior) -> DataFrame:
    """One row per slice holding what came before it (``_seed`` 0, so it sorts first)."""
    tails = sliced.groupBy(key, "_slice").agg(
        F.max_by(F.struct(*columns), F.struct(*order)).alias("tail")
    )
    slices = Window.partitionBy(key).orderBy("_slice")
    carried = tails.withColumn("carry", F.lag("tail").over(slices))
    seeds = carried.filter("carry is not null").select(key, "_slice", "carry.*")
    if prior is not None:
        first = carried.filter("carry is null").select(key, "_slice")
        seeds = seeds.unionByName(first.join(prior.select(key, *columns), key))
    return seeds.withColumn("_seed", F.lit(0))
