"""Arithmetic on cumulative counters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def display_count(count: Column, reset: Column) -> Column:
    """The count since the reset.

    A count below the reset value means the device restarted from zero after
    the reset, so the raw count already is the count since then.
    """
    return F.when(reset.isNull() | (count < reset), count).otherwise(count - reset)


def clamp_zero(value: Column) -> Column:
    return F.greatest(value, F.lit(0))


def bucket_delta(peak: Column, low: Column, previous_peak: Column) -> Column:
    """What a bucket adds: growth over the previous bucket's peak, or over the
    bucket's own low when there is no earlier bucket."""
    return peak - F.coalesce(previous_peak, low)


def with_display(df, in_col: str = "in_count", out_col: str = "out_count"):
    """Add ``display_in`` and ``display_out``; each counter is adjusted on its own."""
    return df.withColumns(
        {
            "display_in": display_count(F.col(in_col), F.col("reset_in_count")),
            "display_out": display_count(F.col(out_col), F.col("reset_out_count")),
        }
    )
