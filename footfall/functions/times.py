"""Time literals, floors and range alignment, independent of the session zone."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = ("hour", "day", "month")

# Smallest steps used to close a calendar range.
SECOND = timedelta(seconds=1)
MICROSECOND = timedelta(microseconds=1)


def as_datetime(value: datetime | date | str) -> datetime:
    """Accept a datetime, date or ISO text; a zoned value becomes UTC wall time."""
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    elif isinstance(value, date) and not isinstance(value, datetime):
        value = datetime(value.year, value.month, value.day)
    if value.tzinfo is not None:
        value = value.astimezone(timezone.utc).replace(tzinfo=None)
    return value


def ts(value: datetime | date | str) -> Column:
    """A ``timestamp_ntz`` literal, which Catalyst can push into a scan."""
    return F.lit(as_datetime(value).isoformat(sep=" ")).cast("timestamp_ntz")


def month_start(value: datetime | date | str) -> datetime:
    value = as_datetime(value)
    return datetime(value.year, value.month, 1)


def floor_to(col: Column, unit: str) -> Column:
    """Floor a ``timestamp_ntz``. Going through DATE instead of ``date_trunc``
    keeps the value free of any session zone."""
    day = col.cast("date")
    if unit == "month":
        return F.trunc(day, "month").cast("timestamp_ntz")
    start = day.cast("timestamp_ntz")
    parts = {"day": (), "hour": (F.hour,), "minute": (F.hour, F.minute),
             "second": (F.hour, F.minute, F.second)}[unit]
    if not parts:
        return start
    return start + F.make_dt_interval(F.lit(0), *(part(col) for part in parts))


def check_bucket(bucket: str) -> str:
    lowered = bucket.lower()
    if lowered not in BUCKETS:
        raise ValueError("bucket must be one of: hour, day, month")
    return lowered


def check_range(start, end) -> tuple[datetime, datetime]:
    if start is None or end is None:
        raise ValueError("start and end are required")
    start, end = as_datetime(start), as_datetime(end)
    if end < start:
        raise ValueError("end must not be before start")
    return start, end


def align_range(start, end, bucket: str, step: timedelta = SECOND) -> tuple[datetime, datetime]:
    """Widen a range to whole buckets; the end is ``step`` before the next bucket.

    Hours are taken as given. Device trends close the range one second early,
    building trends one microsecond early.
    """
    bucket = check_bucket(bucket)
    start, end = check_range(start, end)
    if bucket == "hour":
        return start, end
    if bucket == "day":
        next_day = datetime(end.year, end.month, end.day) + timedelta(days=1)
        return datetime(start.year, start.month, start.day), next_day - step
    next_month = (month_start(end) + timedelta(days=32)).replace(day=1)
    return month_start(start), next_month - step


def in_event_range(df: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Keep ``start <= event_time <= end``, pruning month folders where the table has them."""
    if "event_month" in df.columns:
        df = df.filter(
            F.col("event_month").between(
                F.lit(month_start(start).date()), F.lit(month_start(end).date())
            )
        )
    return df.filter(F.col("event_time").between(ts(start), ts(end)))


def on_day(df: DataFrame, day) -> DataFrame:
    """Keep one calendar day, written as a half-open range for pushdown."""
    start = as_datetime(day)
    start = datetime(start.year, start.month, start.day)
    if "event_month" in df.columns:
        df = df.filter(F.col("event_month") == F.lit(month_start(start).date()))
    return df.filter(
        (F.col("event_time") >= ts(start)) & (F.col("event_time") < ts(start + timedelta(days=1)))
    )
