"""Counter log, reset ledger and sensor registry as parquet tables.

The log is laid out by month of the event (``event_month``, a date), so a time
range reads only its months, and within it by the batch that brought the rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall import schemas
from footfall.functions.times import floor_to, ts
from footfall.sources import files
from footfall.sources.logstore import LogStore


LOG_PARTITIONS = ["event_month", "ingest_batch"]
LOG_TABLE = T.StructType(
    schemas.LOG.fields
    + [T.StructField("event_month", T.DateType()), T.StructField("ingest_batch", T.LongType())]
)


# A streamed log also holds the key of each row; its ``id`` is null.
STREAM_LOG = T.StructType([*schemas.LOG.fields, *schemas.KEY.fields, *LOG_TABLE.fields[len(schemas.LOG.fields):]])


def log_store(path: str) -> LogStore:
    return LogStore(path, STREAM_LOG)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """A log table written by :func:`write_log`, or the live log of a store (``logstore``)."""
    if files.exists(spark, f"{path}/_versions"):
        return log_store(path).live(spark)
    return spark.read.schema(LOG_TABLE).parquet(path)


def write_log(log: DataFrame, path: str, batch: int = 0) -> None:
    """Add the rows of one batch. Writing a batch again replaces what it wrote before."""
    rows = with_month(log).withColumn("ingest_batch", F.lit(batch).cast("long"))
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*LOG_PARTITIONS)
        .parquet(path)
    )


def with_month(log: DataFrame) -> DataFrame:
    return log.withColumn("event_month", floor_to(F.col("event_time"), "month").cast("date"))


def read_resets(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.RESETS).parquet(path)


def log_union(live: DataFrame, archive: DataFrame) -> DataFrame:
    """Live and archived log as one table; filters above it reach both scans."""
    return live.unionByName(archive)


def created_since(log: DataFrame, start) -> DataFrame:
    """Rows that arrived at or after ``start``; there is no upper bound."""
    return log.filter(F.col("created_at") >= ts(start))


def in_list(df: DataFrame, column: str, values: list[str] | DataFrame) -> DataFrame:
    """Keep rows whose ``column`` is in a list, as a filter the scan can use. A
    DataFrame of values is left to :func:`in_frame`."""
    if isinstance(values, DataFrame):
        return df
    return df.filter(F.col(column).isin(list(values))) if values else df.filter(F.lit(False))


def in_frame(df: DataFrame, column: str, values: list[str] | DataFrame) -> DataFrame:
    """Semi-join rows with a DataFrame of values (its first column).

    Meant for rows already reduced to one per ``column``. The join then costs the
    same whatever the number of values, and never shuffles the rows of the log.
    """
    if not isinstance(values, DataFrame):
        return df
    keys = values.select(F.col(values.columns[0]).alias(column))
    return df.join(keys, column, "left_semi")


def optional_filters(df: DataFrame, **wanted: str | None) -> DataFrame:
    """AND together ``column == value`` for the values that are given."""
    tests = [F.col(name) == F.lit(value) for name, value in wanted.items() if value is not None]
    return df.filter(reduce(lambda a, b: a & b, tests)) if tests else df
