"""Reading tables and the shared scratch folder of the operators."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm.arrays import forget_powers
from footfall.session import workspace

CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Keep one Arrow batch of long texts small enough for a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(32 << 20))


def _trim() -> None:
    """Give the memory that Python, Arrow and the C library hold but do not use back to the system."""
    forget_powers()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def trimmed(run: Callable) -> Callable:
    """``run`` for ``mapInArrow``, in a worker that has given back what its tasks before have
    freed: workers are reused, and a job of many stages would carry the highest peak along."""

    def from_low(batches):
        _trim()
        yield from run(batches)

    return from_low


def cut(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written to the shared folder and read back: later steps
    start from files that survive a lost executor. The shuffles of the write, which nothing
    reads again, go with its end and not whenever the driver next collects garbage."""
    spark = df.sparkSession
    path = workspace(spark, f"{name}-{uuid.uuid4().hex[:8]}")
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def in_id_order(df: DataFrame, order: str, tie: str, per_partition: int = 8) -> DataFrame:
    """Rows in ascending ``order`` (null first, ties by ``tie``), each followed by its
    successor: within a partition, ``block`` groups neighbouring rows and ends with
    copies (``is_copy``) of the first row of the next block; the last block ends with
    the first row of all. One shuffle by block; the driver sees one id per block.

    Blocks come from approximate quantiles; all rows with one id share a block.
    """
    spark = df.sparkSession
    blocks = shuffle_partitions(spark) * per_partition
    shares = [k / blocks for k in range(1, blocks)]
    bounds = sorted({int(b) for b in df.approxQuantile(order, shares, 0.25 / blocks)}) if shares else []
    below = F.lit(0)
    if bounds:
        below = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b <= F.col(order)))
    placed = df.withColumn("block", F.coalesce(below, F.lit(0)))
    firsts = sorted(
        (r["block"], r["first"][0])
        for r in placed.groupBy("block").agg(F.min(F.struct(order)).alias("first")).collect()
    )
    goes = F.array("block")
    if firsts:
        before = {first: firsts[k - 1][0] for k, (_, first) in enumerate(firsts)}
        known = {first: block for first, block in before.items() if first is not None}
        target = F.lit(None).cast("int")
        if known:
            pairs = [F.lit(v) for pair in known.items() for v in pair]
            target = F.create_map(*pairs)[F.col(order)].cast("int")
        if None in before:
            target = F.when(F.col(order).isNull(), F.lit(before[None])).otherwise(target)
        goes = F.filter(
            F.array(
                F.struct(F.col("block"), F.lit(False).alias("is_copy")),
                F.struct(target.alias("block"), F.lit(True).alias("is_copy")),
            ),
            lambda g: g["block"].isNotNull(),
        )
    else:
        goes = F.array(F.struct(F.col("block"), F.lit(False).alias("is_copy")))
    return (
        placed.withColumn("goes", F.explode(goes))
        .select(*df.columns, F.col("goes.block").alias("block"), F.col("goes.is_copy").alias("is_copy"))
        .repartition(shuffle_partitions(spark), "block")
        .sortWithinPartitions("block", "is_copy", F.col(order).asc_nulls_first(), tie)
    )
