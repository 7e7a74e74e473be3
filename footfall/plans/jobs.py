"""Batch jobs on catalog tables, to be started by any scheduler."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions.times import ts
from footfall.operators.health import apply_status, health_by_recency, health_summary, sensor_health
from footfall.operators.ledger import reset_building, reset_devices
from footfall.operators.retention import cutoff_for, old_rows, rows_to_delete, rows_to_move
from footfall.sources import files
from footfall.sources.logstore import LogStore
from footfall.sources.tables import LOG_PARTITIONS
from footfall.streaming.ingest import StreamTables
from footfall.streaming.state import remove

LEDGER = ["device_id", "reset_time", "reset_in_count", "reset_out_count"]


def run_retention(spark: SparkSession, live: str, archive: str, as_of) -> int:
    """Move the months before the current one from ``live`` to ``archive``.

    Both tables are partitioned by ``event_month`` and ``ingest_batch``. The partitions to move
    are listed once: exactly these are archived and then dropped, after checking that
    each of their rows is archived. A late row comes with a later batch, which is another
    partition, and stays until the next run. A run that stopped in between is completed
    by the next one. Returns the number of rows dropped.
    """
    if [c.name for c in spark.catalog.listColumns(live) if c.isPartition] != LOG_PARTITIONS:
        raise ValueError(f"{live} must be partitioned by {', '.join(LOG_PARTITIONS)}")
    cutoff = cutoff_for(as_of)
    listed = []
    for row in spark.sql(f"SHOW PARTITIONS {live}").collect():
        month, batch = (part.partition("=")[2] for part in row.partition.split("/"))
        if date.fromisoformat(month) < cutoff.date():
            listed.append((date.fromisoformat(month), int(batch)))
    if not listed:
        return 0
    # As many rows as partitions; the scan of either table is pruned to the months.
    chosen = spark.createDataFrame(listed, "event_month date, ingest_batch long")
    in_months = F.col("event_month").isin(sorted({month for month, _ in listed}))
    old_live = spark.table(live).filter(in_months).join(F.broadcast(chosen), LOG_PARTITIONS, "left_semi")
    moved = rows_to_move(old_live, spark.table(archive).filter(in_months), cutoff)
    moved.select(*spark.table(archive).columns).write.mode("append").insertInto(archive)

    spark.catalog.refreshTable(archive)
    archived = spark.table(archive).filter(in_months)
    expected = old_rows(old_live, cutoff).count()
    deletable = rows_to_delete(old_live, archived, cutoff).count()
    if expected != deletable or expected != old_live.count():
        raise RuntimeError(f"{expected} old rows, but {deletable} of them are archived")
    for month, batch in listed:
        spark.sql(
            f"ALTER TABLE {live} DROP IF EXISTS "
            f"PARTITION (event_month = DATE'{month}', ingest_batch = {batch})"
        )
    return deletable


def run_health_check(
    spark: SparkSession, sensors: str, log: str, probes: str, target: str, as_of, minutes: int = 5
):
    """Check all sensors, write the new registry snapshot to ``target`` (not the table
    it reads) and return the counts by status."""
    registry = spark.table(sensors)
    health = sensor_health(registry, spark.table(log), spark.table(probes), as_of, minutes)
    apply_status(registry, health).write.mode("overwrite").saveAsTable(target)
    return health_summary(spark.table(target).select("status"))


def check_stream_health(
    spark: SparkSession, tables: StreamTables, probes: DataFrame, as_of, minutes: int = 5
) -> DataFrame:
    """Check the sensors of a stream's registry and keep the result beside it, so that
    ``StreamTables.sensors`` shows it; returns the counts by status. Reads the state's newest arrivals
    and no log. Discovery goes on meanwhile: neither writes what the other has written."""
    registry = tables.sensors(spark)
    health = health_by_recency(registry, tables.recency(spark), probes, as_of, minutes)
    found = health.withColumn("checked_at", ts(as_of))
    number = 1 + max((int(n[6:]) for n in files.names(spark, tables.folder("health")) if n.startswith("check-")), default=-1)
    path = tables.folder(f"health/check-{number:020d}")
    # Written aside first: a reader takes the newest folder.
    draft = tables.folder(f"health_drafts/{number:020d}")
    found.write.mode("overwrite").parquet(draft)
    files.move(spark, draft, path)
    return health_summary(spark.read.parquet(path))


def run_device_reset(spark: SparkSession, log: str, resets: str, ids: list[str], as_of) -> None:
    rows = reset_devices(spark.table(log), ids, as_of)
    rows.select(*LEDGER).write.mode("append").insertInto(resets)


def run_building_reset(spark: SparkSession, log: str, resets: str, building: str, as_of) -> None:
    rows = reset_building(spark.table(log), building, as_of)
    rows.select(*LEDGER).write.mode("append").insertInto(resets)


def clean_up(spark: SparkSession, tables: StreamTables, keep: int = 1_000) -> int:
    """Remove the per-batch working folders of all but the last ``keep`` committed batches.

    The log stays. Feeds and rejects are kept as long as the working folders, so consumers
    have that many batches to read them. Versions of the state and commits of these batches go,
    too; where a summary stream runs, nothing that it has yet to read goes. Returns the number
    of folders of batches removed.
    """
    committed = tables.commits(spark)
    if not committed:
        return 0
    up_to = committed[-1] - keep
    seen = tables.summarised(spark)
    if seen is not None:
        up_to = min(up_to, seen)
    removed = sum(
        remove(spark, tables.folder(name), up_to)
        for name in ("staging", "appended", "rejects", "device_feed")
    )
    # The version of the last batch removed stays: the next batch starts from it.
    for state in (tables.devices, tables.registry):
        state.clean_up(spark, up_to)
    for batch in committed:
        if batch <= up_to:
            files.remove(spark, tables.commit_file(batch))
            files.remove(spark, tables.clock_file(batch))
    return removed


def maintain_log(spark: SparkSession, store: LogStore, as_of, keep_versions: int = 100) -> None:
    """Retention, compaction and clean-up of a log store. Readers and the stream go on meanwhile,
    but for the clean-up, which belongs between two batches."""
    store.archive_before(spark, as_of)
    store.compact(spark)
    store.clean_up(spark, keep_versions)
