"""Registered queries and the SQL they are checked with.

Each query runs over whole tables. The counter tables are derived from ``events``
(FIXTURES.md), so the work grows with them.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import oracle
from footfall import fixtures as fx
from footfall import schemas
from footfall.functions.counters import with_display
from footfall.functions.times import floor_to
from footfall.operators import (
    asof,
    compare,
    health,
    ingest,
    latest,
    ledger,
    registry,
    retention,
    snapshot,
    trend,
)
from footfall.plans.jobs import run_retention
from footfall.session import configure, workspace
from footfall.sources.logstore import LogStore, Snapshot
from footfall.sources.payloads import payload_files
from footfall.sources.tables import LOG_PARTITIONS, log_store, log_union, with_month
from footfall.streaming.ingest import StreamTables, ingest_stream, summary_stream

# The operators for training data live in folders of their own, which may be absent.
try:
    import corpus_pipeline
    from footfall.llm.queries import llm_oracle_sql, llm_queries
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "footfall.llm", "footfall.llm.queries"):
        raise
    corpus_pipeline = None

AS_OF = "2024-02-10"
HEALTH_AT = "2024-01-31"
DEVICE, BUILDING, DAY = "dev-7", "B7", "2024-01-15"
DAYS = ("2024-01-05", "2024-01-25")
MONTHS = ("2024-01-01", "2024-04-30")
LOG_COLUMNS = schemas.LOG.fieldNames()
ASOF_COLUMNS = [
    "id", "device_id", "event_time", "reset_time", "reset_in_count", "reset_out_count",
]

Query = Callable[[SparkSession, str], DataFrame]


def entry(spark: SparkSession) -> DataFrame:
    """Current occupancy per building on the smallest tables."""
    return queries()["building_summary"](spark, "/root/testdata/sf0.001")


def _log(fn: Callable[..., DataFrame]) -> Query:
    return lambda spark, sf: fn(fx.counter_log(spark, sf))


def _snapshot(fn: Callable[[DataFrame, DataFrame, DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        online = fx.sensors(spark, sf).filter("is_online").select("device")
        return fn(fx.counter_log(spark, sf), fx.counter_resets(spark, sf), online)

    return run


def _split(fn: Callable[[DataFrame, DataFrame, DataFrame], DataFrame], monthly: bool = False) -> Query:
    """Queries over live log, archive and resets."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        log = (fx.counter_log_months if monthly else fx.counter_log)(spark, sf)
        resets = (fx.counter_resets_months if monthly else fx.counter_resets)(spark, sf)
        return fn(*fx.split_at(log, fx.ARCHIVE_BEFORE), resets)

    return run


def _sensor_trend(bucket: str, device: str | None = DEVICE) -> Query:
    span = MONTHS if bucket == "month" else DAYS
    return _split(
        lambda live, archive, resets: trend.sensor_trend(live, archive, resets, device, *span, bucket),
        bucket == "month",
    )


def _location_trend(bucket: str, location: str | None = BUILDING) -> Query:
    span = MONTHS if bucket == "month" else DAYS
    return _split(
        lambda live, archive, resets: trend.location_trend(
            live, archive, resets, location, *span, bucket
        ),
        bucket == "month",
    )


def _daily(building: str | None, device: str | None) -> Query:
    return _split(
        lambda live, archive, resets: compare.daily_comparison(
            live, archive, resets, DAY, building, device
        )
    )


def _asof(probe: Callable[[DataFrame], DataFrame], join: Callable[..., DataFrame], *args) -> Query:
    return lambda spark, sf: join(
        probe(fx.counter_log(spark, sf)), fx.counter_resets(spark, sf), *args
    )


def _minute_ends(log: DataFrame) -> DataFrame:
    end = floor_to(F.col("event_time"), "minute") + F.expr("interval '1' minute")
    return log.withColumn("minute_end", end)


def _retention(fn: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: fn(
        fx.counter_log(spark, sf), fx.retention_archive(spark, sf)
    ).select(*LOG_COLUMNS)


def _archive_split(part: str) -> Query:
    return _retention(
        lambda live, done: getattr(retention.archive_split(live, done, fx.RETENTION_CUTOFF), part)
    )


def _health(fn: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        sensors = fx.sensors(spark, sf)
        checked = health.sensor_health(
            sensors, fx.counter_log(spark, sf), fx.probes(spark, sf), HEALTH_AT
        )
        return fn(sensors, checked)

    return run


def _sensors(fn: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: fn(fx.sensors(spark, sf))


def _roles(spark: SparkSession, sf: str) -> DataFrame:
    members = registry.role_membership(
        fx.users(spark, sf), fx.user_roles(spark, sf), fx.roles(spark, sf)
    )
    return members.withColumn("roles", F.array_join("roles", ","))


def _payload(fn: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: fn(fx.raw_payloads(spark, sf))


def _registry(fn: Callable[[DataFrame, DataFrame, str], DataFrame]) -> Query:
    return lambda spark, sf: fn(
        ingest.parse_payloads(fx.raw_payloads(spark, sf)), fx.early_sensors(spark, sf), AS_OF
    ).drop("id")


def _numbered(log: DataFrame) -> DataFrame:
    """Log rows with their key as one number, for comparison; the messages here are few and short."""
    number = (F.col("arrival") * 16777216 + F.col("position")).alias("id")
    return log.select(number, *LOG_COLUMNS[1:])


def _ingest_append(spark: SparkSession, sf: str) -> DataFrame:
    """Messages to log rows, appended to a table and read back."""
    readings = ingest.parse_payloads(fx.raw_payloads(spark, sf))
    store = log_store(workspace(spark, "ingest"))
    rows = ingest.drop_unchanged(ingest.to_log_rows(readings, AS_OF))
    store.append(with_month(rows).withColumn("id", F.lit(None).cast("long")).withColumn("ingest_batch", F.lit(0)))
    return _numbered(store.live(spark))


def batch_clock(batch: int) -> datetime:
    return datetime(2024, 2, 1) + timedelta(hours=batch)


_streamed: dict[tuple[str, str], StreamTables] = {}


def streamed(spark: SparkSession, sf: str) -> StreamTables:
    """All messages sent through the streams, a week at a time; each week the
    streams start again from their checkpoints. Runs once per session and folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key in _streamed:
        return _streamed[key]
    payloads = fx.raw_payloads(spark, sf)
    sensors = fx.early_sensors(spark, sf)
    source = workspace(spark, "messages")
    tables = StreamTables(workspace(spark, "stream"))
    for week in range(4):
        messages = payloads.filter(F.col("week") == week).select("arrival", "value")
        messages.write.mode("append").parquet(source)
        ingest_stream(
            payload_files(spark, source), tables, lambda: fx.counter_resets(spark, sf), sensors,
            batch_clock, interval=None,
        ).awaitTermination()
        summary_stream(
            spark, tables, lambda: fx.counter_resets(spark, sf), batch_clock, interval=None
        ).awaitTermination()
    _streamed[key] = tables
    return tables


def _stream(fn: Callable[[SparkSession, StreamTables], DataFrame]) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        configure(spark)
        return fn(spark, streamed(spark, sf))

    return run


def _stream_trend(spark: SparkSession, sf: str) -> DataFrame:
    """Trend of all devices over the rows that the stream appended to the log."""
    configure(spark)
    log = streamed(spark, sf).log(spark)
    return trend.sensor_trend(log, log.limit(0), fx.counter_resets(spark, sf), None, *DAYS, "hour")


def _retention_job(part: str) -> Query:
    """The log after the retention job, run on tables in the shared folder; some of the old
    rows are archived already, as after a run that stopped."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        log = with_month(fx.counter_log_months(spark, sf))
        log = log.withColumn("ingest_batch", (F.col("id") % 3).cast("long"))
        rows = log.select(*LOG_COLUMNS, *LOG_PARTITIONS)
        names = {}
        for name, df in (("live", rows), ("archive", rows.filter("event_time < '2024-02-01' and id % 4 = 0"))):
            path = workspace(spark, f"retention-{name}")
            names[name] = "retention_" + path.rpartition("-")[2]
            df.write.partitionBy(*LOG_PARTITIONS).option("path", path).saveAsTable(names[name])
        run_retention(spark, names["live"], names["archive"], "2024-03-15")
        return spark.table(names[part]).select(*LOG_COLUMNS)

    return run


def _log_store(read: Callable[[Snapshot], DataFrame]) -> Query:
    """A log store that rows were appended to in three batches, after retention and compaction."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        log = fx.counter_log_months(spark, sf).select(*LOG_COLUMNS)
        store = LogStore(workspace(spark, "log-store"), schemas.LOG)
        for batch in range(3):
            store.append(log.filter(F.col("id") % 3 == batch), batch)
        store.archive_before(spark, "2024-03-15")
        store.compact(spark, least=2)
        return read(store.snapshot(spark)).select(*LOG_COLUMNS)

    return run


def queries() -> dict[str, Query]:
    more = {**llm_queries(), "pipeline": corpus_pipeline.run} if corpus_pipeline else {}
    return {**_counter_queries(), **more}


def _counter_queries() -> dict[str, Query]:
    return {
        "latest_reset": _snapshot(lambda log, resets, online: latest.latest_reset(resets)),
        "latest_log": _log(lambda log: latest.latest_log(log).select(*LOG_COLUMNS)),
        "building_summary": _snapshot(
            lambda log, resets, online: snapshot.building_summary(log, resets, AS_OF)),
        "building_devices": _snapshot(
            lambda log, resets, online: snapshot.building_devices(log, resets, BUILDING, AS_OF)),
        "latest_devices": _snapshot(
            lambda log, resets, online: snapshot.latest_devices(log, resets, online, AS_OF)),
        "device_building": _snapshot(
            lambda log, resets, online: snapshot.device_building(log, online)),
        "log_union": _split(
            lambda live, archive, resets: log_union(live, archive).select(*LOG_COLUMNS)),
        "asof_reset": _asof(
            lambda log: log, lambda *a: asof.asof_reset(*a).select(*ASOF_COLUMNS)),
        "asof_reset_strict": _asof(
            _minute_ends, lambda *a: asof.asof_reset(*a).select(*ASOF_COLUMNS), "minute_end", False),
        # The plan for ledgers that are large, or have many resets per device, whatever the
        # size of this one.
        "asof_reset_sliced": _asof(
            lambda log: log, lambda *a: asof.asof_reset(*a).select(*ASOF_COLUMNS),
            "event_time", True, asof.AsofLimits(2_000_000, 1)),
        "asof_reset_shuffled": _asof(
            lambda log: log, lambda *a: asof.asof_reset(*a).select(*ASOF_COLUMNS),
            "event_time", True, asof.AsofLimits(0, 1)),
        "display_counts": _asof(
            lambda log: log,
            lambda *a: with_display(asof.asof_reset(*a)).select(
                "id", "device_id", "event_time", "in_count", "out_count",
                "display_in", "display_out")),
        "sensor_trend_hour": _sensor_trend("hour"),
        "sensor_trend_day": _sensor_trend("day"),
        "sensor_trend_month": _sensor_trend("month"),
        "sensor_trend_all_hour": _sensor_trend("hour", None),
        "location_trend_hour": _location_trend("hour"),
        "location_trend_day": _location_trend("day"),
        "location_trend_month": _location_trend("month"),
        "location_trend_all_day": _location_trend("day", None),
        "daily_comparison_building": _daily(BUILDING, None),
        "daily_comparison_device": _daily(None, DEVICE),
        "daily_comparison_both": _daily(BUILDING, DEVICE),
        "reset_device": lambda spark, sf: ledger.reset_devices(
            fx.counter_log(spark, sf),
            fx.sensors(spark, sf).filter("status = 'Offline'").select("device"), AS_OF),
        "reset_building": _log(lambda log: ledger.reset_building(log, BUILDING, AS_OF)),
        "location_devices": _log(lambda log: ledger.building_device_ids(log, BUILDING)),
        "archive_moved": _archive_split("moved"),
        "archive_after": _archive_split("archive"),
        "archived_still_live": _retention(
            lambda live, done: retention.rows_to_delete(live, done, fx.RETENTION_CUTOFF)),
        "live_after_archive": _archive_split("live"),
        "recent_activity": lambda spark, sf: health.recent_activity(
            fx.counter_log(spark, sf), fx.sensors(spark, sf), HEALTH_AT, 5),
        "last_data_time": _log(health.last_data_time),
        "health_status": _health(lambda sensors, checked: checked),
        "health_summary": _health(lambda sensors, checked: health.health_summary(checked)),
        "sensor_status_applied": _health(health.apply_status),
        "sensor_status": _sensors(registry.sensor_status),
        "sensor_lookup": _sensors(lambda sensors: registry.sensor_lookup(sensors, DEVICE)),
        "device_list": _sensors(registry.device_list),
        "location_list": _sensors(registry.location_list),
        "role_membership": _roles,
        "parse_payload": _payload(lambda raw: ingest.parse_payloads(raw).drop("source")),
        "parse_rejects": _payload(lambda raw: ingest.payload_rejects(raw).drop("raw", "source")),
        "changed_only": _log(lambda log: ingest.drop_unchanged(log).select(*LOG_COLUMNS)),
        # The same with a finer slice.
        "changed_only_sliced": _log(
            lambda log: ingest.drop_unchanged(log, unit="minute").select(*LOG_COLUMNS)),
        "discovered_sensors": _registry(registry.discover_sensors),
        "discovered_sensor_ids": lambda spark, sf: registry.discover_sensors(
            ingest.parse_payloads(fx.raw_payloads(spark, sf)), fx.early_sensors(spark, sf), AS_OF
        ).select("id", "device"),
        # The newest arrivals of the old log kept, merged with those of its tail.
        "health_by_recency": lambda spark, sf: health.health_by_recency(
            fx.sensors(spark, sf),
            health.merged_recency(*map(health.last_data_time, fx.split_at(fx.counter_log(spark, sf), fx.ARCHIVE_BEFORE))),
            fx.probes(spark, sf), HEALTH_AT),
        "sensors_registered": _registry(registry.register_readings),
        "ingest_append": _ingest_append,
        "stream_changed_only": _stream(
            lambda spark, tables: _numbered(tables.log(spark))),
        "stream_sensor_trend": _stream_trend,
        "log_store_live": _log_store(lambda snapshot: snapshot.live),
        "log_store_archive": _log_store(lambda snapshot: snapshot.archive),
        "log_store_union": _log_store(lambda snapshot: log_union(snapshot.live, snapshot.archive)),
        "retention_job_live": _retention_job("live"),
        "retention_job_archive": _retention_job("archive"),
        "stream_device_feed": _stream(lambda spark, tables: tables.batches(spark, "device_feed")),
        "stream_summary_feed": _stream(lambda spark, tables: tables.batches(spark, "summary_feed")),
    }


def oracle_sql() -> dict[str, str]:
    more = llm_oracle_sql() if corpus_pipeline else {}
    return {**oracle.oracle_sql(), **more}
