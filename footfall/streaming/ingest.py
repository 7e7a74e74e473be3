"""Messages to log, registry and feeds, one micro-batch at a time.

Each batch is decoded once into a staging table, which all later steps read.
Every output is a folder of its batch that a replay overwrites, or a version that is put in place
by renaming, so the stream may be stopped at any point and restarted from its checkpoint without
losing or doubling a reading. The last step of a batch is its commit, one file that appears whole
or not at all; a batch that is replayed after its commit is left as it is. What a batch reads and
writes of the state are the buckets of its own devices.

The summary stream follows the commits and reads the state at the newest batch that it sees, so
it keeps no state of its own and never depends on files that a replay replaces. The log is a
store (``sources.logstore``) that queries and retention read while the stream appends. Late readings
are accepted with any event time; they are ordered within their batch and compared with whatever
came last before it.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from footfall import schemas
from footfall.operators.ingest import (
    NO_VALID_ROWS,
    decode_messages,
    drop_unchanged,
    to_log_rows,
)
from footfall.operators.health import last_data_time, latest_status
from footfall.operators.latest import latest_by
from footfall.operators.registry import register_readings
from footfall.operators.snapshot import building_summary, latest_devices
from footfall.sources import files
from footfall.sources.logstore import LogStore
from footfall.sources.tables import log_store, with_month
from footfall.streaming.state import StateTable

# Readings of one batch arrive at one time; among them the later event is newer. Batches are
# compared by number: clocks may differ between drivers.
STREAM_ORDER = ("ingest_batch", "event_time", *schemas.KEY.fieldNames())

DEVICE_STATE = T.StructType(
    [*schemas.LOG.fields, *schemas.KEY.fields, T.StructField("ingest_batch", T.LongType())]
)
HEALTH = T.StructType(
    [
        T.StructField("device", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("last_data_time", T.TimestampNTZType()),
        T.StructField("checked_at", T.TimestampNTZType()),
    ]
)
COMMIT = T.StructType([T.StructField("ingest_batch", T.LongType())])

READINGS = T.StructType(
    [
        *schemas.KEY.fields,
        *[f for f in schemas.LOG.fields if f.name not in ("id", "created_at", "event_time")],
        T.StructField("ip_address", T.StringType()),
        T.StructField("event_time", T.TimestampNTZType()),
        T.StructField("reason", T.StringType()),
        T.StructField("raw", T.StringType()),
    ]
)


def utc_clock(batch: int) -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


@dataclass(frozen=True)
class StreamTables:
    """Where the stream keeps its tables, below one shared folder."""

    root: str

    def folder(self, name: str) -> str:
        return f"{self.root}/{name}"

    def of_batch(self, name: str, batch: int) -> str:
        return f"{self.root}/{name}/ingest_batch={batch}"

    @property
    def devices(self) -> StateTable:
        return StateTable(self.folder("state_devices"), DEVICE_STATE)

    @property
    def registry(self) -> StateTable:
        return StateTable(self.folder("state_registry"), schemas.SENSORS, ("device",), highest="id")

    def sensors(self, spark: SparkSession) -> DataFrame:
        """The registry as discovery and the last health check leave it."""
        committed = self.commits(spark)
        registry = self.registry.after(spark, committed[-1] if committed else -1)
        checks = _numbers(files.names(spark, self.folder("health")), "check-", "")
        if not checks:
            return registry
        found = spark.read.schema(HEALTH).parquet(self.folder(f"health/check-{checks[-1]:020d}"))
        return latest_status(registry, found)

    def recency(self, spark: SparkSession) -> DataFrame:
        """``device_id, last_data_time`` of each device that ever logged, from the state: no log is read."""
        committed = self.commits(spark)
        return last_data_time(self.devices.after(spark, committed[-1] if committed else -1))

    @property
    def store(self) -> LogStore:
        return log_store(self.folder("log"))

    def log(self, spark: SparkSession) -> DataFrame:
        return self.store.live(spark)

    def commit_file(self, batch: int) -> str:
        return f"{self.folder('commits')}/batch-{batch:020d}.json"

    def clock_file(self, batch: int) -> str:
        return f"{self.folder('clocks')}/batch-{batch:020d}.json"

    def commits(self, spark: SparkSession) -> list[int]:
        """Numbers of the batches committed, as far as their files are kept."""
        return _numbers(files.names(spark, self.folder("commits")))

    def summarised(self, spark: SparkSession) -> int | None:
        """The newest batch whose totals are out; None if no summary stream was ever started."""
        if not files.exists(spark, self.folder("checkpoint_summary")):
            return None
        done = _numbers(files.names(spark, self.folder("summaries")))
        if not done:
            return -1
        return files.read_json(spark, f"{self.folder('summaries')}/batch-{done[-1]:020d}.json")["ingest_batch"]

    def appended(self, spark: SparkSession, batches: list[int]) -> DataFrame:
        """The log rows of these batches."""
        reader = spark.read.schema(DEVICE_STATE).option("basePath", self.folder("appended"))
        return reader.parquet(*(self.of_batch("appended", b) for b in batches))

    def batches(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(self.folder(name))


def _numbers(names: list[str], start: str = "batch-", end: str = ".json") -> list[int]:
    return sorted(int(n[len(start) : len(n) - len(end)]) for n in names if n.startswith(start) and n.endswith(end))


def _together(*steps: Callable[[], object]) -> None:
    """Run steps that do not depend on each other side by side; their jobs share the cluster."""
    target = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(len(steps)) as pool:
        for done in [pool.submit(target(step)) for step in steps]:
            done.result()


def newest_per_place(state: DataFrame, rows: DataFrame) -> DataFrame:
    """Newest row of each device and building. From it every snapshot can be
    answered: a building's by filtering first, a device's by taking its newest."""
    names = DEVICE_STATE.fieldNames()
    both = state.select(*names).unionByName(rows.select(*names))
    return latest_by(both, ["device_id", "location"], STREAM_ORDER).select(*names)


def ingest_batch(
    raw: DataFrame,
    batch: int,
    tables: StreamTables,
    resets: DataFrame,
    sensors: DataFrame,
    as_of: datetime,
) -> None:
    """Process one micro-batch; ``sensors`` is the registry before the first one."""
    spark = raw.sparkSession
    if files.exists(spark, tables.commit_file(batch)):
        return
    # A replay keeps the time of the first try, so that its rows are the same.
    files.put_json(spark, tables.clock_file(batch), {"as_of": as_of.isoformat()})
    as_of = datetime.fromisoformat(files.read_json(spark, tables.clock_file(batch))["as_of"])
    staging = tables.of_batch("staging", batch)
    decode_messages(raw).write.mode("overwrite").parquet(staging)
    decoded = spark.read.schema(READINGS).parquet(staging)
    readings = decoded.filter("reason is null")

    state = tables.devices.touched(spark, batch, readings, "device_id")

    def reject() -> None:
        rejects = decoded.filter("reason is not null").select(
            *schemas.KEY.fieldNames(), "device_id", "reason", "raw"
        )
        if readings.isEmpty():
            rejects = rejects.unionByName(
                spark.range(1).select(F.lit(NO_VALID_ROWS).alias("reason")), allowMissingColumns=True
            )
        rejects.write.mode("overwrite").parquet(tables.of_batch("rejects", batch))

    def discover() -> None:
        # Before the change filter: an unchanged reading is a sign of life.
        registry = tables.registry.touched(spark, batch, readings, "device_id", sensors)
        known = tables.registry.highest_before(spark, batch)
        tables.registry.write(register_readings(readings, registry, as_of, known), batch)

    def keep() -> None:
        rows = to_log_rows(readings, as_of).withColumn("id", F.lit(None).cast("long"))
        # A dropped reading has the counts of the last kept one, which the state holds.
        counts = latest_by(state, ["device_id"], STREAM_ORDER, ["in_count", "out_count"])
        drop_unchanged(rows, counts).write.mode("overwrite").parquet(tables.of_batch("appended", batch))

    _together(reject, discover, keep)
    appended = tables.appended(spark, [batch])

    def feed() -> None:
        touched = appended.select("device_id").distinct()
        # Of the ledger only the touched devices' resets are aggregated.
        known = resets.join(touched, "device_id", "left_semi")
        now = latest_devices(newest_per_place(state, appended), known, touched, as_of, STREAM_ORDER)
        route = F.concat(F.lit("building:"), F.coalesce("location", F.lit("")))
        now.withColumn("route", route).write.mode("overwrite").parquet(tables.of_batch("device_feed", batch))

    _together(
        lambda: tables.store.append(with_month(appended), batch),
        lambda: tables.devices.write(newest_per_place(state, appended), batch),
        feed,
    )
    files.put_json(spark, tables.commit_file(batch), {"ingest_batch": batch})


def ingest_stream(
    raw: DataFrame,
    tables: StreamTables,
    resets: Callable[[], DataFrame],
    sensors: DataFrame,
    clock: Callable[[int], datetime] = utc_clock,
    interval: str | None = "5 seconds",
) -> StreamingQuery:
    """Start ingesting ``raw`` (``arrival, value``).

    ``resets`` is called for every batch, so new ledger rows take effect at once.
    ``interval=None`` processes what is there and stops.
    """

    def step(batch_rows: DataFrame, batch: int) -> None:
        ingest_batch(batch_rows, batch, tables, resets(), sensors, clock(batch))

    return _start(raw, step, tables.folder("checkpoint_ingest"), interval)


def summary_stream(
    spark: SparkSession,
    tables: StreamTables,
    resets: Callable[[], DataFrame],
    clock: Callable[[int], datetime] = utc_clock,
    interval: str | None = "3 seconds",
) -> StreamingQuery:
    """Building totals for the ``dashboard`` route, at most once per ``interval``, from the state
    at the newest batch that the ingest stream committed since."""
    commits = tables.folder("commits")
    files.make_folder(spark, commits)
    found = spark.readStream.schema(COMMIT).json(commits)

    def step(committed: DataFrame, batch: int) -> None:
        as_of = clock(batch)
        newest = committed.agg(F.max("ingest_batch")).first()[0]
        if newest is None:
            return
        summary = building_summary(tables.devices.after(spark, newest), resets(), as_of, STREAM_ORDER)
        summary.withColumn("route", F.lit("dashboard")).write.mode("overwrite").parquet(
            tables.of_batch("summary_feed", batch)
        )
        files.put_json(spark, f"{tables.folder('summaries')}/batch-{batch:020d}.json", {"ingest_batch": newest})

    return _start(found, step, tables.folder("checkpoint_summary"), interval)


def _start(source, step, checkpoint: str, interval: str | None) -> StreamingQuery:
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return (
        source.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )

