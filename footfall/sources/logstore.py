"""The live log and its archive as one table under its readers.

Rows lie in folders of one month each. A version is a small file that names the folders of the live
log and those of the archive; it is put in place by renaming, so an append, a retention
run or a compaction changes what readers see at once, and a reader that has its version keeps
seeing that. A reading is in one list of one version exactly once: retention moves the names of old
folders from one list to the other and copies nothing, and compaction replaces the names of many
small folders by one. Writers that meet retry on the version that came first. The folders need
a file system whose rename is atomic; the lists hold a name for each folder, which compaction keeps few.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.functions.times import as_datetime, floor_to, month_start
from footfall.sources import files

#: Folders below this size are merged, into files of about this size.
SMALL_BYTES = 128 << 20
#: A month with fewer small folders is left as it is.
MIN_FOLDERS = 8
MONTH = "part_month"
_EMPTY = {"live": [], "archive": [], "last_batch": -1}


@dataclass(frozen=True)
class Snapshot:
    """Both logs as they were at one version."""

    version: int
    live: DataFrame
    archive: DataFrame


@dataclass(frozen=True)
class LogStore:
    path: str
    schema: T.StructType

    def _versions(self, spark: SparkSession) -> list[int]:
        found = files.names(spark, f"{self.path}/_versions")
        return [int(n[2:-5]) for n in found if n.startswith("v-") and n.endswith(".json")]

    def _file(self, version: int) -> str:
        return f"{self.path}/_versions/v-{version:020d}.json"

    def _current(self, spark: SparkSession) -> tuple[int, dict]:
        known = self._versions(spark)
        return (known[-1], files.read_json(spark, self._file(known[-1]))) if known else (-1, _EMPTY)

    def _change(self, spark: SparkSession, change: Callable[[dict], dict | None]) -> bool:
        """Put ``change`` of the current version in place; again on a newer one if another writer was first."""
        while True:
            version, state = self._current(spark)
            after = change(state)
            if after is None:
                return False
            if files.put_json(spark, self._file(version + 1), after):
                return True

    def _read(self, spark: SparkSession, parts: list[dict]) -> DataFrame:
        if not parts:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*(f"{self.path}/{p['folder']}" for p in parts))

    def snapshot(self, spark: SparkSession, start=None, end=None) -> Snapshot:
        """Both logs; with a range of event times, only the months that it touches are listed."""
        version, state = self._current(spark)
        low = str(month_start(start).date()) if start is not None else ""
        high = str(month_start(end).date()) if end is not None else "9"

        def read(name: str) -> DataFrame:
            return self._read(spark, [p for p in state[name] if p["month"] is None or low <= p["month"] <= high])

        return Snapshot(version, read("live"), read("archive"))

    def live(self, spark: SparkSession) -> DataFrame:
        return self.snapshot(spark).live

    def archive(self, spark: SparkSession) -> DataFrame:
        return self.snapshot(spark).archive

    def _write(self, rows: DataFrame) -> list[dict]:
        """The rows in folders of a month each, which no version names yet."""
        spark = rows.sparkSession
        name = f"data/{uuid.uuid4().hex}"
        month = floor_to(F.col("event_time"), "month").cast("date")
        whole = rows.select(*self.schema.fieldNames()).withColumn(MONTH, month)
        whole.write.partitionBy(MONTH).parquet(f"{self.path}/{name}")
        parts = []
        for folder in files.names(spark, f"{self.path}/{name}"):
            if folder.startswith(f"{MONTH}="):
                value = folder.partition("=")[2]
                size = files.size(spark, f"{self.path}/{name}/{folder}")
                parts.append({"folder": f"{name}/{folder}", "month": None if value.startswith("__") else value, "bytes": size})
        return parts

    def append(self, rows: DataFrame, batch: int | None = None) -> bool:
        """Add rows to the live log. A numbered batch is added once, however often it is sent."""
        spark = rows.sparkSession
        if batch is not None and batch <= self._current(spark)[1]["last_batch"]:
            return False
        parts = self._write(rows)

        def change(state: dict) -> dict | None:
            if batch is not None and batch <= state["last_batch"]:
                return None
            last = state["last_batch"] if batch is None else batch
            return {**state, "live": state["live"] + parts, "last_batch": last}

        return self._change(spark, change)

    def archive_before(self, spark: SparkSession, as_of) -> int:
        """Move the months before that of ``as_of`` to the archive; returns the folders moved."""
        cutoff = str(month_start(as_datetime(as_of)).date())
        moved: list[dict] = []

        def change(state: dict) -> dict | None:
            moved[:] = [p for p in state["live"] if p["month"] is not None and p["month"] < cutoff]
            if not moved:
                return None
            return {**state, "live": [p for p in state["live"] if p not in moved], "archive": state["archive"] + moved}

        self._change(spark, change)
        return len(moved)

    def compact(self, spark: SparkSession, least: int = MIN_FOLDERS, small: int = SMALL_BYTES) -> int:
        """Merge the small folders of each month and log that has at least ``least`` of them;
        returns the folders replaced. Rows of a folder that a reader holds stay until :meth:`clean_up`."""
        replaced = 0
        for name in ("live", "archive"):
            by_month: dict[str | None, list[dict]] = {}
            for part in self._current(spark)[1][name]:
                if part["bytes"] < small:
                    by_month.setdefault(part["month"], []).append(part)
            for parts in by_month.values():
                if len(parts) < least:
                    continue
                count = -(-sum(p["bytes"] for p in parts) // small)
                merged = self._write(self._read(spark, parts).coalesce(count))

                def change(state: dict, parts=parts, merged=merged) -> dict | None:
                    # Retention may have moved them since; they are replaced where they are now.
                    for log in ("live", "archive"):
                        if all(p in state[log] for p in parts):
                            return {**state, log: [p for p in state[log] if p not in parts] + merged}
                    return None

                replaced += len(parts) * self._change(spark, change)
        return replaced

    def clean_up(self, spark: SparkSession, keep: int = 10) -> int:
        """Remove versions but the last ``keep``, and the folders that none of these names and that
        were there before the oldest of them was read. Returns the folders removed. Not to be run
        while a writer is at work."""
        known = self._versions(spark)
        named = set()
        for version in known[-keep:]:
            state = files.read_json(spark, self._file(version))
            named |= {p["folder"] for log in ("live", "archive") for p in state[log]}
        removed = 0
        for folder in files.names(spark, f"{self.path}/data"):
            own = [n for n in files.names(spark, f"{self.path}/data/{folder}") if n.startswith(f"{MONTH}=")]
            gone = [n for n in own if f"data/{folder}/{n}" not in named]
            if len(gone) == len(own):
                files.remove(spark, f"{self.path}/data/{folder}")
            else:
                for n in gone:
                    files.remove(spark, f"{self.path}/data/{folder}/{n}")
            removed += len(gone)
        for version in known[:-keep]:
            files.remove(spark, self._file(version))
        return removed
