"""Keyed tables that a stream updates with every micro-batch, cut into hash buckets.

A version of the table is one small file that names the folder of each bucket. A batch reads the
buckets its keys fall into, writes these anew, and puts its version in place by renaming; all
other buckets stay where they are. Buckets double when they hold more than ``BUCKET_BYTES``
on average, so what a batch reads and writes follows its own keys, not the size of the table.
A batch that is replayed after a failure starts from the version before it, which stays, and
one that has its version already is left alone. The tables live in shared storage, so losing an
executor or the driver loses nothing.

Keeping the state as a table instead of inside a keyed operator lets a batch be
split by device and time: one very active device does not become one task.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.sources import files

BUCKET_BYTES = 4 << 20
BUCKET = "state_bucket"


@dataclass(frozen=True)
class StateTable:
    """``keys``: columns whose values a row is found by; the first of them deals the buckets."""

    path: str
    schema: T.StructType
    keys: tuple[str, ...] = ("device_id",)
    bucket_bytes: int = BUCKET_BYTES
    #: A number column whose highest value so far is kept with each version.
    highest: str | None = None

    def _version_file(self, batch: int) -> str:
        return f"{self.path}/versions/v-{batch:020d}.json"

    def _version(self, spark: SparkSession, batch: int) -> dict:
        """``buckets`` (their number), ``folders`` and their ``bytes`` by bucket."""
        if batch < 0:
            return {"buckets": 1, "folders": {}, "bytes": {}}
        return files.read_json(spark, self._version_file(batch))

    def bucket_of(self, buckets: int, key: str | None = None):
        return F.pmod(F.xxhash64(key or self.keys[0]), F.lit(buckets)).cast("int")

    def _read(self, spark: SparkSession, version: dict, wanted: set[int] | None = None) -> DataFrame:
        picked = [f for b, f in version["folders"].items() if wanted is None or int(b) in wanted]
        if not picked:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*(f"{self.path}/{f}" for f in picked))

    def before(self, spark: SparkSession, batch: int, initial: DataFrame | None = None) -> DataFrame:
        """The whole state that batch ``batch`` starts from."""
        if batch == 0 and initial is not None:
            return initial
        return self.after(spark, batch - 1)

    def after(self, spark: SparkSession, batch: int) -> DataFrame:
        return self._read(spark, self._version(spark, batch))

    def has(self, spark: SparkSession, batch: int) -> bool:
        return files.exists(spark, self._version_file(batch))

    def touched(
        self, spark: SparkSession, batch: int, rows: DataFrame, key: str, initial: DataFrame | None = None
    ) -> DataFrame:
        """The state before a batch, of the buckets that the keys of ``rows`` fall into."""
        version = self._version(spark, batch - 1)
        if not version["folders"]:
            return initial.select(*self.schema.fieldNames()) if initial is not None else self._read(spark, version)
        if version["buckets"] == 1:
            return self._read(spark, version)
        # As many numbers as buckets at most.
        wanted = {r[0] for r in rows.select(self.bucket_of(version["buckets"], key)).distinct().collect()}
        return self._read(spark, version, wanted)

    def write(self, state: DataFrame, batch: int) -> None:
        """Put ``state`` in the place of the buckets that its rows fall into."""
        spark = state.sparkSession
        if self.has(spark, batch):
            return
        version = self._version(spark, batch - 1)
        buckets = version["buckets"]
        held = {b: (folder, version["bytes"][b]) for b, folder in version["folders"].items()}
        held |= self._write(state, buckets, batch)
        # Smaller files compress less, so the size is taken again after the buckets are doubled.
        while (size := sum(n for _, n in held.values())) > buckets * self.bucket_bytes:
            while size > buckets * self.bucket_bytes:
                buckets *= 2
            held = self._write(self._read(spark, {"folders": {b: f for b, (f, _) in held.items()}}), buckets, batch)
        found = {"folders": {b: f for b, (f, _) in held.items()}, "bytes": {b: n for b, (_, n) in held.items()}}
        if self.highest:
            # Only what the batch has written is read.
            own = [f for f in found["folders"].values() if f not in version["folders"].values()]
            top = self._read(spark, {"folders": dict(enumerate(own))}).agg(F.max(self.highest)).first()[0] if own else None
            found["highest"] = max((n for n in (version.get("highest"), top) if n is not None), default=None)
        files.put_json(spark, self._version_file(batch), {"buckets": buckets, **found})

    def highest_before(self, spark: SparkSession, batch: int) -> int | None:
        """The highest value of the ``highest`` column before a batch; None if no batch kept one."""
        return self._version(spark, batch - 1).get("highest")

    def _write(self, state: DataFrame, buckets: int, batch: int) -> dict[str, tuple[str, int]]:
        spark = state.sparkSession
        name = f"rows/{batch:020d}-{uuid.uuid4().hex[:8]}"
        state = state.select(*self.schema.fieldNames())
        # Tasks of bounded size, also for a bucket that one batch makes large; what is little goes
        # into one file. The steps before keep their own tasks.
        if buckets == 1:
            # Needs no sorting by bucket, however large a first state is.
            only = f"{name}/{BUCKET}=0"
            state.hint("rebalance", self.keys[0]).write.parquet(f"{self.path}/{only}")
            # No rows replace no bucket.
            if self._read(spark, {"folders": {"0": only}}).isEmpty():
                return {}
        else:
            dealt = state.withColumn(BUCKET, self.bucket_of(buckets)).hint("rebalance", BUCKET)
            dealt.write.partitionBy(BUCKET).parquet(f"{self.path}/{name}")
        written = [n for n in files.names(spark, f"{self.path}/{name}") if n.startswith(f"{BUCKET}=")]
        return {n.partition("=")[2]: (f"{name}/{n}", files.size(spark, f"{self.path}/{name}/{n}")) for n in written}

    def clean_up(self, spark: SparkSession, oldest: int) -> int:
        """Remove the versions before ``oldest`` and the folders that no later one names."""
        kept, gone = [], []
        for name in files.names(spark, f"{self.path}/versions"):
            if name.startswith("v-"):
                (gone if int(name[2:-5]) < oldest else kept).append(name)
        if not kept or not gone:
            return 0
        # A folder stays if the oldest kept version names it, or if it was written since.
        named = set(files.read_json(spark, f"{self.path}/versions/{kept[0]}")["folders"].values())
        removed = 0
        for folder in files.names(spark, f"{self.path}/rows"):
            if int(folder[:20]) > int(kept[0][2:-5]):
                continue
            for bucket in files.names(spark, f"{self.path}/rows/{folder}"):
                if f"rows/{folder}/{bucket}" not in named and bucket.startswith(f"{BUCKET}="):
                    files.remove(spark, f"{self.path}/rows/{folder}/{bucket}")
                    removed += 1
            if not any(n.startswith(f"{BUCKET}=") for n in files.names(spark, f"{self.path}/rows/{folder}")):
                files.remove(spark, f"{self.path}/rows/{folder}")
        for name in gone:
            files.remove(spark, f"{self.path}/versions/{name}")
        return removed


def remove(spark: SparkSession, folder: str, up_to: int) -> int:
    """Remove the folders of the batches up to and including ``up_to``."""
    removed = 0
    for name in files.names(spark, folder):
        kind, _, batch = name.partition("=")
        if kind == "ingest_batch" and int(batch) <= up_to:
            removed += files.remove(spark, f"{folder}/{name}")
    return removed
