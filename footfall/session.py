"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_local_base: str | None = None


def configure(spark: SparkSession) -> SparkSession:
    """Set the runtime options that results depend on; safe to call repeatedly."""
    # Payload offsets are turned into UTC wall clock time.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # A repeated JSON key keeps its last value instead of failing the message.
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh folder below the one the cluster names in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster the
    executors could not read each other's files there.
    """
    global _local_base
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if _local_base is None:
            _local_base = tempfile.mkdtemp(prefix="footfall-")
        base = _local_base
    return f"{base.rstrip('/')}/footfall/{name}-{uuid.uuid4().hex}"
