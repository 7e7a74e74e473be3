"""Small files next to the tables, on whatever file system holds them."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, files = _at(spark, path)
    return files.exists(where)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if it does not exist."""
    where, files = _at(spark, folder)
    if not files.exists(where):
        return []
    return sorted(entry.getPath().getName() for entry in files.listStatus(where))


def remove(spark: SparkSession, path: str) -> bool:
    where, files = _at(spark, path)
    return files.delete(where, True)


def read_json(spark: SparkSession, path: str):
    where, files = _at(spark, path)
    stream = files.open(where)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def put_json(spark: SparkSession, path: str, value) -> bool:
    """Put a file in place by renaming: it appears whole or not at all. False if there is one already."""
    where, files = _at(spark, path)
    if files.exists(where):
        return False
    parent = where.getParent()
    files.mkdirs(parent)
    # Names that begin with a dot are not read by any source.
    draft = spark._jvm.org.apache.hadoop.fs.Path(parent, f".{where.getName()}-{uuid.uuid4().hex}")
    out = files.create(draft)
    try:
        out.write(bytearray(json.dumps(value).encode()))
    finally:
        out.close()
    if files.exists(where) or not files.rename(draft, where):
        files.delete(draft, False)
        return False
    return True


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder."""
    where, files = _at(spark, path)
    return files.getContentSummary(where).getLength()


def make_folder(spark: SparkSession, path: str) -> None:
    where, files = _at(spark, path)
    files.mkdirs(where)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder; the new one must not be there yet."""
    where, files = _at(spark, path)
    target = spark._jvm.org.apache.hadoop.fs.Path(to)
    files.mkdirs(target.getParent())
    if files.exists(target) or not files.rename(where, target):
        raise FileExistsError(to)
