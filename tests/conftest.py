from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from footfall import schemas
from footfall.session import configure
from tests.session import make_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = make_session(
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        }
    )
    yield configure(session)


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


class Tables:
    """Small tables from short tuples."""

    def __init__(self, spark):
        self.spark = spark

    def log(self, *rows):
        """``id, device, location, in, out, event_time[, created_at[, sublocation]]``"""
        full = []
        for row in rows:
            number, device, place, count_in, count_out, when = row[:6]
            arrived = row[6] if len(row) > 6 else when
            floor = row[7] if len(row) > 7 else None
            full.append(
                (number, device, place, floor, count_in, count_out, 100, at(when), at(arrived))
            )
        return self.spark.createDataFrame(full, schemas.LOG)

    def resets(self, *rows):
        """``device, reset_time, in, out``"""
        return self.spark.createDataFrame([(d, at(t), i, o) for d, t, i, o in rows], schemas.RESETS)

    def sensors(self, *rows):
        """``device, location, ip, last_seen, status``"""
        full = [
            (n, device, place, ip, status == "Online", seen and at(seen), status)
            for n, (device, place, ip, seen, status) in enumerate(rows)
        ]
        return self.spark.createDataFrame(full, schemas.SENSORS)

    def messages(self, *values, start: int = 0):
        rows = [(start + n, value) for n, value in enumerate(values)]
        return self.spark.createDataFrame(rows, schemas.RAW)


@pytest.fixture
def t(spark):
    return Tables(spark)


def in_order(values):
    """Sorted by column, nulls last."""
    return sorted(values, key=lambda row: [(v is None, 0 if v is None else v) for v in row])


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return in_order(tuple(r) for r in picked.collect())
