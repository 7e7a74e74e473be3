"""Every registered query gives the rows of its SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from footfall import fixtures as fx
from tests.compare import connect, duck_rows, spark_rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_same_names():
    queries, sqls = set(entry.queries()), set(entry.oracle_sql())
    assert sqls <= queries
    # Only the training-data queries may be checked in their own tests instead.
    assert all(name == "pipeline" or name.startswith("op") for name in queries - sqls)


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query(spark, con, name):
    got = spark_rows(entry.queries()[name](spark, SF))
    assert got == duck_rows(con, entry.oracle_sql()[name])


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_payloads_are_made_without_the_events_and_the_log(spark, monkeypatch):
    want = spark_rows(fx.raw_payloads(spark, SF))
    kept = {key: path for key, path in fx._paths.items() if key[2] == "counted"}
    monkeypatch.setattr(fx, "_paths", kept)
    monkeypatch.setattr(fx, "events", None)
    monkeypatch.setattr(fx, "counter_log", None)
    assert spark_rows(fx.raw_payloads(spark, SF)) == want
