"""Runs every registered query against its SQL: ``python tests/compare.py [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), rows_of(df.columns, df.collect())


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return sorted(columns), rows_of(columns, cursor.fetchall())


def main() -> int:
    import __spark_entry__ as entry
    from tests.session import make_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = make_session()
    con = connect(sf_dir)
    queries, sqls = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in wanted or sqls:
        begin = time.time()
        try:
            got = spark_rows(queries[name](spark, sf_dir))
            spark_seconds = time.time() - begin
            want = duck_rows(con, sqls[name])
            good = got == want
            note = f"{len(got[1])} rows"
            if not good:
                extra = [r for r in got[1] if r not in set(want[1])][:2]
                missing = [r for r in want[1] if r not in set(got[1])][:2]
                note = f"{len(got[1])} / {len(want[1])} rows, {got[0]} / {want[0]}\n  {extra}\n  {missing}"
        except Exception as error:
            good, note, spark_seconds = False, str(error)[:1500], time.time() - begin
        failed += not good
        print(f"{'ok  ' if good else 'FAIL'} {name} {spark_seconds:.2f}s {note}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
