"""Splitting the log into live and archive at a cut-off."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall import schemas
from footfall.functions.times import month_start, ts


@dataclass(frozen=True)
class ArchiveSplit:
    moved: DataFrame
    archive: DataFrame
    live: DataFrame


def cutoff_for(as_of):
    """Rows before the start of the current month are old."""
    return month_start(as_of)


def old_rows(live: DataFrame, cutoff) -> DataFrame:
    return live.filter(F.col("event_time") < ts(cutoff))


def rows_to_move(live: DataFrame, archive: DataFrame, cutoff) -> DataFrame:
    """Old rows that are not archived yet, told by id or key."""
    return _beside(old_rows(live, cutoff), archive, "left_anti")


def rows_to_delete(live: DataFrame, archive: DataFrame, cutoff) -> DataFrame:
    """Old rows that are archived; also finds what a run that stopped half-way left."""
    return _beside(old_rows(live, cutoff), archive, "left_semi")


def _beside(live: DataFrame, archive: DataFrame, how: str) -> DataFrame:
    names = [name for name in schemas.ROW_KEY if name in live.columns and name in archive.columns]
    if names == ["id"]:
        return live.join(archive.select("id"), "id", how).select(*live.columns)
    known = archive.select(*[F.col(name).alias(f"archived_{name}") for name in names])
    on = [F.col(name).eqNullSafe(F.col(f"archived_{name}")) for name in names]
    return live.join(known, on, how)


def archive_split(live: DataFrame, archive: DataFrame, cutoff) -> ArchiveSplit:
    """What a complete run moves, and both tables after it.

    After the move every old row's id is in the archive, so the rows that stay
    live are simply those that are not old; no second join is needed.
    """
    moved = rows_to_move(live, archive, cutoff)
    is_old = F.coalesce(F.col("event_time") < ts(cutoff), F.lit(False))
    return ArchiveSplit(
        moved=moved,
        archive=archive.unionByName(moved.select(*archive.columns)),
        live=live.filter(~is_old),
    )
