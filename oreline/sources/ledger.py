"""The ledger of loads: what each run has read of each table, from which mark to which.

A load writes two records, one before it reads and one after its data is stored. The first fixes the mark it starts from, so a run that
starts again reads from there, whatever other runs have loaded since. The second names the highest mark that was read, the end of any replay.
Records are only appended; one run at a time writes the records of a table.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreline.sources import control

SCHEMA = (
    "table string, seq long, run_id string, state string, load_type string, start_mark string, end_mark string, overlap string, "
    "rows long, without_mark long, written_at timestamp"
)
STARTED, DONE = "started", "done"


class ReplayError(RuntimeError):
    """A load that must not be replaced."""


@dataclass(frozen=True)
class Load:
    """One load of a table: rows above ``start_mark`` (all if None), up to ``end_mark`` where it is known."""

    table: str
    seq: int
    run_id: str
    load_type: str
    start_mark: str | None
    overlap: str | None = None
    end_mark: str | None = None
    rows: int | None = None

    @property
    def done(self) -> bool:
        return self.rows is not None

    @property
    def until(self) -> str | None:
        """The last mark of a replay. A finished load that has seen no mark has none to read either."""
        return (self.end_mark or "0001-01-01") if self.done else None


def records(spark: SparkSession, path: str) -> DataFrame:
    return control.read(spark, path, SCHEMA)


def loads(spark: SparkSession, path: str) -> DataFrame:
    """One row per load: its start, and end_mark, rows and without_mark of its last record of an end (NULL while there is none)."""
    first = F.col("state") == STARTED
    last = lambda c: F.max_by(F.when(~first, F.col(c)), F.when(~first, F.col("written_at"))).alias(c)
    only = lambda c: F.min(F.when(first, F.col(c))).alias(c)
    return records(spark, path).groupBy("table", "seq", "run_id").agg(
        only("load_type"), only("start_mark"), only("overlap"), last("end_mark"), last("rows"), last("without_mark")
    )


def find(spark: SparkSession, path: str, table: str, run_id: str) -> Load | None:
    """The load of a table by a run, if the ledger knows it."""
    row = loads(spark, path).where((F.col("table") == table) & (F.col("run_id") == run_id)).drop("without_mark").first()
    return Load(**row.asDict()) if row else None


def begin(
    spark: SparkSession, path: str, table: str, run_id: str, load_type: str, now: dt.datetime, overlap: str | None = None,
    stored: bool = False,
) -> Load:
    """The load of a run: as it was begun before, or a new one that starts at the highest mark of the finished loads.

    ``stored`` says that data of the run is there already; without a record of it, it must not be overwritten.
    """
    rows = loads(spark, path).where(F.col("table") == table)
    at = F.when(F.col("rows").isNotNull(), F.try_to_timestamp(F.col("end_mark")))
    mine = F.max(F.when(F.col("run_id") == run_id, F.struct("table", "seq", "run_id", "load_type", "start_mark", "overlap", "end_mark", "rows")))
    seen = rows.agg(F.max("seq").alias("seq"), F.max_by("end_mark", at).alias("mark"), mine.alias("mine")).first()
    if seen["mine"] is not None:
        known = Load(**seen["mine"].asDict())
        if known.load_type != load_type:
            raise ReplayError(f"run {run_id} has loaded {table} as {known.load_type}, not {load_type}")
        return known
    if stored:
        raise ReplayError(f"there is a load {run_id} of {table} that the ledger does not know")
    start = seen["mark"] if load_type == "incremental" else None
    load = Load(table, (seen["seq"] or 0) + 1, run_id, load_type, start, overlap)
    row = (table, load.seq, run_id, STARTED, load_type, start, None, overlap, None, None, now)
    control.append(spark, path, [row], SCHEMA)
    return load


def finish(spark: SparkSession, path: str, load: Load, end_mark: str | None, rows: int, without_mark: int, now: dt.datetime) -> None:
    """Record the end of a load; call it only after its data is stored. A load that read nothing new ends where it started."""
    end = load.start_mark if end_mark is None else end_mark
    row = (load.table, load.seq, load.run_id, DONE, load.load_type, load.start_mark, end, load.overlap, rows, without_mark, now)
    control.append(spark, path, [row], SCHEMA)
