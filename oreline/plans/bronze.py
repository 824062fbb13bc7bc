"""Bronze: audited loads of the source extracts and their quality reports."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from oreline.operators import audit, profile
from oreline.schemas import AUDIT_COLUMNS, CORRUPT, EVIDENCE_COLUMNS, SourceTable
from oreline.sources import raw, sinks
from oreline.sources.ledger import ReplayError


def audited(df: DataFrame, run_ts: dt.datetime | None = None, layer: str = "bronze") -> DataFrame:
    """Add the audit columns to a scan that carries ``_source_file``."""
    columns = [c for c in df.columns if c not in ("_source_file", *EVIDENCE_COLUMNS)]
    named = df.withColumnRenamed("_source_file", "_file")
    return audit.add_audit(named, columns, run_ts, F.col("_file"), layer).drop("_file")


@dataclass(frozen=True)
class Counts:
    """What the write of a load has counted: rows, those without a usable watermark, and the highest watermark as it is written."""

    rows: int
    without_mark: int
    mark: str | None


def ingest(
    spark: SparkSession,
    source: str | list[str],
    target: str,
    table: SourceTable,
    load_id: str,
    run_ts: dt.datetime | None = None,
    load_type: str = "full",
    mark: str | None = None,
    overlap: str | None = None,
    until: str | None = None,
    known: DataFrame | None = None,
    least: int | None = None,
) -> tuple[DataFrame, Counts]:
    """Write one load of a table as a directory of its own; returns the stored load and what the write has counted.

    The text is parsed and counted once, while it is written. ``known`` holds hashes of rows without a usable watermark that earlier loads
    have; they are not loaded again. A load that is read again (``least`` is the rows it had) is written beside the stored one first
    and takes its place only if it has at least as many rows; otherwise ReplayError is raised and the stored load stays.
    """
    loaded = raw.load(raw.scan_evident(spark, source, table), table, load_type, mark, overlap, until)
    if known is not None:
        unmarked = F.try_to_timestamp(F.col(table.watermark).cast("string")).isNull()
        fresh = loaded.where(unmarked).join(known.select("_record_hash"), "_record_hash", "left_anti").select(*loaded.columns)
        loaded = loaded.where(~unmarked).unionByName(fresh)
    path = f"{target}/load={load_id}"
    if least is None:
        counts = _write(audited(loaded, run_ts), path, table)
    else:
        # Outside the table, so that readers of all loads never see it.
        staged = f"{target}__replay/{load_id}"
        counts = _write(audited(loaded, run_ts), staged, table)
        if counts.rows < least:
            raise ReplayError(f"load {load_id} of {table.name} had {least} rows, its source now gives {counts.rows}; the stored load stays")
        sinks.replace(spark, path, by=staged)
    return spark.read.parquet(path), counts


def _write(df: DataFrame, path: str, table: SourceTable) -> Counts:
    text = F.col(table.watermark).cast("string")
    at = F.try_to_timestamp(text)
    seen = Observation()
    counted = df.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if(at.isNull()).alias("without_mark"), F.max(F.when(at.isNotNull(), F.struct(at, text.alias("mark")))).alias("top"),
    )
    # Half of a row is its hash, 64 hex digits; zstd packs two into a byte, snappy packs none.
    counted.write.mode("overwrite").option("compression", "zstd").parquet(path)
    found = seen.get
    return Counts(found["rows"], found["without_mark"], found["top"]["mark"] if found["top"] else None)


def read_loads(spark: SparkSession, target: str, loads: Sequence[str], table: SourceTable) -> DataFrame:
    """The records of some loads of a table; columns that only some loads have are NULL in the others.

    Corrupt records have no reliable cells and stay in bronze; the report counts them.
    """
    return _records(spark.read.option("mergeSchema", True).parquet(*[f"{target}/load={name}" for name in loads]), table)


def read_all(spark: SparkSession, target: str, table: SourceTable) -> DataFrame:
    """The same of all loads."""
    return _records(raw.scan_layer(spark, target, merge_schema=True).drop("load"), table)


def _records(stored: DataFrame, table: SourceTable) -> DataFrame:
    if CORRUPT in stored.columns:
        stored = stored.where(F.col(CORRUPT).isNull())
    return raw.conform(stored.drop(*EVIDENCE_COLUMNS), table)


def corrupt_records(spark: SparkSession, target: str) -> DataFrame:
    """The lines of all loads that did not parse: load, _source_file, _corrupt_record."""
    stored = raw.scan_layer(spark, target, merge_schema=True)
    return stored.where(F.col(CORRUPT).isNotNull()).select("load", "_source_file", CORRUPT)


def report(load: DataFrame, table: SourceTable) -> DataFrame:
    """Quality report of a stored load, over its source columns."""
    source = load.drop(*[c for c in AUDIT_COLUMNS if c != "_record_hash"])
    return profile.profile(source, table.columns, table.name, stored_hash="_record_hash")


def high_mark(load: DataFrame, table: SourceTable) -> str | None:
    """The highest watermark of a stored load, as it is written; what is no time does not count."""
    text = F.col(table.watermark).cast("string")
    at = F.try_to_timestamp(text)
    return load.where(at.isNotNull()).agg(F.max_by(text, at).alias("mark")).first()["mark"]
