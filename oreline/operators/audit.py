"""Audit columns and the content hash."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NULL_MARK = "-1:"


def record_hash(columns: Iterable[str]) -> Column:
    """SHA-256 of the row content. Each value follows its length, NULL has length -1, so no two rows share a text."""
    values = [F.col(c).cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.length(v).cast("string"), F.lit(":"), v), F.lit(NULL_MARK)) for v in values]
    return F.sha2(F.concat(*parts), 256)


def add_audit(
    df: DataFrame,
    columns: Iterable[str],
    run_ts: dt.datetime | None = None,
    source_file: str | Column | None = None,
    layer: str = "bronze",
) -> DataFrame:
    """Add the four audit columns; the hash covers ``columns`` only and so is stable over runs.

    ``source_file`` defaults to the file each row was scanned from. A hash that the scan has taken over the text stays.
    """
    stamp = F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")
    if source_file is None:
        source_file = F.col("_metadata.file_name")
    elif isinstance(source_file, str):
        source_file = F.lit(source_file)
    digest = F.col("_record_hash") if "_record_hash" in df.columns else record_hash(columns)
    return df.select(
        *[c for c in df.columns if c != "_record_hash"],
        stamp.alias("_ingestion_timestamp"),
        source_file.alias("_source_file"),
        F.lit(layer).alias("_layer"),
        digest.alias("_record_hash"),
    )


def stamp_silver(df: DataFrame, run_ts: dt.datetime | None = None, valid: bool = False) -> DataFrame:
    stamp = F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")
    df = df.withColumn("_silver_processed_at", stamp)
    return df.withColumn("_silver_valid", F.lit(True)) if valid else df
