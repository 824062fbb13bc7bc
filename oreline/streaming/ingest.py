"""Files that arrive in a folder, read once each into bronze.

The checkpoint of the stream is the high-water mark. Every micro-batch writes a directory named
after the query and its batch id, so a batch that runs again after a failure replaces its own rows
and no other stream's.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from oreline.plans.bronze import audited
from oreline.schemas import CORRUPT, SourceTable
from oreline.sources import raw
from oreline.sources.raw import text_schema, with_evidence


def read_stream(spark: SparkSession, folder: str, table: SourceTable, max_files: int | None = None) -> DataFrame:
    """Typed rows of the CSV files in a folder, with ``_source_file`` and what did not fit; a file with another header fails."""
    schema = text_schema(table.columns)
    reader = spark.readStream.schema(schema).option("header", True).option("enforceSchema", False).option("columnNameOfCorruptRecord", CORRUPT)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.csv(folder).select(*schema.names, F.col("_metadata.file_name").alias("_source_file"))
    return with_evidence(lines, table)


def drop_repeats(batch: DataFrame, target: str, load: str, within: str) -> DataFrame:
    """Audited rows without those that repeat another in all source columns.

    Rows are compared within the batch and with what other loads stored in ``target`` within a delay such as "1 day"
    before the batch's own stamp. A late row or a new version of a key is no repeat. The batch's own ``load`` is left out, so a batch that
    runs again stores the same rows.
    """
    once = batch.dropDuplicates(["_record_hash"])
    spark = batch.sparkSession
    if not raw.stored(spark, target):
        return once
    before = spark.read.schema("_record_hash string, _ingestion_timestamp timestamp, load string").parquet(target)
    edge = once.agg(F.min("_ingestion_timestamp").alias("first")).select((F.col("first") - F.expr(f"interval {within}")).alias("edge"))
    recent = before.filter((F.col("load") != load) & (F.col("_ingestion_timestamp") >= edge.scalar()))
    return once.join(recent.select("_record_hash").distinct(), "_record_hash", "left_anti").select(*batch.columns)


def ingest_available(
    spark: SparkSession,
    folder: str,
    target: str,
    checkpoint: str,
    table: SourceTable,
    run_ts: dt.datetime | None = None,
    repeats_within: str | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """Start a query that reads the files not seen yet and stops.

    ``max_files`` bounds the files of a micro-batch, not those of the query.
    """
    rows = read_stream(spark, folder, table, max_files)

    def write(batch: DataFrame, batch_id: int) -> None:
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        load = f"stream-{query_id}-{batch_id}"
        stamped = audited(batch, run_ts)
        if repeats_within is not None:
            stamped = drop_repeats(stamped, target, load, repeats_within)
        stamped.write.mode("overwrite").parquet(f"{target}/load={load}")

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
