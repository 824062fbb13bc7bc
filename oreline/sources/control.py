"""High-water marks and run logs as small append-only tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreline.sources.raw import stored

MARK_SCHEMA = "table string, mark string, run_id string, written_at timestamp"
RUN_SCHEMA = "logged_at timestamp, pipeline string, status string, run_id string"
FAILURE_SCHEMA = "table string, stage string, error string, logged_at timestamp, run_id string"


def append(spark: SparkSession, path: str, rows: list[tuple], schema: str) -> None:
    """Add some records. They go to Spark as literals, which needs no Python worker."""
    fields = T.StructType.fromDDL(schema).fields
    one = lambda row: F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields)])
    spark.range(1, numPartitions=1).select(F.inline(F.array(*map(one, rows)))).write.mode("append").parquet(path)


def read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    if stored(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def read_marks(spark: SparkSession, path: str, without_run: str | None = None) -> DataFrame:
    """table, mark: the highest mark of every table; ``without_run`` leaves out what that run has recorded."""
    marks = read(spark, path, MARK_SCHEMA)
    if without_run is not None:
        marks = marks.filter(F.col("run_id") != without_run)
    at = F.try_to_timestamp(F.col("mark"))
    return marks.where(at.isNotNull()).groupBy("table").agg(F.max_by("mark", at).alias("mark"))


def last_mark(spark: SparkSession, path: str, table: str, without_run: str | None = None) -> str | None:
    row = read_marks(spark, path, without_run).filter(F.col("table") == table).first()
    return row["mark"] if row else None


def advance_mark(
    spark: SparkSession, path: str, table: str, mark: str | None, run_id: str, now: dt.datetime
) -> None:
    """Record a new mark; call it only after the data of the run is written."""
    if mark is not None:
        append(spark, path, [(table, mark, run_id, now)], MARK_SCHEMA)


def log_run(spark: SparkSession, path: str, pipeline: str, status: str, run_id: str, now: dt.datetime) -> None:
    append(spark, path, [(now, pipeline, status, run_id)], RUN_SCHEMA)


def log_failure(
    spark: SparkSession, path: str, table: str, stage: str, error: BaseException, run_id: str, now: dt.datetime
) -> None:
    append(spark, path, [(table, stage, f"{type(error).__name__}: {error}", now, run_id)], FAILURE_SCHEMA)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return read(spark, path, RUN_SCHEMA)


def read_failures(spark: SparkSession, path: str) -> DataFrame:
    return read(spark, path, FAILURE_SCHEMA)
