"""Runs over extracts that are written from the test tables: loads in two drops with a replay, and a scan of damaged cells."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreline.operators import profile
from oreline.plans import bronze
from oreline.plans.pipeline import Run
from oreline.schemas import TABLES, SourceTable
from oreline.session import freed_shuffles, shared_folder
from oreline.sources import ledger, sinks
from oreline.sources.binding import AS_OF, bind

#: Rows up to here are in the first drop.
CUT = "1998-06-30 12:00:00"


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/oreline/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def write_drops(spark: SparkSession, folder: str, root: str, names: Iterable[str] = TABLES) -> None:
    """Tables as extracts in two drops, below ``a`` and ``b``, split by their watermark."""
    for name in names:
        table = TABLES[name]
        df = bind(spark, folder, name)
        early = F.col(table.watermark).cast("timestamp") <= F.lit(CUT).cast("timestamp")
        for drop, part in (("a", early), ("b", ~early)):
            sinks.write_extract(df.where(part), f"{root}/{drop}/{table.file_name}", compression="gzip")


def drops(spark: SparkSession, folder: str, names: Iterable[str] = TABLES) -> tuple[str, Run, Run]:
    """(place of the drops, a run that sees the first, a run that sees both)."""
    root = _folder(spark, "drops")
    write_drops(spark, folder, root, names)
    stamp = dt.datetime.combine(AS_OF, dt.time())
    first = Run(spark, f"{root}/a", f"{root}/lake", "r1", AS_OF, stamp)
    return root, first, Run(spark, f"{root}/[ab]", f"{root}/lake", "r2", AS_OF, stamp + dt.timedelta(days=1))


def held(stored: DataFrame, table: SourceTable) -> list[DataFrame]:
    """What each stored load of a table holds, as parts with one row per load: rows and marks, distinct keys, distinct hashes.

    Each part reduces its own column by a hash aggregate over few bytes a row. All counts in one aggregate would repeat the rows for
    every distinct count and sort them by load, as the marks are text.
    """
    at = F.col(table.watermark).cast("string").alias("at")
    marks = stored.groupBy("load", at).agg(F.count(F.lit(1)).alias("n"))
    distinct = lambda c: stored.where(c.isNotNull()).select("load", c.alias("value")).distinct().groupBy("load")
    return [
        marks.groupBy("load").agg(F.sum("n").alias("rows"), F.min("at").alias("first_mark"), F.max("at").alias("last_mark")),
        distinct(F.col(table.key)).agg(F.count(F.lit(1)).alias("keys")),
        distinct(F.unhex("_record_hash")).agg(F.count(F.lit(1)).alias("distinct_rows")),
    ]


def two_loads(spark: SparkSession, folder: str) -> DataFrame:
    """Two loads of every table, the first replayed when the source holds the rows of both: one row per table and load.

    One table is loaded and counted after the other. Its extracts go after its last load and the shuffle files of each step with the step,
    so that disk holds the stored loads and what one step of one table needs.
    """
    root, first, second = drops(spark, folder, ())
    again = Run(spark, second.landing, first.root, "r1", AS_OF, second.run_ts + dt.timedelta(days=1))
    counted = []
    with freed_shuffles(spark):
        # Large facts first, before loads of other tables lie beside their extracts.
        for name in reversed(TABLES):
            table = TABLES[name]
            write_drops(spark, folder, root, [name])
            for run in (first, second, again):
                run.bronze(name)
            for drop in ("a", "b"):
                sinks.remove(spark, f"{root}/{drop}/{table.file_name}")
            for k, part in enumerate(held(first.read("bronze", name), table)):
                path = f"{root}/held/{name}/{k}"
                sinks.write_parquet(part, path)
                counted.append(spark.read.schema(part.schema).parquet(path).select(F.lit(name).alias("table"), "*"))
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), counted).groupBy("table", "load").agg(
        F.sum("rows").alias("rows"), F.sum("keys").alias("keys"), F.min("first_mark").alias("first_mark"), F.max("last_mark").alias("last_mark"),
        F.sum("distinct_rows").alias("distinct_rows"),
    )
    loads = ledger.loads(spark, first.path("control", "loads")).select(
        "table", F.col("run_id").alias("load"), "seq", "start_mark", "end_mark", F.col("rows").alias("ledger_rows")
    )
    return loads.join(whole, ["table", "load"], "left").na.fill(0, ["rows", "keys", "distinct_rows"])


def damaged_extracts(spark: SparkSession, folder: str, root: str) -> dict[str, str]:
    """Extracts with cells that do not fit their type and lines with a cell too many: table name to path."""
    bill = F.col("bill_id").substr(5, 20).cast("long")
    day = F.dayofmonth("snapshot_date")
    text = lambda c: F.col(c).cast("string")
    planted = {
        "patients": {},
        "billing": {
            "total_amount": F.when(bill % 97 == 0, "n/k").otherwise(text("total_amount")),
            "misc_charges": F.when(bill % 89 == 0, "12.50 INR").otherwise(text("misc_charges")),
            "created_at": F.when(bill % 101 == 0, F.concat(text("created_at"), F.lit(",?"))).otherwise(text("created_at")),
        },
        "bed_occupancy": {
            "occupied_beds": F.when(day % 7 == 0, F.concat(text("occupied_beds"), F.lit(".5"))).otherwise(F.concat(text("occupied_beds"), F.lit(".0"))),
            "total_beds": F.when(day % 5 == 0, "many").otherwise(text("total_beds")),
        },
    }
    paths = {}
    for name, cells in planted.items():
        paths[name] = f"{root}/{TABLES[name].file_name}"
        sinks.write_extract(bind(spark, folder, name).withColumns(cells), paths[name], quoted=False)
    return paths


def evidence(spark: SparkSession, folder: str) -> DataFrame:
    """What the report says of damaged extracts: one row per table and column with rejected cells (one without a column if there are none)."""
    root = _folder(spark, "damaged")
    reports = []
    for name, path in damaged_extracts(spark, folder, root).items():
        stored, _ = bronze.ingest(spark, path, f"{root}/bronze/{name}", TABLES[name], "r1")
        reports.append(bronze.report(stored, TABLES[name]))
    return profile.summary(reports).select(
        "table", "row_count", "duplicate_rows", "corrupt_records", "status", F.explode_outer("rejected_cells").alias("column_name", "rejected")
    )
