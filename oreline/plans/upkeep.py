"""Upkeep of stored tables by change sets: rows are merged by key, and only the years that they touch are written again.

A merge writes its result beside the table first and then exchanges the touched years. What a lost run has half exchanged, the next
run finds as old rows of the same keys, so it touches the same years and ends with the same table. The years are noted before the exchange and
struck off when the tables behind are up to date, so a run that is lost in between leaves them to the next.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreline.sources import control, ledger, raw, sinks

MERGED = "table string, load string, rows long, as_of date, keep string, written_at timestamp"
TOUCHED = "table string, year int, opened long, written_at timestamp"
#: Stands for the whole table in the notes of touched years.
ALL_YEARS = -1
Years = list[int | None]


def in_years(column: str, years: Years) -> Column:
    """A filter on the stored year, which Spark turns into a choice of directories; None is the year of rows without a date."""
    known = [y for y in years if y is not None]
    found = F.col(column).isin(known) if known else F.lit(False)
    return found | F.col(column).isNull() if None in years else found


def years_of(df: DataFrame, column: str) -> Years:
    """The distinct years, a handful of numbers."""
    return sorted((r[0] for r in df.select(column).distinct().collect()), key=lambda y: (y is None, y or 0))


def pending(spark: SparkSession, target: str, loads: str, merged: str, table: str) -> tuple[list[str], list[tuple[str, int | None]]]:
    """(loads not merged yet, all loads with their rows): stored directories, but for those that the ledger has begun and not finished.

    A load that was replayed with other rows counts as not merged.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(target)
    stored = [r[0] for r in files.select(F.regexp_extract("path", "/load=([^/]+)/", 1).alias("load")).distinct().collect() if r[0]]
    known = {r["run_id"]: r["rows"] for r in ledger.loads(spark, loads).where(F.col("table") == table).collect()}
    usable = sorted((name, known.get(name)) for name in stored if name not in known or known[name] is not None)
    have = control.read(spark, merged, MERGED).where(F.col("table") == table)
    done = {r["load"]: r["rows"] for r in have.groupBy("load").agg(F.max_by("rows", "written_at").alias("rows")).collect()}
    return [name for name, rows in usable if name not in done or done[name] != rows], usable


def last_state(spark: SparkSession, merged: str, table: str) -> tuple[dt.date | None, str | None]:
    """as_of and keep of the last merge of a table."""
    have = control.read(spark, merged, MERGED).where(F.col("table") == table)
    row = have.agg(F.max_by(F.struct("as_of", "keep"), "written_at").alias("last")).first()["last"]
    return (row["as_of"], row["keep"]) if row else (None, None)


def record(spark: SparkSession, merged: str, table: str, loads: Sequence[tuple[str, int | None]], as_of: dt.date, keep: str, now: dt.datetime) -> None:
    rows = [(table, name, rows, as_of, keep, now) for name, rows in loads]
    control.append(spark, merged, rows, MERGED)


def note(spark: SparkSession, touched: str, table: str, years: Years, now: dt.datetime) -> None:
    """Note years as touched."""
    if years:
        rows = [(table, year, 1, now) for year in years]
        control.append(spark, touched, rows, TOUCHED)


def noted(spark: SparkSession, touched: str) -> dict[str, dict[int | None, int]]:
    """The years of each table that are noted and not struck off, with how often."""
    sums = control.read(spark, touched, TOUCHED).groupBy("table", "year").agg(F.sum("opened").alias("n")).where("n > 0").collect()
    out: dict[str, dict[int | None, int]] = {}
    for row in sums:
        out.setdefault(row["table"], {})[row["year"]] = row["n"]
    return out


def strike(spark: SparkSession, touched: str, done: dict[str, dict[int | None, int]], now: dt.datetime) -> None:
    """Strike off what ``noted`` has returned; notes made since stay."""
    rows = [(table, year, -n, now) for table, years in done.items() for year, n in years.items()]
    if rows:
        control.append(spark, touched, rows, TOUCHED)


def winners(changes: DataFrame, old: Sequence[DataFrame], key: str, order: Sequence[str], keep: str) -> DataFrame:
    """The rows of a change set (one per key) that come before the stored row of their key in the order of the dedup, or have none.

    ``old`` are the tables that hold the stored rows, those that were rejected too; only key and order are read.
    """
    stored = reduce(DataFrame.unionByName, [o.select(key, *order) for o in old])
    stored = stored.select(F.col(key).alias("_key"), F.struct(*order).alias("_stored"))
    # NULL is the lowest value of a struct, as in the dedup.
    mine = F.struct(*order)
    better = mine > F.col("_stored") if keep == "last" else mine < F.col("_stored")
    joined = changes.join(stored, changes[key].eqNullSafe(F.col("_key")), "left")
    return joined.where(F.col("_stored").isNull() | better).select(*changes.columns).dropDuplicates([key])


def write_years(df: DataFrame, path: str, staged: str, column: str, years: Years) -> None:
    """Exchange some years of a table for the rows given; other years keep their files."""
    spark = df.sparkSession
    sinks.write_parquet(df, staged, partition_by=column)
    again = spark.read.schema(df.schema).parquet(staged)
    held = years_of(again, column)
    if held:
        again.select(*df.columns).hint("rebalance", column).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)
    for year in years:
        # A dynamic overwrite leaves years for which it has no row.
        if year not in held:
            sinks.remove(spark, f"{path}/{column}={'__HIVE_DEFAULT_PARTITION__' if year is None else year}")


def touched_years(path: str, key: str, changed: DataFrame, rows: DataFrame, column: str) -> Years:
    """The years that hold the changed keys now, and those of the new rows."""
    old = raw.scan_layer(rows.sparkSession, path)
    keys = changed.select(F.col(key).alias("_key")).distinct()
    held = old.join(keys, old[key].eqNullSafe(F.col("_key")), "left_semi")
    return sorted({*years_of(held, column), *years_of(rows, column)}, key=lambda y: (y is None, y or 0))


def merge(path: str, staged: str, key: str, changed: DataFrame, rows: DataFrame, column: str, years: Years) -> None:
    """Replace the rows of the ``changed`` keys by ``rows`` in a table stored by year, in the years that ``touched_years`` names."""
    if years:
        old = raw.scan_layer(rows.sparkSession, path)
        keys = changed.select(F.col(key).alias("_key")).distinct()
        kept = old.where(in_years(column, years)).join(keys, old[key].eqNullSafe(F.col("_key")), "left_anti")
        write_years(kept.unionByName(rows.select(*old.columns)), path, staged, column, years)


def merge_whole(path: str, staged: str, key: str, changed: DataFrame, rows: DataFrame) -> None:
    """The same for a table that is not stored by year."""
    spark = rows.sparkSession
    if raw.stored(spark, path):
        old = raw.scan_layer(spark, path)
        keys = changed.select(F.col(key).alias("_key")).distinct()
        rows = old.join(keys, old[key].eqNullSafe(F.col("_key")), "left_anti").unionByName(rows, allowMissingColumns=True)
    sinks.write_parquet(rows, staged)
    sinks.write_parquet(raw.scan_layer(spark, staged), path)
