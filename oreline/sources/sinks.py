"""Writers: parquet, managed tables, CSV export, JSON reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: str | None = None) -> None:
    """Write a table; with ``partition_by`` one directory per value.

    Each task writes its own files of the values it holds, so the rows are not shuffled again by
    value before the write and no value lands in one task.
    """
    if partition_by is None:
        df.write.mode(mode).parquet(path)
    else:
        df.write.mode(mode).partitionBy(partition_by).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a directory of a table, in whatever store it is."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(conf).delete(place, True)


def replace(spark: SparkSession, path: str, by: str) -> None:
    """Put a finished directory in the place of another of the same store; its files are not written again.

    Where this is cut short, the finished directory is still whole under one of the two names.
    """
    place, fresh = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, by))
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(place.getParent())
    files.delete(place, True)
    if not files.rename(fresh, place):
        raise OSError(f"{by} could not be moved to {path}")
    spark.catalog.refreshByPath(path)


def append_table(df: DataFrame, name: str, fmt: str = "parquet") -> None:
    """Append to a managed table by column name, adding columns the table does not have yet."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        df.write.format(fmt).saveAsTable(name)
        return
    have = spark.table(name).columns
    fresh = [f for f in df.schema.fields if f.name not in have]
    if fresh:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fresh)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
    empty = spark.table(name).limit(0)
    empty.unionByName(df, allowMissingColumns=True).write.format(fmt).mode("append").saveAsTable(name)


def overwrite_table(df: DataFrame, name: str, fmt: str = "parquet") -> None:
    df.write.format(fmt).mode("overwrite").option("overwriteSchema", "true").saveAsTable(name)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with header and without an index column; dates as yyyy-MM-dd."""
    df.write.mode("overwrite").option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)


def write_extract(df: DataFrame, path: str, quoted: bool = True, compression: str | None = None) -> None:
    """A source extract as CSV with header, cells as they are; without quotes a cell with a comma breaks its line."""
    writer = df.write.mode("overwrite").option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    if compression is not None:
        writer = writer.option("compression", compression)
    (writer if quoted else writer.option("quote", "\0").option("escape", "\0").option("emptyValue", "")).csv(path)


def write_json(report: DataFrame, path: str) -> None:
    report.coalesce(1).write.mode("overwrite").json(path)
