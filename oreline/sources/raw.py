"""Raw CSV scans, landing-zone manifest, layer scans and incremental filters."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreline.operators.audit import record_hash
from oreline.schemas import CORRUPT, REJECTED, SourceTable

# Texts that a CSV cell may use for a missing value.
MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def _cell(name: str) -> Column:
    return F.when(~F.col(name).isin(MISSING), F.col(name))


def scan_text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A CSV with header as text columns, missing-value texts as NULL, no inference pass."""
    raw = spark.read.option("header", True).option("enforceSchema", False).csv(path)
    return raw.select(*[_cell(c).alias(c) for c in raw.columns], F.col("_metadata.file_name").alias("_source_file"))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give a scan with fewer splits than cores to all cores.

    A file that cannot be split feeds one task, which then does all the work up to the next
    shuffle. A large table has far more splits than cores and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def conform(df: DataFrame, table: SourceTable) -> DataFrame:
    """Add declared columns a load did not bring, as NULL."""
    absent = [c for c in table.columns if c not in df.columns]
    return df.withColumns({c: F.lit(None).cast(table.type_of(c)) for c in absent})


def _typed(c: str, table: SourceTable) -> Column:
    """The cell as its declared type, NULL where it does not fit; unknown columns stay text."""
    kind = table.type_of(c).simpleString()
    if c not in table.columns or kind == "string":
        return F.col(c)
    if kind != "int":
        return F.col(c).try_cast(kind)
    # Integers through double, so that one written as "3.0" is read as 3; 3.5 is none.
    number = F.col(c).try_cast("double")
    return F.when(number == F.floor(number), number.try_cast("int"))


def apply_types(df: DataFrame, table: SourceTable) -> DataFrame:
    """Cast to the declared types; a cell that does not fit becomes NULL, unknown columns stay text."""
    return df.select(*[_typed(c, table).alias(c) for c in df.columns])


def scan_raw(spark: SparkSession, path: str | list[str], table: SourceTable) -> DataFrame:
    """Typed scan of one source table, plus ``_source_file``."""
    return apply_types(scan_text(spark, path), table)


def text_schema(columns: Iterable[str]) -> T.StructType:
    """Text columns and the one for lines that do not parse."""
    return T.StructType([T.StructField(c, T.StringType()) for c in [*columns, CORRUPT]])


def with_evidence(lines: DataFrame, table: SourceTable) -> DataFrame:
    """Typed columns of scanned text, and what the types or the parser could not take.

    ``_rejected_cells`` maps a column to the text of its cell where that is not missing and does not fit the type, NULL when all fit.
    ``_corrupt_record`` is the line where it has too many or too few cells. ``_record_hash`` covers the text as it was read, so two
    rows that differ only in a rejected cell differ in their hash.
    """
    cells = [c for c in lines.columns if c not in (CORRUPT, "_source_file")]
    digest = F.when(F.col(CORRUPT).isNull(), record_hash(cells)).otherwise(F.sha2(F.col(CORRUPT), 256))
    read = lines.select(*[_cell(c).alias(c) for c in cells], CORRUPT, "_source_file", digest.alias("_record_hash"))
    typed = [c for c in cells if c in table.columns and table.type_of(c).simpleString() != "string"]
    lost = [
        F.when(F.col(c).isNotNull() & _typed(c, table).isNull(), F.struct(F.lit(c).alias("key"), F.col(c).alias("value"))) for c in typed
    ]
    rejected = F.lit(None).cast("map<string,string>")
    if lost:
        found = F.filter(F.array(*lost), lambda e: e.isNotNull())
        rejected = F.when(F.col(CORRUPT).isNull() & (F.size(found) > 0), F.map_from_entries(found))
    return read.select(*[_typed(c, table).alias(c) for c in cells], rejected.alias(REJECTED), CORRUPT, "_source_file", "_record_hash")


def scan_evident(spark: SparkSession, path: str | list[str], table: SourceTable) -> DataFrame:
    """Typed scan of one source table that loses no cell: see ``with_evidence``."""
    reader = spark.read.option("header", True).option("enforceSchema", False)
    schema = text_schema(reader.csv(path).columns)
    lines = reader.schema(schema).option("columnNameOfCorruptRecord", CORRUPT).csv(path)
    return with_evidence(lines.select(*schema.names, F.col("_metadata.file_name").alias("_source_file")), table)


def scan_layer(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def stored(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at a path, in whatever store it is; no job is run."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def stored_bytes(spark: SparkSession, *paths: str) -> int:
    """Total size of the files below some paths, from their listing."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    return files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("n")).first()["n"]


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Name, change time and size of the files in a folder; contents are not read."""
    files = spark.read.format("binaryFile").load(folder)
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("modificationTime").alias("last_modified"),
        F.col("length").alias("size"),
    )


def check_files(spark: SparkSession, folder: str, expected: Sequence[str]) -> DataFrame:
    """One row per expected file: does it exist, when was it changed, how large is it."""
    wanted = spark.createDataFrame([(name,) for name in expected], "file_name string")
    found = manifest(spark, folder)
    return wanted.join(found, "file_name", "left").select(
        "file_name", F.col("size").isNotNull().alias("exists"), "last_modified", "size"
    )


def missing_files(spark: SparkSession, folder: str, expected: Iterable[str]) -> DataFrame:
    wanted = spark.createDataFrame([(name,) for name in expected], "file_name string")
    return wanted.join(manifest(spark, folder), "file_name", "left_anti")


def newer_than(
    df: DataFrame, watermark: str, mark: str | None, overlap: str | None = None, until: str | None = None
) -> DataFrame:
    """Rows strictly above the mark, and those whose watermark is NULL or no time; all rows when there is no mark yet.

    ``overlap``, such as "1 day", reads that much again below the mark for late rows; the dedup on
    the key makes the second read harmless. ``until`` leaves out rows above a later mark.
    """
    at = F.try_to_timestamp(F.col(watermark).cast("string"))
    if mark is not None:
        edge = F.expr(f"timestamp '{mark}'" + (f" - interval {overlap}" if overlap else ""))
        df = df.filter((at > edge) | at.isNull())
    if until is not None:
        df = df.filter((at <= F.lit(until).cast("timestamp")) | at.isNull())
    return df


def load(
    df: DataFrame, table: SourceTable, load_type: str, mark: str | None, overlap: str | None = None, until: str | None = None,
) -> DataFrame:
    """``full`` takes every row, ``incremental`` the rows above the table's mark; a replay of either ends at ``until``."""
    if load_type not in ("full", "incremental"):
        raise ValueError(f"load_type must be 'full' or 'incremental', not {load_type!r}")
    return newer_than(df, table.watermark, None if load_type == "full" else mark, overlap, until)
