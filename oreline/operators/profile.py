"""Data-quality profile of a table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreline.functions.numbers import half_even
from oreline.operators.audit import record_hash
from oreline.schemas import CORRUPT, EVIDENCE_COLUMNS, REJECTED

HIGH_NULL_PERCENT = 5.0


def null_percentages(df: DataFrame) -> DataFrame:
    """One row: row count, and the NULL share of every column in percent; one pass."""
    shares = [half_even(F.avg(F.col(c).isNull().cast("int")) * 100, 2).alias(c) for c in df.columns]
    return df.agg(F.count(F.lit(1)).alias("_rows"), *shares)


def null_percentages_long(df: DataFrame) -> DataFrame:
    """One row per column: column_name, null_pct."""
    wide = null_percentages(df)
    return wide.unpivot([], df.columns, "column_name", "null_pct")


def null_shares_of(report: DataFrame) -> DataFrame:
    """One row per column of finished reports: table, column_name, null_pct."""
    return report.select("table", F.explode("null_percentages").alias("column_name", "null_pct"))


def high_nulls_of(report: DataFrame, above: float = HIGH_NULL_PERCENT) -> DataFrame:
    """The columns above the limit, from finished reports: table, column_name, null_pct."""
    return null_shares_of(report).filter(F.col("null_pct") > above)


def high_null_columns(df: DataFrame, above: float = HIGH_NULL_PERCENT) -> DataFrame:
    return null_percentages_long(df).filter(F.col("null_pct") > above)


def duplicate_rows(df: DataFrame, stored_hash: str | None = None) -> DataFrame:
    """One row: the number of rows that repeat an earlier one in all columns, NULLs equal.

    Grouping by the hash shuffles 32 bytes and a count per distinct row and map task.
    ``stored_hash`` names a column that already holds the hash.
    """
    digest = F.unhex(F.col(stored_hash) if stored_hash else record_hash(df.columns)).alias("digest")
    copies = df.select(digest).groupBy("digest").agg(F.count(F.lit(1)).alias("copies"))
    return copies.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"))


_BITS = 62


def _patterns(columns: Sequence[Column]) -> list[Column]:
    """Flags of a row as bits of as few longs as they need."""
    bits = [F.when(flag, F.lit(1 << (k % _BITS))).otherwise(F.lit(0)).cast("long") for k, flag in enumerate(columns)]
    return [reduce(lambda a, b: a.bitwiseOR(b), bits[k : k + _BITS]) for k in range(0, len(bits), _BITS)]


def _flagged(k: int) -> Column:
    """How many rows have the k-th flag, over groups of ``copies`` rows."""
    return F.coalesce(F.sum(F.when(F.col(f"_p{k // _BITS}").bitwiseAND(F.lit(1 << (k % _BITS)).cast("long")) != 0, F.col("copies"))), F.lit(0))


def profile(
    df: DataFrame, expected: Sequence[str], table: str, stored_hash: str | None = None
) -> DataFrame:
    """One row: counts, missing and extra columns, NULL shares, duplicates, rejected cells, corrupt records and status.

    One scan and one shuffle: rows are grouped by their hash, which carries which of their cells are NULL or rejected, as equal rows agree in
    it; all counts are sums over these groups. ``stored_hash`` names a column that already holds the hash. Rejected cells and
    corrupt records are counted where the scan has kept them. Status is WARN when a column is missing or anything was rejected.
    """
    columns = [c for c in df.columns if c not in (stored_hash, *EVIDENCE_COLUMNS)]
    digest = F.unhex(F.col(stored_hash) if stored_hash else record_hash(columns)).alias("digest")
    flags = [F.col(c).isNull() for c in columns]
    held = [c for c in columns if c in expected] if REJECTED in df.columns else []
    flags += [F.coalesce(F.col(REJECTED).getItem(c).isNotNull(), F.lit(False)) for c in held]
    flags += [F.col(CORRUPT).isNotNull()] if CORRUPT in df.columns else []
    patterns = [p.alias(f"_p{k}") for k, p in enumerate(_patterns(flags))]
    groups = df.select(digest, *patterns).groupBy("digest", *[f"_p{k}" for k in range(len(patterns))]).agg(F.count(F.lit(1)).alias("copies"))
    counted = groups.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("_rows"), F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("_again"),
        *[_flagged(k).alias(f"_f{k}") for k in range(len(flags))],
    )
    missing = [c for c in expected if c not in columns]
    extra = [c for c in columns if c not in expected]
    empty = F.array().cast("array<string>")
    share = lambda k: half_even(F.try_divide(F.col(f"_f{k}").cast("double"), F.col("_rows").cast("double")) * 100, 2)
    nulls = F.create_map(*[piece for k, c in enumerate(columns) for piece in (F.lit(c), share(k))])
    lost = [F.struct(F.lit(c).alias("key"), F.col(f"_f{len(columns) + k}").alias("value")) for k, c in enumerate(held)]
    rejected = F.lit(None).cast("map<string,bigint>")
    if lost:
        rejected = F.map_from_entries(F.filter(F.array(*lost), lambda e: e["value"] > 0))
    corrupt = F.col(f"_f{len(flags) - 1}") if CORRUPT in df.columns else F.lit(0).cast("bigint")
    told = counted.select("*", rejected.alias("_rejected"), corrupt.alias("_corrupt"))
    clean = (F.coalesce(F.size("_rejected"), F.lit(0)) <= 0) & (F.col("_corrupt") == 0)
    return told.select(
        F.lit(table).alias("table"),
        F.col("_rows").alias("row_count"),
        F.lit(len(columns)).alias("column_count"),
        (F.array(*map(F.lit, missing)) if missing else empty).alias("missing_columns"),
        (F.array(*map(F.lit, extra)) if extra else empty).alias("extra_columns"),
        nulls.alias("null_percentages"),
        F.col("_again").alias("duplicate_rows"),
        F.col("_rejected").alias("rejected_cells"),
        F.col("_corrupt").alias("corrupt_records"),
        (F.lit("WARN") if missing else F.when(clean, "PASS").otherwise("WARN")).alias("status"),
    )


def summary(reports: Sequence[DataFrame]) -> DataFrame:
    """All table reports as one frame."""
    return reduce(DataFrame.unionByName, reports)
