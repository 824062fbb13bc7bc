"""Row counts before and after each cleaning stage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreline.operators.dedup import survivor


def stage_counts(
    df: DataFrame,
    table: str,
    key: str,
    order_by: Sequence[str],
    stages: Sequence[tuple[str, Column | None]],
    tie_break: Sequence[str] | None = None,
    reads: Sequence[str] = (),
    keep: str = "last",
) -> DataFrame:
    """One row per stage: before, after, rows dropped since the start and by the stage itself.

    The first stage is the dedup; each later one keeps the survivors on which its condition is
    true. ``reads`` names the columns the conditions need. All counts come from one grouping by key, whose partial aggregates keep one candidate
    per key and map task.
    """
    chosen = survivor(df, key, order_by, tie_break, reads, keep)
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_copies"), chosen.alias("_row"))
    rows = per_key.select(key, "_copies", "_row.*")

    kept: Column = F.lit(True)
    counts = []
    for position, (_, condition) in enumerate(stages):
        if condition is not None:
            kept = kept & F.coalesce(condition, F.lit(False))
        counts.append(F.count_if(kept).alias(f"n{position}"))
    totals = rows.agg(F.coalesce(F.sum("_copies"), F.lit(0)).cast("bigint").alias("initial"), *counts)
    return _as_rows(totals, table, [name for name, _ in stages])


def stage_sizes(before: DataFrame, table: str, stages: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """The same rows where the tables before and after each stage are stored."""
    totals = before.agg(F.count(F.lit(1)).alias("initial"))
    for position, (_, stored) in enumerate(stages):
        size = stored.agg(F.count(F.lit(1)).alias("n")).scalar()
        totals = totals.withColumn(f"n{position}", size)
    return _as_rows(totals, table, [name for name, _ in stages])


def _as_rows(totals: DataFrame, table: str, stages: Sequence[str]) -> DataFrame:
    entries = []
    for position, name in enumerate(stages):
        before = F.col(f"n{position - 1}") if position else F.col("initial")
        after = F.col(f"n{position}")
        entries.append(
            F.struct(
                F.lit(table).alias("table"),
                F.lit(name).alias("stage"),
                F.col("initial").alias("before"),
                after.alias("after"),
                (F.col("initial") - after).alias("dropped_cumulative"),
                (before - after).alias("dropped_stage"),
            )
        )
    return totals.select(F.inline(F.array(*entries)))
