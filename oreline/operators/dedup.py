"""One row per key, chosen by a total order."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def order_columns(columns: Sequence[str], order_by: Sequence[str], tie_break: Iterable[str] | None) -> list[str]:
    rest = [c for c in columns if c not in order_by] if tie_break is None else list(tie_break)
    return [*order_by, *[c for c in rest if c not in order_by]]


def dedup(
    df: DataFrame,
    key: str,
    order_by: Sequence[str],
    keep: str = "last",
    tie_break: Iterable[str] | None = None,
) -> DataFrame:
    """Keep the last (or first) row of each key.

    Ties in ``order_by`` are broken by ``tie_break``, by default all other columns, so that a task
    that runs again picks the same row. The filter on ``row_number`` lets Spark cut every key to
    one row per map task before the shuffle: a key with a third of all rows reaches its reducer
    as one row per task.
    """
    if keep not in ("last", "first"):
        raise ValueError(f"keep must be 'last' or 'first', not {keep!r}")
    ordered = order_columns([c for c in df.columns if c != key], order_by, tie_break)
    direction = (lambda c: F.col(c).desc()) if keep == "last" else (lambda c: F.col(c).asc())
    window = Window.partitionBy(key).orderBy(*[direction(c) for c in ordered])
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def survivor(
    df: DataFrame, key: str, order_by: Sequence[str], tie_break: Iterable[str] | None = None, carry: Sequence[str] = (),
    keep: str = "last",
) -> Column:
    """The same choice as ``dedup`` as an aggregate: the largest (or smallest) struct in the order.

    ``carry`` names columns to read from the survivor besides those of the order.
    """
    ordered = order_columns([c for c in df.columns if c != key], order_by, tie_break)
    row = F.struct(*ordered, *[c for c in carry if c not in ordered])
    return F.max(row) if keep == "last" else F.min(row)
