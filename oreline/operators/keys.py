"""Surrogate keys of names: dense over sorted distinct names without a one-task sort, and a registry in which they never move."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RANGES = 256


def dense_keys(names: DataFrame, name: str, key: str) -> DataFrame:
    """Number distinct non-NULL names 1..n in their order.

    A plain ``row_number`` over an unpartitioned window sorts all names in one task. Here the
    names with the smallest hashes, at most ``RANGES`` - 1 of them, cut the name space into
    ranges. Each range is numbered on its own and shifted by the names in the ranges before it.
    The cuts depend on the names alone, so a task that runs again finds the same ranges.
    """
    cuts = (
        names.select(name)
        .orderBy(F.xxhash64(name), name)
        .limit(RANGES - 1)
        .agg(F.sort_array(F.collect_list(name)).alias("cuts"))
    )
    ranged = (
        names.withColumn("_cuts", cuts.scalar())
        .withColumn("_range", F.size(F.filter("_cuts", lambda cut: cut <= F.col(name))))
        .drop("_cuts")
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy("_range").orderBy(name)
    return (
        ranged.withColumn("_rn", F.row_number().over(inside))
        .join(F.broadcast(offsets), "_range")
        .withColumn(key, (F.col("_rn") + F.col("_offset")).cast("int"))
        .select(key, *names.columns)
    )


def register(names: DataFrame, known: DataFrame | None, name: str, key: str) -> DataFrame:
    """Keys for the names that a registry does not know yet: dense in their order, after its highest key.

    ``names`` holds distinct names, stored, as it is read more than once; NULL gets no key. ``known`` is the registry (key, name) or None.
    The registry and what is returned are the new registry: no name that had a key gets another.
    """
    fresh = names.select(name).where(F.col(name).isNotNull())
    if known is None:
        return dense_keys(fresh, name, key)
    fresh = fresh.join(known.select(name), name, "left_anti")
    top = known.agg(F.coalesce(F.max(key), F.lit(0)).alias("top")).scalar()
    return dense_keys(fresh, name, key).withColumn(key, (F.col(key) + top).cast("int"))
