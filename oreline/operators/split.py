"""Rule split into valid and rejected rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON = "_reject_reason"


def mark_rejects(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Add the name of the first rule a row breaks, NULL for a valid row.

    A rule that evaluates to NULL is not broken.
    """
    reason = F.lit(None).cast("string")
    for name, broken in reversed(list(rules.items())):
        reason = F.when(F.coalesce(broken, F.lit(False)), F.lit(name)).otherwise(reason)
    return df.withColumn(REASON, reason)


def split_rules(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected with reason): two filters over one marked frame."""
    marked = mark_rejects(df, rules)
    valid = marked.filter(F.col(REASON).isNull()).drop(REASON)
    return valid, marked.filter(F.col(REASON).isNotNull())
