"""Calendar functions as bridges from a group to the dates it covers.

A bridge has the calendar columns of the grouping and one row for every date the function maps the
group to. Facts are first reduced to one row per date key and then joined to the bridge by
equality, so the calendar functions need neither range joins nor a window over a fact. A bridge
has at most (groups x days of the longest period) rows, both bounded by the calendar.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY = "_day"


def months_back(day: Column, n: int) -> Column:
    """The same day n months earlier; a month end maps to a month end."""
    earlier = F.add_months(day, -n)
    return F.when(day == F.last_day(day), F.last_day(earlier)).otherwise(earlier)


def _month_start(day: Column) -> Column:
    return F.trunc(day, "month").cast("date")


def _spans(dates: DataFrame, by: Sequence[str], first: Column, last: Column) -> DataFrame:
    """One row per group and day from ``first`` to ``last``, expressions over ``lo`` and ``hi``."""
    bounds = dates.groupBy(*by).agg(F.min(DAY).alias("lo"), F.max(DAY).alias("hi")).filter("hi is not null")
    return bounds.select(*by, F.explode(F.sequence(first, last)).alias(DAY))


def _year_earlier(dates: DataFrame, by: Sequence[str]) -> DataFrame:
    """Every date one year earlier; a month that lies in the group as a whole maps to a whole month."""
    month = _month_start(F.col(DAY))
    months = dates.groupBy(*by, month.alias("_month")).agg(F.collect_set(DAY).alias("_days"))
    target = F.add_months("_month", -12)
    whole = F.size("_days") == F.dayofmonth(F.last_day("_month"))
    shifted = F.array_distinct(F.transform("_days", lambda day: F.add_months(day, -12)))
    days = F.when(whole, F.sequence(target, F.last_day(target))).otherwise(shifted)
    return months.select(*by, F.explode(days).alias(DAY))


def period(dates: DataFrame, by: Sequence[str], function: str) -> DataFrame:
    """Days covered by ``function`` for each group of ``dates`` (columns ``by`` and ``_day``).

    Functions: ``ytd``, ``qtd``, ``prior_year``, ``previous_month``, ``last`` and ``rolling_N``
    for the N months up to the last date.
    """
    lo, hi = F.col("lo"), F.col("hi")
    if function == "ytd":
        return _spans(dates, by, F.trunc(hi, "year").cast("date"), hi)
    if function == "qtd":
        return _spans(dates, by, F.trunc(hi, "quarter").cast("date"), hi)
    if function == "last":
        return _spans(dates, by, hi, hi)
    if function == "prior_year":
        return _year_earlier(dates, by)
    if function == "previous_month":
        before = F.date_sub(_month_start(lo), 1)
        return _spans(dates, by, _month_start(before), before)
    if function.startswith("rolling_"):
        return _spans(dates, by, F.date_add(months_back(hi, int(function.removeprefix("rolling_"))), 1), hi)
    raise ValueError(f"unknown calendar function {function!r}")


def bridge(dates: DataFrame, calendar: DataFrame, by: Sequence[str], function: str) -> DataFrame:
    """Columns ``by`` and ``date_key``; days outside the calendar vanish.

    ``calendar`` has ``_day`` and ``date_key`` for all its dates, ``dates`` those in the context.
    """
    return period(dates, by, function).join(calendar.select(DAY, "date_key"), DAY).drop(DAY)
