"""Date parsing, parts and differences."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DAYS_PER_YEAR = 365.25


def parse_date(col: Column, fmt: str = "yyyy-MM-dd") -> Column:
    """Date, or NULL when the text is not one."""
    return F.try_to_date(col, fmt)


def date_key(col: Column) -> Column:
    """Integer yyyymmdd; NULL stays NULL."""
    return F.year(col) * 10000 + F.month(col) * 100 + F.dayofmonth(col)


def plus_days(col: Column, days: int) -> Column:
    return F.date_add(col, days)


def plus_hours(col: Column, hours: int) -> Column:
    """Timestamp n hours later."""
    return col.cast("timestamp") + F.make_dt_interval(hours=F.lit(hours))


def iso_text(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd")


def year_month(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM")


def day_of_week(col: Column) -> Column:
    """Monday is 1."""
    return F.weekday(col) + 1


def is_weekend(col: Column) -> Column:
    return (F.weekday(col) >= 5).cast("int")


def is_month_start(col: Column) -> Column:
    return (F.dayofmonth(col) == 1).cast("int")


def is_month_end(col: Column) -> Column:
    return (col == F.last_day(col)).cast("int")


def stay_days(start: Column, end: Column, as_of: dt.date) -> Column:
    """Days from start to end; an open record counts up to ``as_of``."""
    return F.datediff(F.coalesce(end, F.lit(as_of)), start)


def age_years(birth: Column, as_of: dt.date) -> Column:
    """Whole years, truncated toward zero."""
    return (F.datediff(F.lit(as_of), birth) / F.lit(DAYS_PER_YEAR)).cast("int")
