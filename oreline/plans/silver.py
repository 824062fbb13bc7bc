"""Silver: cleaned tables, quarantine and stage counts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreline.functions import dates, rules
from oreline.functions.numbers import half_even, percent
from oreline.functions.text import clean_title, fill_text, strip
from oreline.operators.audit import stamp_silver
from oreline.operators.dedup import dedup
from oreline.operators.split import REASON, mark_rejects
from oreline.operators.stages import stage_counts
from oreline.schemas import TABLES


def _distinct_keys(df: DataFrame, name: str, keep: str | None, tie_break: Sequence[str] | None) -> DataFrame:
    """One row per key; ``keep`` is None where the rows have distinct keys already."""
    if keep is None:
        return df
    table = TABLES[name]
    return dedup(df, table.key, [table.watermark], keep, tie_break)


def _valid_gender(col: Column) -> Column:
    return clean_title(col).isin(rules.GENDERS)


def patients(
    df: DataFrame,
    as_of: dt.date,
    run_ts: dt.datetime | None = None,
    keep: str | None = "last",
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    unique = _distinct_keys(df, "patients", keep, tie_break)
    cleaned = (
        unique.withColumns(
            {
                "gender": clean_title(F.col("gender")),
                "date_of_birth": dates.parse_date(F.col("date_of_birth")),
            }
        )
        .filter(F.col("gender").isin(rules.GENDERS) & F.col("date_of_birth").isNotNull())
        .withColumns(
            {
                "age": dates.age_years(F.col("date_of_birth"), as_of),
                "insurance_type": fill_text(strip(F.col("insurance_type")), "Unknown"),
                "city": clean_title(F.col("city")),
            }
        )
        .withColumn("age_band", rules.age_band(F.col("age")))
    )
    return stamp_silver(cleaned, run_ts, valid=True)


def marked_admissions(df: DataFrame, keep: str | None = "last", tie_break: Sequence[str] | None = None) -> DataFrame:
    """Unique admissions with parsed dates and the name of the rule each one breaks, if any."""
    parsed = _distinct_keys(df, "admissions", keep, tie_break).withColumns(
        {
            "admission_date": dates.parse_date(F.col("admission_date")),
            "discharge_date": dates.parse_date(F.col("discharge_date")),
        }
    )
    reversed_dates = F.col("discharge_date") < F.col("admission_date")
    return mark_rejects(parsed, {rules.REJECT_DATE_ORDER: reversed_dates})


def quarantined_admissions(marked: DataFrame) -> DataFrame:
    return marked.filter(F.col(REASON).isNotNull())


def valid_admissions(marked: DataFrame, as_of: dt.date, run_ts: dt.datetime | None = None) -> DataFrame:
    admitted, discharged = F.col("admission_date"), F.col("discharge_date")
    derived = (
        marked.filter(F.col(REASON).isNull())
        .drop(REASON)
        .withColumns(
            {
                "length_of_stay": dates.stay_days(admitted, discharged, as_of),
                "department": clean_title(F.col("department")),
                "doctor_name": clean_title(F.col("doctor_name")),
                "admission_type": clean_title(F.col("admission_type")),
                "diagnosis_primary": clean_title(F.col("diagnosis_primary")),
                "discharge_status": fill_text(F.col("discharge_status"), "Active"),
            }
        )
        .withColumns(
            {
                "los_category": rules.stay_category(F.col("length_of_stay")),
                "admission_year": F.year(admitted),
                "admission_month": F.month(admitted),
                "admission_month_name": F.date_format(admitted, "MMM"),
                "admission_quarter": F.quarter(admitted),
                "admission_week": F.weekofyear(admitted),
                "high_risk_flag": rules.high_risk(F.col("bed_type"), F.col("readmission_flag")),
                "mortality_flag": rules.flag(F.col("discharge_status") == "Death"),
            }
        )
    )
    return stamp_silver(derived, run_ts, valid=True)


def recounted_stays(valid: DataFrame, as_of: dt.date, run_ts: dt.datetime | None = None) -> DataFrame:
    """Rows of the silver table with their stays counted to another date."""
    days = dates.stay_days(F.col("admission_date"), F.col("discharge_date"), as_of)
    counted = valid.withColumn("length_of_stay", days).withColumn("los_category", rules.stay_category(F.col("length_of_stay")))
    return stamp_silver(counted, run_ts, valid=True)


def admissions(
    df: DataFrame,
    as_of: dt.date,
    run_ts: dt.datetime | None = None,
    keep: str | None = "last",
    tie_break: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantined)."""
    marked = marked_admissions(df, keep, tie_break)
    return valid_admissions(marked, as_of, run_ts), quarantined_admissions(marked)


def billing(
    df: DataFrame,
    run_ts: dt.datetime | None = None,
    keep: str | None = "last",
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    components = reduce(lambda a, b: a + b, [F.col(c) for c in rules.COMPONENT_SHARE])
    variance = F.abs(F.col("total_amount") - F.col("_calc_total"))
    cleaned = (
        _distinct_keys(df, "billing", keep, tie_break)
        .withColumn("_calc_total", components.cast("decimal(18,2)"))
        .withColumn("_amount_variance", variance.cast("decimal(18,2)"))
        .withColumns(
            {
                "_amount_check": F.coalesce(F.col("_amount_variance") < rules.AMOUNT_TOLERANCE, F.lit(False)),
                "payment_status": fill_text(F.col("payment_status"), "Unknown"),
                "revenue_tier": rules.revenue_tier(F.col("total_amount")),
                "bill_date": dates.parse_date(F.col("bill_date")),
            }
        )
        .withColumns(
            {
                "outstanding_amount": rules.outstanding(F.col("payment_status"), F.col("patient_payable")),
                "bill_year": F.year("bill_date"),
                "bill_month": F.month("bill_date"),
                "bill_quarter": F.quarter("bill_date"),
            }
        )
    )
    return stamp_silver(cleaned, run_ts)


def bed_occupancy(
    df: DataFrame,
    run_ts: dt.datetime | None = None,
    keep: str | None = "last",
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """A snapshot that is read again, by overlap or a second full load, counts once."""
    snapshot = F.col("snapshot_date")
    cleaned = (
        _distinct_keys(df, "bed_occupancy", keep, tie_break)
        .withColumns(
            {
                # The same spelling as in admissions, so that both find their department.
                "department": clean_title(F.col("department")),
                "snapshot_date": dates.parse_date(snapshot),
            }
        )
        .filter(snapshot.isNotNull())
        .withColumn("occupancy_rate", half_even(percent(F.col("occupied_beds"), F.col("total_beds")), 2))
        .withColumns(
            {
                "occupancy_status": rules.occupancy_status(F.col("occupancy_rate")),
                "snapshot_year": F.year(snapshot),
                "snapshot_month": F.month(snapshot),
                "snapshot_quarter": F.quarter(snapshot),
            }
        )
    )
    return stamp_silver(cleaned, run_ts)


def patient_stages(df: DataFrame, tie_break: Sequence[str] | None = None, keep: str = "last") -> DataFrame:
    born = dates.parse_date(F.col("date_of_birth")).isNotNull()
    return stage_counts(
        df, "patients", "patient_id", [TABLES["patients"].watermark],
        [("dedup_patient_id", None), ("valid_dob", _valid_gender(F.col("gender")) & born)], tie_break,
        ["gender", "date_of_birth"], keep,
    )


def admission_stages(df: DataFrame, tie_break: Sequence[str] | None = None) -> DataFrame:
    admitted, discharged = (dates.parse_date(F.col(c)) for c in ("admission_date", "discharge_date"))
    in_order = ~F.coalesce(discharged < admitted, F.lit(False))
    return stage_counts(
        df, "admissions", "admission_id", [TABLES["admissions"].watermark],
        [("dedup_admission_id", None), ("valid_date_order", in_order)], tie_break,
        ["admission_date", "discharge_date"],
    )


def billing_stages(df: DataFrame, tie_break: Sequence[str] | None = None) -> DataFrame:
    return stage_counts(
        df, "billing", "bill_id", [TABLES["billing"].watermark], [("dedup_bill_id", None)], tie_break
    )
