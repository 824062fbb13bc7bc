"""Gold: dimensions, facts, stored aggregates and the orphan report."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreline.functions import dates
from oreline.functions.numbers import half_even, percent
from oreline.functions.rules import COMPONENT_SHARE, PAYER_SHARE, payer_share
from oreline.functions.text import quarter_label
from oreline.operators.keys import dense_keys

# Department, specialty, type.
DEPARTMENT_INFO = [
    ("Cardiology", "Heart & Vascular", "Medical"),
    ("Orthopedics", "Bones & Joints", "Surgical"),
    ("Neurology", "Brain & Nerves", "Medical"),
    ("Emergency", "Emergency Care", "Emergency"),
    ("Pediatrics", "Children", "Medical"),
    ("Oncology", "Cancer Care", "Medical"),
    ("General Medicine", "General", "Medical"),
    ("Icu", "Intensive Care", "Critical Care"),
    ("Gynecology", "Women's Health", "Surgical"),
    ("Urology", "Urinary Tract", "Surgical"),
]
DEFAULT_SPECIALTY, DEFAULT_TYPE = "General", "Medical"
DEFAULT_CALENDAR = (dt.date(2021, 1, 1), dt.date(2026, 12, 31))

PATIENT_ATTRIBUTES = ["gender", "date_of_birth", "age", "age_band", "blood_group", "city", "insurance_type"]
ADMISSION_FACT = [
    "admission_id", "patient_id", "department_key", "doctor_key",
    "admission_date_key", "discharge_date_key", "admission_type", "bed_type", "diagnosis_primary",
    "length_of_stay", "los_category", "discharge_status", "readmission_flag", "high_risk_flag",
    "mortality_flag", "ward_number", "admission_year", "admission_month", "admission_quarter",
]
BILLING_FACT = [
    "bill_id", "admission_id", "patient_id", "total_amount", "room_charges", "medicine_charges",
    "procedure_charges", "misc_charges", "insurance_type", "insurance_amount", "patient_payable",
    "outstanding_amount", "payment_status", "revenue_tier", "bill_year", "bill_month", "bill_quarter",
]
OCCUPANCY_FACT = [
    "occupancy_id", "department_key", "snapshot_date_key", "total_beds", "occupied_beds",
    "available_beds", "occupancy_rate", "occupancy_status", "snapshot_year", "snapshot_month",
    "snapshot_quarter",
]

# What bills carry of their admission beside the columns that measures and groupings read of them.
BILLING_KEYED = [
    "bill_id", "admission_id", "patient_id", "total_amount", "insurance_type", "insurance_amount", "patient_payable", "outstanding_amount", "payment_status", "revenue_tier",
]
ADMISSION_KEYS = ["department_key", "doctor_key", "admission_date_key", "admission_type", "los_category", "admission_year"]

# The column each fact is stored by.
PARTITIONS = {
    "fact_admissions": "admission_year",
    "fact_billing": "bill_year",
    "fact_billing_keyed": "fact_admissions__admission_year",
    "fact_bed_occupancy": "snapshot_year",
}


def date_spine(span: DataFrame) -> DataFrame:
    """All days of a one-row frame with the dates ``first`` and ``last``."""
    return span.select(F.explode(F.sequence("first", "last")).alias("full_date"))


def fixed_span(
    spark: SparkSession, start: dt.date = DEFAULT_CALENDAR[0], end: dt.date = DEFAULT_CALENDAR[1]
) -> DataFrame:
    return spark.range(1).select(F.lit(start).alias("first"), F.lit(end).alias("last"))


def years_of(days: DataFrame, column: str) -> DataFrame:
    """The whole calendar years that hold the dates of a column."""
    first = F.trunc(F.min(column), "year").cast("date")
    last = F.date_sub(F.add_months(F.trunc(F.max(column), "year"), 12), 1)
    return days.agg(first.alias("first"), last.alias("last"))


def span_of_facts(silver_admissions: DataFrame, silver_occupancy: DataFrame) -> DataFrame:
    """The whole years that hold the days of both facts, so that no fact falls outside the calendar."""
    days = silver_admissions.select(F.col("admission_date").alias("day")).unionByName(silver_occupancy.select(F.col("snapshot_date").alias("day")))
    return years_of(days, "day")


def dim_date(span: DataFrame) -> DataFrame:
    day = F.col("full_date")
    quarter = quarter_label(F.quarter(day))
    return date_spine(span).select(
        day,
        dates.date_key(day).alias("date_key"),
        F.dayofmonth(day).alias("day"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "MMM").alias("month_short"),
        F.quarter(day).alias("quarter"),
        quarter.alias("quarter_label"),
        F.year(day).alias("year"),
        F.concat_ws("-", F.year(day), quarter).alias("year_quarter"),
        dates.year_month(day).alias("year_month"),
        F.weekofyear(day).alias("week_number"),
        dates.day_of_week(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        dates.is_weekend(day).alias("is_weekend"),
        dates.is_month_start(day).alias("is_month_start"),
        dates.is_month_end(day).alias("is_month_end"),
    )


def dim_patient(silver_patients: DataFrame) -> DataFrame:
    return silver_patients.select(F.col("patient_id").alias("patient_key"), *PATIENT_ATTRIBUTES)


def department_info(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DEPARTMENT_INFO, "department_name string, specialty string, dept_type string")


def department_names(silver_admissions: DataFrame) -> DataFrame:
    names = silver_admissions.select(F.col("department").alias("department_name"))
    return names.filter(F.col("department_name").isNotNull()).distinct()


def dim_department(names: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Departments by name, with their keys in a registry or numbered in order of their names.

    ``names`` should be stored: numbering reads them more than once.
    """
    spark = names.sparkSession
    keyed = dense_keys(names, "department_name", "department_key") if keys is None else names.join(keys, "department_name")
    # Ten fixed rows.
    info = F.broadcast(department_info(spark))
    return keyed.join(info, "department_name", "left").select(
        "department_key",
        "department_name",
        F.coalesce("specialty", F.lit(DEFAULT_SPECIALTY)).alias("specialty"),
        F.coalesce("dept_type", F.lit(DEFAULT_TYPE)).alias("dept_type"),
    )


def doctor_names(silver_admissions: DataFrame) -> DataFrame:
    """Doctors with the department they admit to most; the first name wins a tie.

    Counting per doctor and department first leaves one row per pair for the second grouping.
    """
    pairs = (
        silver_admissions.filter(F.col("doctor_name").isNotNull())
        .groupBy("doctor_name", "department")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # NULL is no department: it must not win, but its doctor stays.
    ranked = F.when(F.col("department").isNotNull(), F.struct((-F.col("n")).alias("n"), "department"))
    return pairs.groupBy("doctor_name").agg(F.min(ranked)["department"].alias("primary_department"))


def dim_doctor(doctors: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Doctors by name, with their keys in a registry or numbered in order of their names; ``doctors`` as for ``dim_department``."""
    if keys is None:
        return dense_keys(doctors, "doctor_name", "doctor_key")
    return doctors.join(keys, "doctor_name").select("doctor_key", *doctors.columns)


def _lookup(fact: DataFrame, dim: DataFrame, fact_column: str, dim_column: str, key: str) -> DataFrame:
    """Left join that brings a surrogate key; a name without one gets NULL.

    No broadcast hint: Spark broadcasts a dimension whose measured size allows it and otherwise
    sorts, splitting skewed names at run time.
    """
    keys = dim.select(F.col(dim_column).alias(fact_column), key)
    return fact.join(keys, fact_column, "left")


def fact_admissions(silver_admissions: DataFrame, departments: DataFrame, doctors: DataFrame) -> DataFrame:
    keyed = _lookup(silver_admissions, departments, "department", "department_name", "department_key")
    keyed = _lookup(keyed, doctors, "doctor_name", "doctor_name", "doctor_key")
    return keyed.withColumns(
        {
            "admission_date_key": dates.date_key(F.col("admission_date")),
            "discharge_date_key": dates.date_key(F.col("discharge_date")),
        }
    ).select(*ADMISSION_FACT)


def fact_billing(silver_billing: DataFrame) -> DataFrame:
    return silver_billing.select(*BILLING_FACT)


def fact_billing_keyed(fact_billing: DataFrame, fact_admissions: DataFrame) -> DataFrame:
    """Bills with the keys of their admission, named fact_admissions__column; ``found`` is false for a bill without one.

    The only join of the two large facts; queries over both read this table.
    """
    keys = fact_admissions.select(
        F.col("admission_id").alias("_admission"), *[F.col(c).alias(f"fact_admissions__{c}") for c in ADMISSION_KEYS], F.lit(True).alias("fact_admissions__found")
    )
    joined = fact_billing.select(*BILLING_KEYED).join(keys, F.col("admission_id") == F.col("_admission"), "left").drop("_admission")
    return joined.withColumn("fact_admissions__found", F.coalesce("fact_admissions__found", F.lit(False)))


def fact_bed_occupancy(silver_occupancy: DataFrame, departments: DataFrame) -> DataFrame:
    keyed = _lookup(silver_occupancy, departments, "department", "department_name", "department_key")
    return keyed.withColumn("snapshot_date_key", dates.date_key(F.col("snapshot_date"))).select(*OCCUPANCY_FACT)


def patient_numbers(names: DataFrame) -> DataFrame:
    """Patients of admissions by number from 1; ``names`` (patient_id, distinct and stored) as for ``dim_department``."""
    return dense_keys(names.where(F.col("patient_id").isNotNull()), "patient_id", "patient_number")


def month_of(date_key: Column) -> Column:
    return F.floor(date_key / 100).cast("int")


def patient_bits(rows: DataFrame, numbers: DataFrame, by: Sequence[str]) -> DataFrame:
    """Bitmaps of the patients (column patient_id) of each group: by, bucket (of 32,768 numbers), patients. A NULL patient has number 0."""
    known = numbers.select(F.col("patient_id").alias("_patient"), "patient_number")
    number = F.coalesce("patient_number", F.lit(0)).cast("long")
    numbered = rows.join(known, F.col("patient_id") == F.col("_patient"), "left").select(*by, number.alias("_number"))
    place = F.bitmap_bit_position("_number")
    return numbered.groupBy(*by, F.bitmap_bucket_number("_number").alias("bucket")).agg(F.bitmap_construct_agg(place).alias("patients"))


def patient_months(fact: DataFrame, numbers: DataFrame) -> DataFrame:
    """Patients of each month and department as bitmaps, so that distinct counts over months are merges of bits."""
    by = ["month", "department_key"]
    pairs = fact.select(month_of(F.col("admission_date_key")).alias("month"), "department_key", "patient_id").distinct()
    return patient_bits(pairs, numbers, by)


def _total(column: str) -> Column:
    """Sum that is 0 when every value is NULL."""
    return F.coalesce(F.sum(column), F.lit(0))


def _mean(column: str) -> Column:
    return F.sum(column).cast("double") / F.nullif(F.count(column), F.lit(0))


def agg_monthly_admissions(fact: DataFrame) -> DataFrame:
    keys = ["admission_year", "admission_month"]
    monthly = (
        fact.dropna(subset=keys)
        .groupBy(*keys)
        .agg(
            F.count("admission_id").alias("total_admissions"),
            half_even(_mean("length_of_stay"), 1).alias("avg_los"),
            _total("readmission_flag").alias("readmissions"),
            _total("mortality_flag").alias("mortality_count"),
            F.count_if(F.col("admission_type") == "Emergency").alias("emergency_count"),
        )
    )
    total = F.col("total_admissions")
    return monthly.withColumns(
        {
            "readmission_rate": half_even(percent(F.col("readmissions"), total), 2),
            "mortality_rate": half_even(percent(F.col("mortality_count"), total), 2),
        }
    )


def agg_dept_kpis(fact: DataFrame) -> DataFrame:
    return (
        fact.dropna(subset=["department_key"])
        .groupBy("department_key")
        .agg(
            F.count("admission_id").alias("total_admissions"),
            half_even(_mean("length_of_stay"), 1).alias("avg_los"),
            _total("readmission_flag").alias("total_readmit"),
            _total("mortality_flag").alias("total_mortality"),
            _total("high_risk_flag").alias("high_risk_count"),
        )
    )


def agg_revenue_summary(fact: DataFrame) -> DataFrame:
    """Exact decimal sums, shown as doubles."""
    keys = ["bill_year", "bill_month", "insurance_type"]
    sums = {
        "total_revenue": "total_amount",
        "insurance_covered": "insurance_amount",
        "patient_payable": "patient_payable",
        "outstanding": "outstanding_amount",
    }
    revenue = (
        fact.dropna(subset=keys)
        .groupBy(*keys)
        .agg(
            *[_total(column).cast("double").alias(name) for name, column in sums.items()],
            F.count("bill_id").alias("bill_count"),
        )
    )
    kept = F.col("total_revenue") - F.col("outstanding")
    return revenue.withColumn("collection_rate", half_even(percent(kept, F.col("total_revenue")), 2))


def orphan_keys(
    admissions: DataFrame, billing: DataFrame, occupancy: DataFrame, patients: DataFrame, departments: DataFrame,
    doctors: DataFrame, days: DataFrame,
) -> DataFrame:
    """Fact rows whose key is NULL or finds no dimension row: fact_table, dimension, orphans.

    A day outside the stored calendar is an orphan of ``dim_date``.
    """

    def unmatched(fact: DataFrame, name: str, column: str, dim: DataFrame, dim_key: str, label: str) -> DataFrame:
        # One row per key before the join, so that a hot key costs one row per map task.
        per_key = fact.groupBy(F.col(column).alias(dim_key)).agg(F.count(F.lit(1)).alias("n"))
        lost = per_key.join(dim.select(dim_key).distinct(), dim_key, "left_anti")
        total = F.coalesce(F.sum("n"), F.lit(0)).cast("bigint")
        return lost.agg(total.alias("orphans")).select(
            F.lit(name).alias("fact_table"), F.lit(label).alias("dimension"), "orphans"
        )

    return (
        unmatched(admissions, "fact_admissions", "department_key", departments, "department_key", "dim_department")
        .unionByName(unmatched(admissions, "fact_admissions", "doctor_key", doctors, "doctor_key", "dim_doctor"))
        .unionByName(unmatched(admissions, "fact_admissions", "admission_date_key", days, "date_key", "dim_date"))
        .unionByName(
            unmatched(occupancy, "fact_bed_occupancy", "department_key", departments, "department_key", "dim_department")
        )
        .unionByName(unmatched(occupancy, "fact_bed_occupancy", "snapshot_date_key", days, "date_key", "dim_date"))
        .unionByName(unmatched(admissions, "fact_admissions", "patient_id", patients, "patient_key", "dim_patient"))
        .unionByName(unmatched(billing, "fact_billing", "patient_id", patients, "patient_key", "dim_patient"))
        .unionByName(
            unmatched(billing, "fact_billing", "admission_id", admissions, "admission_id", "fact_admissions")
        )
    )


def derive_bills(
    admissions: DataFrame,
    patients: DataFrame,
    charge: str,
    shares: Mapping[str, Decimal] = PAYER_SHARE,
) -> DataFrame:
    """Bills of closed admissions: payer share by the patient's insurance, split into components."""
    insured_by = patients.select("patient_id", "insurance_type")
    amount = F.col(charge).cast("decimal(18,2)")

    def cents(col: Column) -> Column:
        return F.round(col, 2).cast("decimal(18,2)")

    return (
        admissions.filter(F.col("discharge_date").isNotNull())
        .join(insured_by, "patient_id", "left")
        .select(
            "admission_id",
            "patient_id",
            F.col("discharge_date").alias("bill_date"),
            amount.alias("total_amount"),
            *[cents(amount * F.lit(share)).alias(name) for name, share in COMPONENT_SHARE.items()],
            F.coalesce("insurance_type", F.lit("Self-Pay")).alias("insurance_type"),
        )
        .withColumn(
            "insurance_amount",
            cents(F.col("total_amount") * payer_share(F.col("insurance_type"), shares)),
        )
        .withColumn(
            "patient_payable", (F.col("total_amount") - F.col("insurance_amount")).cast("decimal(18,2)")
        )
    )


def derive_occupancy(df: DataFrame) -> DataFrame:
    """Free beds and the occupancy rate from total and occupied beds."""
    return df.withColumns(
        {
            "available_beds": F.col("total_beds") - F.col("occupied_beds"),
            "occupancy_rate": half_even(percent(F.col("occupied_beds"), F.col("total_beds")), 2),
        }
    )
