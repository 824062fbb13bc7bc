"""Datasets behind the five report pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreline.functions.numbers import percent
from oreline.plans.measures import CRITICAL_RATE, MEASURES, pick
from oreline.plans.star import Star

MONTHS = list(range(1, 13))


def exec_cards(star: Star) -> DataFrame:
    return star.query(
        pick(
            "total_admissions", "readmission_rate_pct", "mortality_rate_pct",
            "avg_occupancy_rate_pct", "total_revenue", "collection_rate_pct",
        )
    )


def trends(star: Star) -> DataFrame:
    return star.query(
        pick("total_admissions", "ytd_admissions", "total_revenue", "ytd_revenue", "mom_revenue_change_pct"),
        by=["dim_date.year_month"],
    )


def los_distribution(star: Star) -> DataFrame:
    return star.query(pick("total_admissions"), by=["fact_admissions.los_category"])


def admission_type(star: Star) -> DataFrame:
    """Count by type and its share of all admissions."""
    counts = star.query(pick("total_admissions"), by=["fact_admissions.admission_type"])
    total = star.query(pick("total_admissions")).scalar()
    return counts.withColumn("share_pct", percent(F.col("total_admissions"), total))


def _by_month(long: DataFrame, rows: str, value: str) -> DataFrame:
    """One column per calendar month, m01 to m12; the fixed list spares a pass for the values."""
    cells: list[Column] = [
        F.max(F.when(F.col("month") == m, F.col(value))).alias(f"m{m:02d}") for m in MONTHS
    ]
    return long.groupBy(rows).agg(*cells)


def dept_heatmap(star: Star) -> DataFrame:
    counts = star.query(pick("total_admissions"), by=["dim_department.department_name", "dim_date.month"])
    return _by_month(counts, "department_name", "total_admissions")


def quality(star: Star) -> DataFrame:
    return star.query(
        pick(
            "readmission_rate_pct", "readmission_vs_benchmark", "mortality_rate_pct",
            "high_risk_patients", "readmission_kpi_color",
        ),
        by=["dim_department.department_name"],
    )


def revenue_insurance(star: Star) -> DataFrame:
    return star.query(
        pick(
            "total_revenue", "insurance_revenue", "outstanding_revenue",
            "collection_rate_pct", "collection_kpi_color",
        ),
        by=["fact_billing.insurance_type"],
    )


def occupancy_heatmap(star: Star) -> DataFrame:
    rates = star.query(pick("avg_occupancy_rate_pct"), by=["dim_department.department_name", "dim_date.month"])
    return _by_month(rates, "department_name", "avg_occupancy_rate_pct")


def occupancy_trend(star: Star) -> DataFrame:
    return star.query({"avg_occupancy_rate_pct": MEASURES["avg_occupancy_rate_pct"]}, by=["dim_date.year_month"])


def critical_alerts(star: Star) -> DataFrame:
    """The latest snapshot of each department, where it is at critical capacity."""
    latest = F.max(
        F.struct("snapshot_date_key", "occupancy_rate", "occupied_beds", "total_beds", "occupancy_id")
    ).alias("last")
    per_key = star.tables["fact_bed_occupancy"].groupBy("department_key").agg(latest).select("department_key", "last.*")
    named = star.tables["dim_department"].select("department_key", "department_name")
    return (
        per_key.filter(F.col("occupancy_rate") >= CRITICAL_RATE)
        .join(named, "department_key", "left")
        .select("department_name", "snapshot_date_key", "occupancy_rate", "occupied_beds", "total_beds")
    )
