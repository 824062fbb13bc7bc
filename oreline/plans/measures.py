"""The measures of the model as arithmetic over base aggregates."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from oreline.functions.numbers import blank_minus, divide, percent, zero_if_blank
from oreline.plans.star import Agg, Measure

A, B, O, P = "fact_admissions", "fact_billing", "fact_bed_occupancy", "dim_patient"
Value = Callable[[Agg], Column]

# Targets, limits and colours.
STAY_TARGET_DAYS = 5
READMISSION_BENCHMARK = 15
CRITICAL_RATE = 95
TOP_DEPARTMENTS = 3
RED, ORANGE, GREEN = "#D32F2F", "#F57C00", "#388E3C"


def _at_least_critical(rate: Column) -> Column:
    return rate >= CRITICAL_RATE


def _sum(table: str, column: str, **options: Any) -> Agg:
    return Agg(table, "sum", column, **options)


def _mean(value: Value, total: Agg) -> Column:
    return divide(value(total), value(replace(total, kind="values", exact=None)))


ADMITTED = Agg(A, "rows")
EMERGENCIES = Agg(A, "rows", only=(f"{A}.admission_type", "Emergency"))
OPEN = Agg(A, "rows", only=(f"{A}.discharge_date_key", None))
READMITTED = Agg(A, "rows", only=(f"{A}.readmission_flag", 1))
DIED = Agg(A, "rows", only=(f"{A}.mortality_flag", 1))
HIGH_RISK = Agg(A, "rows", only=(f"{A}.high_risk_flag", 1))
STAY = _sum(A, "length_of_stay")
PEOPLE = Agg(A, "distinct", "patient_id")
WOMEN = Agg(A, "distinct", "patient_id", only=(f"{P}.gender", "Female"))
RATE = _sum(O, "occupancy_rate", exact="decimal(9,2)")
CRITICAL = Agg(O, "distinct", "department_key", only=(f"{O}.occupancy_rate", _at_least_critical))
REVENUE = _sum(B, "total_amount")
INSURED = _sum(B, "insurance_amount")
PAYABLE = _sum(B, "patient_payable")
OWED = _sum(B, "outstanding_amount")
UNSETTLED = Agg(B, "rows", only=(f"{B}.payment_status", ("Pending", "Partial")))
RANK = Agg(A, "rank")


def over(agg: Agg, period: str) -> Agg:
    return replace(agg, period=period)


def _growth(value: Value, agg: Agg, period: str) -> Column:
    """Change against the same aggregate over another period, blank when that is blank or 0."""
    before = value(over(agg, period))
    return percent(blank_minus(value(agg), before), before)


def _readmission_rate(value: Value) -> Column:
    return percent(value(READMITTED), value(ADMITTED))


def _occupancy(value: Value) -> Column:
    return _mean(value, RATE)


def _collection(value: Value) -> Column:
    return percent(blank_minus(value(REVENUE), value(OWED)), value(REVENUE))


def _color(shown: Column, red: Callable[[Column], Column], orange: Callable[[Column], Column]) -> Column:
    number = zero_if_blank(shown)
    return F.when(red(number), F.lit(RED)).when(orange(number), F.lit(ORANGE)).otherwise(F.lit(GREEN))


def _above(limit: float) -> Callable[[Column], Column]:
    return lambda number: number >= limit


def _below(limit: float) -> Callable[[Column], Column]:
    return lambda number: number < limit


MEASURES: dict[str, Measure] = {
    # Admissions
    "total_admissions": Measure(lambda v: v(ADMITTED)),
    "ytd_admissions": Measure(lambda v: v(over(ADMITTED, "ytd"))),
    "py_admissions": Measure(lambda v: v(over(ADMITTED, "prior_year"))),
    "admission_growth_yoy_pct": Measure(lambda v: _growth(v, ADMITTED, "prior_year")),
    "active_admissions": Measure(lambda v: v(OPEN)),
    "emergency_rate_pct": Measure(lambda v: percent(v(EMERGENCIES), v(ADMITTED))),
    # Length of stay
    "avg_length_of_stay": Measure(lambda v: _mean(v, STAY)),
    "los_vs_target": Measure(
        lambda v: zero_if_blank(_mean(v, STAY)) - STAY_TARGET_DAYS, fills=True
    ),
    "los_rolling_3m": Measure(lambda v: v(Agg(A, "daily_mean", "length_of_stay", period="rolling_3"))),
    # Readmission and mortality
    "readmission_count": Measure(lambda v: v(READMITTED)),
    "readmission_rate_pct": Measure(_readmission_rate),
    "readmission_vs_benchmark": Measure(
        lambda v: zero_if_blank(_readmission_rate(v)) - READMISSION_BENCHMARK, fills=True
    ),
    "mortality_count": Measure(lambda v: v(DIED)),
    "mortality_rate_pct": Measure(lambda v: percent(v(DIED), v(ADMITTED))),
    "high_risk_patients": Measure(lambda v: v(HIGH_RISK)),
    # Bed occupancy
    "avg_occupancy_rate_pct": Measure(_occupancy),
    "current_occupancy_pct": Measure(lambda v: _mean(v, over(RATE, "last"))),
    "total_beds": Measure(lambda v: v(_sum(O, "total_beds", period="last"))),
    "occupied_beds": Measure(lambda v: v(_sum(O, "occupied_beds", period="last"))),
    "available_beds": Measure(lambda v: v(_sum(O, "available_beds", period="last"))),
    "departments_at_critical_capacity": Measure(lambda v: v(CRITICAL)),
    # Revenue
    "total_revenue": Measure(lambda v: v(REVENUE)),
    "ytd_revenue": Measure(lambda v: v(over(REVENUE, "ytd"))),
    "py_revenue": Measure(lambda v: v(over(REVENUE, "prior_year"))),
    "revenue_growth_yoy_pct": Measure(lambda v: _growth(v, REVENUE, "prior_year")),
    "insurance_revenue": Measure(lambda v: v(INSURED)),
    "patient_revenue": Measure(lambda v: v(PAYABLE)),
    "outstanding_revenue": Measure(lambda v: v(OWED)),
    "collection_rate_pct": Measure(_collection),
    "revenue_per_admission": Measure(lambda v: divide(v(REVENUE), v(ADMITTED))),
    "avg_bill_amount": Measure(lambda v: _mean(v, REVENUE)),
    "insurance_coverage_pct": Measure(lambda v: percent(v(INSURED), v(REVENUE))),
    "pending_bills": Measure(lambda v: v(UNSETTLED)),
    # Time
    "mom_revenue_change_pct": Measure(lambda v: _growth(v, REVENUE, "previous_month")),
    "qtd_admissions": Measure(lambda v: v(over(ADMITTED, "qtd"))),
    "revenue_rolling_12m": Measure(lambda v: v(over(REVENUE, "rolling_12"))),
    # Ranking
    "dept_rank_by_admissions": Measure(lambda v: v(RANK), fills=True),
    "is_top_3_department": Measure(
        lambda v: F.when(v(RANK) <= TOP_DEPARTMENTS, F.lit("Top 3")).otherwise(F.lit("Others")), fills=True
    ),
    # Colours
    "readmission_kpi_color": Measure(lambda v: _color(_readmission_rate(v), _above(20), _above(15)), fills=True),
    "occupancy_kpi_color": Measure(lambda v: _color(_occupancy(v), _above(95), _above(80)), fills=True),
    "collection_kpi_color": Measure(lambda v: _color(_collection(v), _below(70), _below(85)), fills=True),
    # Patients
    "total_unique_patients": Measure(lambda v: v(PEOPLE)),
    "avg_patient_age": Measure(lambda v: _mean(v, _sum(P, "age"))),
    "female_patient_pct": Measure(lambda v: percent(v(WOMEN), v(PEOPLE))),
}

# Distinct patients over calendar periods, beside the measures of the model.
MEASURES |= {
    "ytd_unique_patients": Measure(lambda v: v(replace(PEOPLE, period="ytd"))),
    "unique_patients_rolling_12m": Measure(lambda v: v(replace(PEOPLE, period="rolling_12"))),
}


def pick(*names: str) -> dict[str, Measure]:
    return {name: MEASURES[name] for name in names}
