"""Entry points: the flagship query, all registered queries, and their SQL oracles."""

from __future__ import annotations

import datetime as dt
import os
import sys
from collections.abc import Callable
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from oracles import ORACLES  # noqa: E402
from oreline.functions.dates import parse_date  # noqa: E402
from oreline.functions.numbers import half_even  # noqa: E402
from oreline.operators.audit import add_audit  # noqa: E402
from oreline.operators import profile  # noqa: E402
from oreline.plans import gold, rehearsal, reports, silver  # noqa: E402
from oreline.plans.lake import Lake  # noqa: E402
from oreline.plans.measures import pick  # noqa: E402
from oreline.plans.security import secure  # noqa: E402
from oreline.schemas import TABLES  # noqa: E402
from oreline.session import fit_shuffles  # noqa: E402
from oreline.sources import binding, raw  # noqa: E402
from oreline.sources.binding import AS_OF, bind  # noqa: E402

try:
    import corpus_pipeline
    from oreline.llm import oracles as llm_oracles
    from oreline.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    # The operators for training data are an optional part of the library.
    if missing.name not in ("corpus_pipeline", "oreline.llm"):
        raise
    corpus_pipeline = llm_queries = llm_oracles = None

Query = Callable[[SparkSession, str], DataFrame]

RUN_TS = dt.datetime(2002, 1, 1)
MONTH = "dim_date.year_month"
DEPARTMENT = "dim_department.department_name"
INSURANCE = "fact_billing.insurance_type"


def _drop_stamps(df: DataFrame) -> DataFrame:
    return df.drop("_silver_processed_at")


def _money(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the type of the output layer."""
    return df.select(
        *[F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.col(c) for c, t in df.dtypes]
    )


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: half_even(F.col(c), digits) for c in columns})


# ---- bronze and data quality ----------------------------------------------------------------


def bronze_audit_hash(spark: SparkSession, folder: str) -> DataFrame:
    table = TABLES["admissions"]
    audited = add_audit(bind(spark, folder, "admissions"), table.columns, RUN_TS, table.file_name)
    return audited.select("admission_id", "_source_file", "_layer", "_record_hash")


def _reports(spark: SparkSession, folder: str) -> DataFrame:
    """The stored reports of all tables; one scan and one shuffle of each has made them."""
    return profile.summary([Lake(spark, folder).table(f"report_{name}") for name in TABLES])


def dq_profile(spark: SparkSession, folder: str) -> DataFrame:
    """One row per table; lists as joined text, NULL shares are in ``dq_null_pct``."""
    return _reports(spark, folder).select(
        "table", "row_count", "column_count",
        F.array_join("missing_columns", ",").alias("missing_columns"),
        F.array_join("extra_columns", ",").alias("extra_columns"),
        "duplicate_rows", "status",
    )


def dq_null_pct(spark: SparkSession, folder: str) -> DataFrame:
    return profile.null_shares_of(_reports(spark, folder))


def dq_high_null(spark: SparkSession, folder: str) -> DataFrame:
    return profile.high_nulls_of(_reports(spark, folder))


def dq_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Repeated rows of the bill extract without its keys and dates, where many rows are alike."""
    columns = ["insurance_type", "payment_status", "bill_date"]
    return profile.duplicate_rows(bind(spark, folder, "billing").select(*columns))


def stage_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return profile.summary(
        [
            silver.patient_stages(bind(spark, folder, "patients")),
            silver.admission_stages(bind(spark, folder, "admissions")),
            silver.billing_stages(bind(spark, folder, "billing")),
        ]
    )


def incremental_admissions(spark: SparkSession, folder: str) -> DataFrame:
    df = bind(spark, folder, "admissions")
    return raw.load(df, TABLES["admissions"], "incremental", "1999-06-30").select(
        "admission_id", "admission_date", "discharge_date", "updated_at"
    )


# ---- silver ---------------------------------------------------------------------------------


def silver_patients(spark: SparkSession, folder: str) -> DataFrame:
    return _drop_stamps(silver.patients(bind(spark, folder, "patients"), AS_OF))


def silver_admissions(spark: SparkSession, folder: str) -> DataFrame:
    return _drop_stamps(silver.admissions(bind(spark, folder, "admissions"), AS_OF)[0])


def silver_billing_keep_first(spark: SparkSession, folder: str) -> DataFrame:
    """Bills deduplicated in the other direction: the first version of a key is kept."""
    return _money(_drop_stamps(silver.billing(bind(spark, folder, "billing"), keep="first")))


def quarantine_admissions(spark: SparkSession, folder: str) -> DataFrame:
    return silver.admissions(bind(spark, folder, "admissions"), AS_OF)[1]


def silver_billing(spark: SparkSession, folder: str) -> DataFrame:
    return _money(_drop_stamps(silver.billing(bind(spark, folder, "billing"))))


def silver_bed_occupancy(spark: SparkSession, folder: str) -> DataFrame:
    return _drop_stamps(silver.bed_occupancy(bind(spark, folder, "bed_occupancy")))


# ---- gold -----------------------------------------------------------------------------------


def dim_date(spark: SparkSession, folder: str) -> DataFrame:
    """The calendar over the years that hold admissions."""
    admitted = bind(spark, folder, "admissions").select(parse_date(F.col("admission_date")).alias("day"))
    return gold.dim_date(gold.years_of(admitted, "day"))


def _stored(name: str) -> Query:
    return lambda spark, folder: _money(Lake(spark, folder).build(name))


def orphan_keys(spark: SparkSession, folder: str) -> DataFrame:
    lake = Lake(spark, folder)
    facts = [lake.table(n) for n in ("fact_admissions", "fact_billing", "fact_bed_occupancy")]
    dimensions = [lake.table(n) for n in ("dim_patient", "dim_department", "dim_doctor", "dim_date")]
    return gold.orphan_keys(*facts, *dimensions)


def agg_monthly_admissions(spark: SparkSession, folder: str) -> DataFrame:
    return gold.agg_monthly_admissions(Lake(spark, folder).table("fact_admissions"))


def agg_dept_kpis(spark: SparkSession, folder: str) -> DataFrame:
    return gold.agg_dept_kpis(Lake(spark, folder).table("fact_admissions"))


def agg_revenue_summary(spark: SparkSession, folder: str) -> DataFrame:
    return gold.agg_revenue_summary(Lake(spark, folder).table("fact_billing"))


def bill_derivation(spark: SparkSession, folder: str) -> DataFrame:
    """Bills from the order totals, with payer shares by market segment."""
    admissions = binding.admissions(spark, folder, "o_totalprice as charge")
    patients = bind(spark, folder, "patients").withColumn("insurance_type", F.trim("insurance_type"))
    shares = {"AUTOMOBILE": Decimal("0.80"), "BUILDING": Decimal("0.75"), "MACHINERY": Decimal("0.65")}
    return _money(gold.derive_bills(admissions, patients, "charge", shares))


def occupancy_arithmetic(spark: SparkSession, folder: str) -> DataFrame:
    df = bind(spark, folder, "bed_occupancy")
    return gold.derive_occupancy(df).select(
        "occupancy_id", "total_beds", "occupied_beds", "available_beds", "occupancy_rate"
    )


# ---- measures -------------------------------------------------------------------------------


def _measures(*names: str, by: tuple[str, ...] = (), last_date: str = "data", where=None) -> Query:
    return lambda spark, folder: Lake(spark, folder).star(last_date).query(pick(*names), by, where)


def _report(build: Callable) -> Query:
    return lambda spark, folder: build(Lake(spark, folder).star())


ADMISSION_MEASURES = (
    "total_admissions", "active_admissions", "emergency_rate_pct", "avg_length_of_stay", "los_vs_target",
    "readmission_count", "readmission_rate_pct", "readmission_vs_benchmark", "mortality_count",
    "mortality_rate_pct", "high_risk_patients",
)
REVENUE_MEASURES = (
    "total_revenue", "insurance_revenue", "patient_revenue", "outstanding_revenue", "collection_rate_pct",
    "avg_bill_amount", "insurance_coverage_pct", "pending_bills",
)
BED_MEASURES = ("current_occupancy_pct", "total_beds", "occupied_beds", "available_beds")


def m_totals_rollup(spark: SparkSession, folder: str) -> DataFrame:
    measures = pick("total_admissions", "readmission_rate_pct", "total_unique_patients")
    by = ["dim_department.dept_type", DEPARTMENT]
    return Lake(spark, folder).star().rollup(measures, by)


def ti_los_rolling_3m(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_measures("los_rolling_3m", by=(MONTH,))(spark, folder), "los_rolling_3m")


def dept_rank_by_month(spark: SparkSession, folder: str) -> DataFrame:
    return Lake(spark, folder).star().query(
        pick("total_admissions", "dept_rank_by_admissions", "is_top_3_department"), [MONTH, DEPARTMENT],
    )


SECURED = ("total_admissions", "total_revenue", "avg_occupancy_rate_pct")


def _secured(roles: list[str], *by: str) -> Query:
    return lambda spark, folder: secure(Lake(spark, folder).star(), roles, "Icu").query(pick(*SECURED), by)


_sized: set[tuple[str, str]] = set()


def _fitted(query: Query) -> Query:
    """Fit the number of shuffle partitions to the tables once per session and folder."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        seen = (spark.sparkContext.applicationId, folder)
        if seen not in _sized:
            paths = [f"{folder}/{name}.parquet" for name in ("customer", "orders", "lineitem", "events")]
            fit_shuffles(spark, raw.stored_bytes(spark, *paths))
            _sized.add(seen)
        return query(spark, folder)

    return run


def entry(spark: SparkSession) -> DataFrame:
    """Monthly admission figures from the raw tables through silver and gold."""
    return agg_monthly_admissions(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    """One entry per query; each takes (spark, folder of the tables)."""
    return {name: _fitted(query) for name, query in _queries().items()}


def _queries() -> dict[str, Query]:
    return {
        "bronze_audit_hash": bronze_audit_hash,
        "dq_profile": dq_profile,
        "dq_null_pct": dq_null_pct,
        "dq_high_null": dq_high_null,
        "dq_duplicates": dq_duplicates,
        "stage_metrics": stage_metrics,
        "incremental_admissions": incremental_admissions,
        "pipeline_two_loads": rehearsal.two_loads,
        "scan_evidence": rehearsal.evidence,
        "silver_patients": silver_patients,
        "silver_admissions": silver_admissions,
        "quarantine_admissions": quarantine_admissions,
        "silver_billing": silver_billing,
        "silver_billing_keep_first": silver_billing_keep_first,
        "silver_bed_occupancy": silver_bed_occupancy,
        "dim_date": dim_date,
        "dim_patient": _stored("dim_patient"),
        "dim_department": _stored("dim_department"),
        "dim_doctor": _stored("dim_doctor"),
        "fact_admissions": _stored("fact_admissions"),
        "fact_billing": _stored("fact_billing"),
        "fact_bed_occupancy": _stored("fact_bed_occupancy"),
        "orphan_keys": orphan_keys,
        "agg_monthly_admissions": agg_monthly_admissions,
        "agg_dept_kpis": agg_dept_kpis,
        "agg_revenue_summary": agg_revenue_summary,
        "bill_derivation": bill_derivation,
        "occupancy_arithmetic": occupancy_arithmetic,
        "m_admissions_total": _measures(*ADMISSION_MEASURES),
        "m_admissions_by_month": _measures(*ADMISSION_MEASURES, by=(MONTH,)),
        "m_clinical_by_department": _measures(*ADMISSION_MEASURES, by=(DEPARTMENT,)),
        "m_admissions_by_doctor": _measures("total_admissions", "avg_length_of_stay", by=("dim_doctor.doctor_name",)),
        "m_admissions_by_patient_city": _measures(
            "total_admissions", "total_unique_patients", "total_revenue", by=("dim_patient.city",)
        ),
        "m_occupancy_by_month": _measures(
            "avg_occupancy_rate_pct", "departments_at_critical_capacity", *BED_MEASURES, by=(MONTH,)
        ),
        "m_occupancy_by_department": _measures(
            "avg_occupancy_rate_pct", "departments_at_critical_capacity", *BED_MEASURES, by=(DEPARTMENT,)
        ),
        "m_occupancy_last_date": _measures("avg_occupancy_rate_pct", *BED_MEASURES),
        "m_occupancy_last_date_strict": _measures(
            "avg_occupancy_rate_pct", *BED_MEASURES, by=(MONTH,), last_date="calendar"
        ),
        "m_revenue_total": _measures(*REVENUE_MEASURES, "revenue_per_admission"),
        "m_revenue_by_insurance": _measures(*REVENUE_MEASURES, by=(INSURANCE,)),
        "m_revenue_by_department": _measures(*REVENUE_MEASURES, "revenue_per_admission", by=(DEPARTMENT,)),
        "m_revenue_by_month": _measures(*REVENUE_MEASURES, "revenue_per_admission", by=(MONTH,)),
        "m_revenue_per_admission_by_insurance": _measures(
            "total_revenue", "total_admissions", "revenue_per_admission", by=(INSURANCE,)
        ),
        "m_pending_by_status": _measures("total_revenue", "pending_bills", by=("fact_billing.payment_status",)),
        "m_patients": _measures("total_unique_patients", "avg_patient_age", "female_patient_pct"),
        "m_patients_by_department": _measures(
            "total_unique_patients", "avg_patient_age", "female_patient_pct", by=(DEPARTMENT,)
        ),
        "m_patients_by_gender": _measures(
            "total_unique_patients", "avg_patient_age", "female_patient_pct", by=("dim_patient.gender",)
        ),
        "m_patients_ytd": _measures("total_unique_patients", "ytd_unique_patients", by=(MONTH,)),
        "m_patients_rolling_12m": _measures("unique_patients_rolling_12m", by=(MONTH, DEPARTMENT)),
        "m_totals_rollup": m_totals_rollup,
        "m_emergency_override": _measures(
            "total_admissions", "emergency_rate_pct", by=("fact_admissions.admission_type",)
        ),
        "m_emergency_by_type_department": _measures(
            "total_admissions", "emergency_rate_pct", by=("fact_admissions.admission_type", DEPARTMENT)
        ),
        "m_filtered_year": _measures(
            "total_admissions", "total_revenue", "ytd_admissions", "py_admissions", by=("dim_date.quarter_label",),
            where={"dim_date.year": 1998},
        ),
        "m_filtered_type": _measures(
            "total_admissions", "emergency_rate_pct", "total_revenue", by=(DEPARTMENT,),
            where={"fact_admissions.admission_type": ["Planned", "Referral"]},
        ),
        "ti_ytd": _measures("total_admissions", "ytd_admissions", "ytd_revenue", by=(MONTH,)),
        "ti_qtd": _measures("total_admissions", "qtd_admissions", by=("dim_date.full_date",)),
        "ti_prior_year": _measures(
            "total_admissions", "py_admissions", "admission_growth_yoy_pct", "total_revenue", "py_revenue",
            "revenue_growth_yoy_pct", by=(MONTH,),
        ),
        "ti_prior_year_by_day": _measures("total_admissions", "py_admissions", by=("dim_date.full_date",)),
        "ti_prior_year_by_year": _measures(
            "total_admissions", "py_admissions", "admission_growth_yoy_pct", by=("dim_date.year",)
        ),
        "ti_mom": _measures("total_revenue", "mom_revenue_change_pct", by=(MONTH,)),
        "ti_rolling_12m": _measures("total_revenue", "revenue_rolling_12m", by=(MONTH,)),
        "ti_rolling_12m_by_department": _measures(
            "total_revenue", "revenue_rolling_12m", by=("dim_date.year_quarter", DEPARTMENT)
        ),
        "ti_los_rolling_3m": ti_los_rolling_3m,
        "dept_rank_top3": _measures(
            "total_admissions", "dept_rank_by_admissions", "is_top_3_department", by=(DEPARTMENT,)
        ),
        "dept_rank_by_month": dept_rank_by_month,
        "kpi_colors": _measures(
            "readmission_kpi_color", "occupancy_kpi_color", "collection_kpi_color", by=(DEPARTMENT,)
        ),
        "rls_dept_manager": _secured(["DeptManager"], DEPARTMENT),
        "rls_read_only": _secured(["ReadOnly"], DEPARTMENT),
        "rls_multi_role": _secured(["DeptManager", "ReadOnly"], DEPARTMENT),
        "rpt_exec_cards": _report(reports.exec_cards),
        "rpt_trends": _report(reports.trends),
        "rpt_los_distribution": _report(reports.los_distribution),
        "rpt_admission_type": _report(reports.admission_type),
        "rpt_dept_heatmap": _report(reports.dept_heatmap),
        "rpt_quality": _report(reports.quality),
        "rpt_revenue_insurance": _report(reports.revenue_insurance),
        "rpt_occupancy_heatmap": _report(reports.occupancy_heatmap),
        "rpt_occupancy_trend": _report(reports.occupancy_trend),
        "rpt_critical_alerts": _report(reports.critical_alerts),
        **(llm_queries.QUERIES | {"pipeline": corpus_pipeline.run} if llm_queries else {}),
    }


def oracle_sql() -> dict[str, str]:
    """For each query the same result in SQL over the same tables."""
    more = dict(llm_oracles.ORACLES) if llm_queries else {}
    if llm_queries and corpus_pipeline.ORACLE_SQL:
        more["pipeline"] = corpus_pipeline.ORACLE_SQL
    return dict(ORACLES) | more
