"""Properties the plans must keep to run on large tables."""

import os

import pytest

from __spark_entry__ import queries
from oreline import session
from oreline.operators import profile
from oreline.plans import gold
from oreline.plans.lake import Lake
from oreline.plans.measures import pick

FOLDER = "/root/testdata/sf0.001"
HEAVY = [
    "silver_billing", "silver_admissions", "stage_metrics", "dim_department", "dim_doctor", "fact_admissions",
    "m_revenue_by_department", "m_patients_by_department", "ti_rolling_12m", "rpt_trends", "rls_multi_role", "orphan_keys",
]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", HEAVY)
def test_no_cross_joins_and_no_python(spark, no_broadcast, name):
    plan = plan_of(queries()[name](spark, FOLDER))
    for operator in ("CartesianProduct", "NestedLoop", "Python", "Pandas"):
        assert operator not in plan


@pytest.mark.parametrize("name", ["m_revenue_by_department", "m_patients_by_department", "ti_rolling_12m", "rpt_trends"])
def test_measures_force_no_broadcast(spark, no_broadcast, name):
    assert "Broadcast" not in plan_of(queries()[name](spark, FOLDER))


def test_bills_are_reduced_before_they_meet_admissions(spark, no_broadcast):
    star = Lake(spark, FOLDER).star().with_tables({"fact_billing_keyed": None})
    plan = plan_of(star.query(pick("total_revenue"), ["dim_department.department_name"]))
    join = plan.index("SortMergeJoin [_fk_admission_id")
    assert "partial_sum(total_amount" in plan[join:]


@pytest.mark.parametrize("name", [
    "m_revenue_by_department", "m_revenue_by_month", "m_filtered_type", "rpt_trends", "ti_ytd", "ti_prior_year", "ti_mom", "ti_rolling_12m", "rls_dept_manager",
    "rls_multi_role",
])
def test_bills_and_admissions_do_not_meet(spark, no_broadcast, name):
    """Bills carry the keys of their admission."""
    plan = plan_of(queries()[name](spark, FOLDER))
    assert "admission_id" not in plan and "fact_admissions__" in plan


def test_all_periods_share_one_scan_of_the_bills(spark):
    measures = pick("total_revenue", "ytd_revenue", "py_revenue", "mom_revenue_change_pct", "revenue_rolling_12m")
    plan = plan_of(Lake(spark, FOLDER).star().query(measures, ["dim_date.year_month"]))
    assert plan.count("total_amount#") and sum("total_amount" in line for line in plan.splitlines() if "FileScan" in line) == 1


def test_all_levels_share_one_scan_of_each_reduction(spark):
    """Plain measures read the fact once for all levels, distinct counts once."""
    plan = plan_of(queries()["m_totals_rollup"](spark, FOLDER))
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert sum("readmission_flag" in line for line in scans) == 1 and sum("patient_id" in line for line in scans) == 1
    assert "Expand" in plan


def test_a_profile_is_one_scan_and_one_shuffle_of_rows(spark):
    df = spark.read.parquet(f"{FOLDER}/orders.parquet")
    plan = plan_of(profile.profile(df, df.columns, "orders"))
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1


def test_only_needed_columns_are_read(spark):
    plan = plan_of(Lake(spark, FOLDER).star().query(pick("total_admissions"), ["fact_admissions.los_category"]))
    (scan,) = [line for line in plan.splitlines() if "FileScan" in line]
    assert "ReadSchema: struct<los_category:string>" in scan


def test_a_year_filter_prunes_partitions(spark):
    query = Lake(spark, FOLDER).star().query(pick("total_admissions"), ["dim_date.month"], {"dim_date.year": 1998})
    plan = plan_of(query)
    scans = [line for line in plan.splitlines() if "FileScan" in line and "admission_year" in line]
    assert scans and all("PartitionFilters: [isnotnull(admission_year" in line for line in scans)


def test_doctors_are_numbered_without_a_global_sort(spark):
    silver = Lake(spark, FOLDER).table("silver_admissions")
    plan = plan_of(gold.dim_doctor(gold.doctor_names(silver)))
    # The only single task adds up at most 256 range sizes.
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 2 and all("_range" in line for line in windows)


def test_stored_tables_live_in_the_folder_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    lake = Lake(spark, FOLDER)
    lake.table("dim_date")
    assert lake.root.startswith(named) and os.path.isdir(f"{lake.root}/dim_date")


def test_shuffles_grow_with_the_input(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert session.fit_shuffles(spark, 10 * session.SHUFFLE_TARGET) == max(int(before), 10)
        assert session.fit_shuffles(spark, 1) == max(int(before), 10)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
