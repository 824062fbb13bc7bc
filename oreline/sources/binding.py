"""The four source tables derived from the TPC-H-like test tables.

Every column is a plain expression over whole tables, so the derived tables grow with them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreline.schemas import TABLES
from oreline.sources.raw import spread

AS_OF = dt.date(2002, 1, 1)

# Fixed values of the derived tables.
DEPARTMENTS = [
    "Cardiology", " orthopedics", "NEUROLOGY", "Emergency", "Pediatrics",
    "Oncology", "general medicine", "ICU", "Gynecology ", "Urology",
]
_DEPARTMENT_CASE = "case o_custkey % 10 " + " ".join(
    f"when {i} then '{name}'" for i, name in enumerate(DEPARTMENTS)
) + " end"


_schemas: dict[tuple[str, str], T.StructType] = {}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A test table; its footers are read for the schema once per session."""
    path = f"{folder}/{name}.parquet"
    seen = (spark.sparkContext.applicationId, path)
    if seen not in _schemas:
        _schemas[seen] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[seen]).parquet(path)


def patients(spark: SparkSession, folder: str) -> DataFrame:
    customer = _table(spark, folder, "customer")
    nation = _table(spark, folder, "nation").select("n_nationkey", "n_name")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).selectExpr(
        "concat('PAT', lpad(cast(c_custkey as string), 7, '0')) as patient_id",
        "c_name as first_name",
        "concat('Surname_', cast(c_custkey % 500 as string)) as last_name",
        """case c_custkey % 5 when 0 then ' male ' when 1 then 'FEMALE' when 2 then 'female'
           when 3 then 'Other' else 'unknown' end as gender""",
        """case when c_custkey % 37 = 0 then 'not-a-date'
           else cast(date_add(date'1930-01-01', cast((c_custkey * 97) % 26000 as int)) as string)
           end as date_of_birth""",
        """case c_custkey % 4 when 0 then 'A+' when 1 then 'B+' when 2 then 'O+' else 'AB-' end
           as blood_group""",
        "lower(n_name) as city",
        "case when c_acctbal < 0 then null else concat(' ', c_mktsegment) end as insurance_type",
        "'9000000000' as contact_number",
        "'2001-01-01 00:00:00' as created_at",
    )


def admissions(spark: SparkSession, folder: str, *extra: str) -> DataFrame:
    """``extra`` adds expressions over the order columns."""
    orders = spread(_table(spark, folder, "orders"), "o_orderkey")
    last_ship = (
        _table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.max(F.to_date("l_shipdate")).alias("ship"))
    )
    joined = orders.withColumn("day", F.to_date("o_orderdate")).join(last_ship, "o_orderkey", "left")
    return joined.withColumn("gap", F.datediff("ship", "day")).selectExpr(
        "concat('ADM', lpad(cast(o_orderkey as string), 7, '0')) as admission_id",
        "concat('PAT', lpad(cast(o_custkey as string), 7, '0')) as patient_id",
        f"{_DEPARTMENT_CASE} as department",
        "concat('dr. doc-', cast(o_orderkey % 12 as string)) as doctor_name",
        """case o_orderstatus when 'F' then 'emergency' when 'O' then 'Planned' else 'Referral' end
           as admission_type""",
        "cast(day as string) as admission_date",
        """cast(date_add(day, cast(sign(gap) * floor(abs(gap) / 50.0) as int)) as string)
           as discharge_date""",
        "cast(null as int) as length_of_stay",
        """case when o_orderkey % 10 = 7 then 'ICU' when o_orderkey % 2 = 0 then 'General'
           else 'Private' end as bed_type""",
        """case o_orderkey % 3 when 0 then 'cancer - stage ii' when 1 then 'covid-19'
           else ' asthma' end as diagnosis_primary""",
        """case when ship is null then null when o_orderkey % 20 = 3 then 'Death'
           else 'Recovered' end as discharge_status""",
        "case when o_orderkey % 7 = 0 then 1 else 0 end as readmission_flag",
        "concat('W', lpad(cast(o_orderkey % 20 + 1 as string), 2, '0')) as ward_number",
        "cast(day as string) as created_at",
        "cast(coalesce(ship, day) as string) as updated_at",
        *extra,
    )


def billing(spark: SparkSession, folder: str) -> DataFrame:
    lines = spread(_table(spark, folder, "lineitem"), "l_orderkey")
    owners = _table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    joined = lines.join(owners, lines.l_orderkey == owners.o_orderkey, "left")
    # Ten digits before the point keep the products below in the fast, long-backed decimals.
    charged = joined.selectExpr("*", "cast(l_extendedprice as decimal(12,2)) as amt").selectExpr(
        "*",
        """cast(round(amt * case l_returnflag when 'A' then 0.80 when 'N' then 0.00 else 0.90 end, 2)
           as decimal(18,2)) as insured""",
    )
    return charged.selectExpr(
        "concat('BILL', cast(l_orderkey * 10 + l_linenumber as string)) as bill_id",
        "concat('ADM', lpad(cast(l_orderkey as string), 7, '0')) as admission_id",
        "concat('PAT', lpad(cast(o_custkey as string), 7, '0')) as patient_id",
        "cast(to_date(l_shipdate) as string) as bill_date",
        "cast(amt as decimal(18,2)) as total_amount",
        "cast(round(amt * 0.35, 2) as decimal(18,2)) as room_charges",
        "cast(round(amt * 0.25, 2) as decimal(18,2)) as medicine_charges",
        "cast(round(amt * 0.30, 2) as decimal(18,2)) as procedure_charges",
        """cast(round(amt * 0.10, 2) + case when l_partkey % 11 = 0 then 5 else 0 end
           as decimal(18,2)) as misc_charges""",
        """case l_returnflag when 'A' then 'Star Health' when 'N' then 'Self-Pay' else 'Government' end
           as insurance_type""",
        "insured as insurance_amount",
        "cast(amt - insured as decimal(18,2)) as patient_payable",
        """case when l_partkey % 50 = 0 then null when l_suppkey % 20 < 13 then 'Paid'
           when l_suppkey % 20 < 17 then 'Pending' when l_suppkey % 20 < 19 then 'Partial'
           else 'Waived' end as payment_status""",
        "cast(to_date(l_shipdate) as string) as created_at",
    )


def bed_occupancy(spark: SparkSession, folder: str) -> DataFrame:
    daily = (
        _table(spark, folder, "events")
        .groupBy(F.to_date("ts").alias("day"), "event_type")
        .agg(F.count(F.lit(1)).cast("int").alias("occupied_beds"))
    )
    peak = daily.groupBy("event_type").agg(F.max("occupied_beds").alias("total_beds"))
    return daily.join(peak, "event_type").selectExpr(
        "concat('OCC', cast(day as string), '-', event_type) as occupancy_id",
        """case event_type when 'click' then 'Cardiology' when 'error' then 'ICU'
           when 'purchase' then 'Emergency' when 'signup' then 'Oncology' else 'Urology' end
           as department""",
        "cast(day as string) as snapshot_date",
        "total_beds",
        "occupied_beds",
        "total_beds - occupied_beds as available_beds",
        "cast(null as double) as occupancy_rate",
        "concat(cast(day as string), ' 23:00:00') as created_at",
    )


BINDINGS = {
    "patients": patients,
    "admissions": admissions,
    "billing": billing,
    "bed_occupancy": bed_occupancy,
}


def bind(spark: SparkSession, folder: str, name: str) -> DataFrame:
    df = BINDINGS[name](spark, folder)
    return df.select(*TABLES[name].columns)
