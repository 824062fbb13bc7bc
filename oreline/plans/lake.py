"""Gold tables derived from the test tables, stored once per session and source folder.

Measures are meant to run over stored gold tables. Reading them back cuts the lineage to the raw
tables and gives the planner their true sizes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from oreline.operators.profile import profile
from oreline.plans import gold, silver
from oreline.plans.star import COMPANIONS, PATIENT_BITS, TABLE_NAMES, Star
from oreline.schemas import TABLES
from oreline.session import shared_folder
from oreline.sources.binding import AS_OF, bind
from oreline.sources.sinks import write_parquet

# What a star reads.
STORED = [*TABLE_NAMES, *COMPANIONS.values(), *PATIENT_BITS]
# Schemas of the stored tables by path.
_written: dict[str, T.StructType] = {}


class Lake:
    """Silver and gold tables over one folder of test tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        digest = hashlib.sha256(folder.encode()).hexdigest()[:16]
        self.root = f"{shared_folder(spark)}/oreline/{spark.sparkContext.applicationId}/{digest}"

    def _builders(self) -> dict[str, Callable[[], DataFrame]]:
        def raw(name: str) -> DataFrame:
            return bind(self.spark, self.folder, name)

        reports = {f"report_{n}": lambda n=n, t=t: profile(raw(n), t.columns, n) for n, t in TABLES.items()}
        return reports | {
            "silver_patients": lambda: silver.patients(raw("patients"), AS_OF),
            "silver_admissions": lambda: silver.admissions(raw("admissions"), AS_OF)[0],
            "silver_billing": lambda: silver.billing(raw("billing")),
            "silver_bed_occupancy": lambda: silver.bed_occupancy(raw("bed_occupancy")),
            "dim_date": lambda: gold.dim_date(gold.span_of_facts(self.table("silver_admissions"), self.table("silver_bed_occupancy"))),
            "dim_patient": lambda: gold.dim_patient(self.table("silver_patients")),
            # Numbering reads the names more than once, so they are stored first.
            "names_department": lambda: gold.department_names(self.table("silver_admissions")),
            "names_doctor": lambda: gold.doctor_names(self.table("silver_admissions")),
            "dim_department": lambda: gold.dim_department(self.table("names_department")),
            "dim_doctor": lambda: gold.dim_doctor(self.table("names_doctor")),
            "fact_admissions": lambda: gold.fact_admissions(
                self.table("silver_admissions"), self.table("dim_department"), self.table("dim_doctor")
            ),
            "fact_billing": lambda: gold.fact_billing(self.table("silver_billing")),
            "fact_billing_keyed": lambda: gold.fact_billing_keyed(self.table("fact_billing"), self.table("fact_admissions")),
            "names_patient": lambda: self.table("fact_admissions").select("patient_id").distinct(),
            "patient_numbers": lambda: gold.patient_numbers(self.table("names_patient")),
            "patient_months": lambda: gold.patient_months(self.table("fact_admissions"), self.table("patient_numbers")),
            "fact_bed_occupancy": lambda: gold.fact_bed_occupancy(
                self.table("silver_bed_occupancy"), self.table("dim_department")
            ),
        }

    def build(self, name: str) -> DataFrame:
        """The table as a plan over the tables before it."""
        return self._builders()[name]()

    def table(self, name: str) -> DataFrame:
        """The stored table, written on first use."""
        path = f"{self.root}/{name}"
        if path not in _written:
            built = self.build(name)
            write_parquet(built, path, partition_by=gold.PARTITIONS.get(name))
            _written[path] = built.schema
        return self.spark.read.schema(_written[path]).parquet(path).select(*_written[path].names)

    def star(self, last_date: str = "data") -> Star:
        """A star that stores and reads each table when a query first asks for it."""
        return Star(_TablesOf(self), last_date)


class _TablesOf(dict):
    def __init__(self, lake: Lake):
        super().__init__()
        self._lake = lake

    def __missing__(self, name: str) -> DataFrame:
        if name not in STORED:
            raise KeyError(name)
        self[name] = self._lake.table(name)
        return self[name]
