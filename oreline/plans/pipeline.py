"""One run over all layers: check files, bronze, silver, gold, logs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreline.operators.dedup import dedup
from oreline.operators.keys import register
from oreline.operators.profile import summary
from oreline.operators.stages import stage_sizes
from oreline.plans import bronze, gold, silver, upkeep
from oreline.plans.star import Star
from oreline.schemas import TABLES
from oreline.session import fit_shuffles
from oreline.sources import control, ledger, raw, sinks

NAME = "layered_tables"
HASH = ["_record_hash"]
# The year that silver tables are stored by, as their facts are.
SILVER_YEAR = {"admissions": "admission_year", "billing": "bill_year", "bed_occupancy": "snapshot_year"}
T = TypeVar("T")


@dataclass
class Run:
    """Settings of one run.

    ``as_of`` is the date ages and open stays are counted to, ``run_ts`` the stamp on all rows.
    Silver keeps the latest version of a key unless ``keep`` is ``first``. Without a ``calendar`` it covers the years of the facts.
    """

    spark: SparkSession
    landing: str
    root: str
    run_id: str
    as_of: dt.date
    run_ts: dt.datetime
    load_type: str = "incremental"
    overlap: str | None = None
    keep: str = "last"
    calendar: tuple[dt.date, dt.date] | None = gold.DEFAULT_CALENDAR
    tables: Sequence[str] = field(default_factory=lambda: list(TABLES))

    # ---- places ----------------------------------------------------------------------------

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def read(self, layer: str, name: str) -> DataFrame:
        return raw.scan_layer(self.spark, self.path(layer, name))

    # ---- steps -----------------------------------------------------------------------------

    def check_files(self) -> DataFrame:
        expected = [TABLES[name].file_name for name in self.tables]
        lost = [r["file_name"] for r in raw.missing_files(self.spark, self.landing, expected).collect()]
        if lost:
            raise FileNotFoundError(f"missing in {self.landing}: {', '.join(sorted(lost))}")
        return raw.check_files(self.spark, self.landing, expected)

    def bronze(self, name: str) -> DataFrame:
        """Load one table; its mark moves only after the data and the report are stored.

        The ledger fixes the mark a load starts from before it reads. A run that starts again reads from there, up to the mark it has
        reached before, so it stores the same rows again whatever other runs have loaded since. Data of a run that the ledger does
        not know is not overwritten.
        """
        table, ledger_path, target = TABLES[name], self.path("control", "loads"), self.path("bronze", name)
        stored = raw.stored(self.spark, f"{target}/load={self.run_id}")
        load = ledger.begin(self.spark, ledger_path, name, self.run_id, self.load_type, self.run_ts, self.overlap, stored)
        written, counts = bronze.ingest(
            self.spark, f"{self.landing}/{table.file_name}", target, table, self.run_id, self.run_ts, load.load_type, load.start_mark,
            load.overlap, load.until, self._unmarked(name, load), load.rows,
        )
        report_path = self.path("reports", f"bronze/load={self.run_id}/{name}")
        sinks.write_json(bronze.report(written, table), report_path)
        control.advance_mark(self.spark, self.path("control", "marks"), name, counts.mark, self.run_id, self.run_ts)
        ledger.finish(self.spark, ledger_path, load, counts.mark, counts.rows, counts.without_mark, self.run_ts)
        return self.spark.read.json(report_path)

    def _unmarked(self, name: str, load: ledger.Load) -> DataFrame | None:
        """Hashes of rows without a usable watermark in earlier loads, where there are any."""
        if load.start_mark is None:
            return None
        before = ledger.loads(self.spark, self.path("control", "loads")).where(
            (F.col("table") == name) & (F.col("seq") < load.seq) & (F.col("without_mark") > 0)
        )
        paths = [f"{self.path('bronze', name)}/load={r.run_id}" for r in before.select("run_id").collect()]
        if not paths:
            return None
        watermark = TABLES[name].watermark
        stored = self.spark.read.schema(f"{watermark} string, _record_hash string").parquet(*paths)
        return stored.where(F.try_to_timestamp(F.col(watermark)).isNull()).select("_record_hash").distinct()

    def silver(self, name: str, full: bool = False) -> DataFrame | None:
        """Bring one silver table up to date with the loads that it does not hold yet; returns its stage counts.

        The first row of each key in the new loads is compared with the stored row. Where it wins, it replaces that row, in silver or among the
        rejected ones, and only the years it touches are written. A first build, ``full``, another ``keep`` or new columns take all loads.
        """
        table, target = TABLES[name], self.path("silver", name)
        loads, merged = self.path("control", "loads"), self.path("control", "merged")
        fresh, every = upkeep.pending(self.spark, self.path("bronze", name), loads, merged, name)
        as_of, keep = upkeep.last_state(self.spark, merged, name)
        full = full or keep != self.keep or not raw.stored(self.spark, target)
        if not full and fresh:
            changes = self._best(name, fresh)
            full = not set(changes.columns) <= set(raw.scan_layer(self.spark, target).columns)
        if full or (name == "patients" and as_of != self.as_of):
            # Ages of all patients follow the date.
            self._rebuild(name)
        else:
            self._merge(name, self._winners(name, changes) if fresh else None, as_of)
        upkeep.record(self.spark, merged, name, every, self.as_of, self.keep, self.run_ts)
        return self._stages(name, bronze.read_all(self.spark, self.path("bronze", name), table))

    def _rejects(self, name: str) -> str:
        return self.path("quarantine" if name == "admissions" else "rejected", name)

    def _best(self, name: str, fresh: Sequence[str]) -> DataFrame:
        """One row per key of some loads, the one that the dedup keeps."""
        table, base = TABLES[name], self.path("bronze", name)
        rows = bronze.read_loads(self.spark, base, fresh, table)
        return dedup(rows, table.key, [table.watermark], self.keep, HASH)

    def _stage(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path("staging", name)
        sinks.write_parquet(df, path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _cleaned(self, name: str, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(valid rows of the silver table, rejected ones) of rows with distinct keys."""
        key = TABLES[name].key
        if name == "admissions":
            marked = silver.marked_admissions(rows, None)
            return silver.valid_admissions(marked, self.as_of, self.run_ts), silver.quarantined_admissions(marked)
        if name == "patients":
            valid = silver.patients(rows, self.as_of, self.run_ts, None)
        elif name == "billing":
            valid = silver.billing(rows, self.run_ts, None)
        else:
            valid = silver.bed_occupancy(rows, self.run_ts, None)
        return valid, rows.join(valid.select(F.col(key).alias("_key")), rows[key].eqNullSafe(F.col("_key")), "left_anti")

    def _rebuild(self, name: str) -> None:
        """Silver and rejected rows from all loads. The survivors of the dedup are stored, so that the two sides of the split do not repeat it."""
        _, every = upkeep.pending(self.spark, self.path("bronze", name), self.path("control", "loads"), self.path("control", "merged"), name)
        staged = self._stage(self._best(name, [load for load, _ in every]), f"{name}_all")
        valid, rejected = self._cleaned(name, staged)
        if name in SILVER_YEAR:
            upkeep.note(self.spark, self.path("control", "touched"), name, [upkeep.ALL_YEARS], self.run_ts)
        sinks.write_parquet(valid, self.path("silver", name), partition_by=SILVER_YEAR.get(name))
        if raw.stored(self.spark, self._rejects(name)) or not rejected.isEmpty():
            sinks.write_parquet(rejected, self._rejects(name))

    def _winners(self, name: str, changes: DataFrame) -> DataFrame:
        """New rows that replace the stored row of their key or are the first of it."""
        table = TABLES[name]
        old = [self.read("silver", name)]
        if raw.stored(self.spark, self._rejects(name)):
            old.append(raw.scan_layer(self.spark, self._rejects(name)))
        order = [table.watermark, *HASH]
        return self._stage(upkeep.winners(changes, old, table.key, order, self.keep), f"{name}_winners")

    def _merge(self, name: str, won: DataFrame | None, as_of: dt.date) -> None:
        """Replace the rows of the keys that won; open stays also follow the date they are counted to."""
        key, target, year = TABLES[name].key, self.path("silver", name), SILVER_YEAR.get(name)
        changed, valid, rejected = None, None, None
        if won is not None:
            valid, rejected = self._cleaned(name, won)
            changed = won.select(key)
        if name == "admissions" and as_of != self.as_of:
            open_stays = self.read("silver", name).where(F.col("discharge_date").isNull())
            if changed is not None:
                mine = changed.withColumnRenamed(key, "_key")
                open_stays = open_stays.join(mine, open_stays[key].eqNullSafe(F.col("_key")), "left_anti")
            counted = silver.recounted_stays(open_stays, self.as_of, self.run_ts)
            valid = counted if valid is None else valid.unionByName(counted)
            changed = counted.select(key) if changed is None else changed.unionByName(counted.select(key))
        if changed is None:
            return
        valid = self._stage(valid, f"{name}_valid").select(*self.read("silver", name).columns)
        changed = self._stage(changed, f"{name}_changed")
        if year is None:
            upkeep.merge_whole(target, self.path("staging", f"{name}_merged"), key, changed, valid)
        else:
            years = upkeep.touched_years(target, key, changed, valid, year)
            upkeep.note(self.spark, self.path("control", "touched"), name, years, self.run_ts)
            upkeep.merge(target, self.path("staging", f"{name}_merged"), key, changed, valid, year, years)
        if rejected is not None and (raw.stored(self.spark, self._rejects(name)) or not rejected.isEmpty()):
            upkeep.merge_whole(self._rejects(name), self.path("staging", f"{name}_rejected"), key, changed, rejected)

    def _stages(self, name: str, everything: DataFrame) -> DataFrame | None:
        """Rows before and after each stage, from the stored tables."""
        valid, keys = self.read("silver", name), TABLES[name].key
        unique = valid.select(keys)
        if raw.stored(self.spark, self._rejects(name)):
            unique = unique.unionByName(raw.scan_layer(self.spark, self._rejects(name)).select(keys))
        stages = {
            "patients": [("dedup_patient_id", unique), ("valid_dob", valid)],
            "admissions": [("dedup_admission_id", unique), ("valid_date_order", valid)],
            "billing": [("dedup_bill_id", unique)],
        }
        return stage_sizes(everything, name, stages[name]) if name in stages else None

    def _keys(self, kind: str, names: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(stored names, the registry of their keys). A name keeps the key that it was given first, in whatever run."""
        name, key = f"{kind}_name", f"{kind}_key"
        path = self.path("keys", kind)
        names = self._stage(names, f"names_{kind}")
        known = raw.scan_layer(self.spark, path) if raw.stored(self.spark, path) else None
        fresh = self._stage(register(names, known, name, key), f"keys_{kind}")
        if not fresh.isEmpty():
            sinks.write_parquet(fresh.coalesce(1), path, mode="append")
        return names, raw.scan_layer(self.spark, path)

    def gold(self, rebuild_dims: bool = True, rebuild_facts: bool = True, rebuild_aggs: bool = True, full: bool = False) -> None:
        """Bring the chosen kinds of tables up to date; each step reads what the one before has stored.

        Facts are written for the years that silver has touched since, all of them on a first build or with ``full``. Departments and doctors
        have their keys from a registry, so facts that are not written again stay right.
        """
        silver_of = lambda name: self.read("silver", name)
        stored = lambda name: self.read("gold", name)
        if rebuild_dims:
            departments, department_keys = self._keys("department", gold.department_names(silver_of("admissions")))
            doctors, doctor_keys = self._keys("doctor", gold.doctor_names(silver_of("admissions")))
            dims = {
                "dim_date": gold.dim_date(
                    gold.fixed_span(self.spark, *self.calendar) if self.calendar else gold.span_of_facts(silver_of("admissions"), silver_of("bed_occupancy"))
                ),
                "dim_patient": gold.dim_patient(silver_of("patients")),
                "dim_department": gold.dim_department(departments, department_keys),
                "dim_doctor": gold.dim_doctor(doctors, doctor_keys),
            }
            for name, df in dims.items():
                sinks.write_parquet(df, self.path("gold", name))
        if rebuild_facts:
            notes = self.path("control", "touched")
            noted = upkeep.noted(self.spark, notes)
            self._facts({} if full else {t: list(years) for t, years in noted.items()}, full)
            upkeep.strike(self.spark, notes, noted, self.run_ts)
        if rebuild_aggs:
            sinks.write_parquet(gold.agg_monthly_admissions(stored("fact_admissions")), self.path("gold", "agg_monthly_admissions"))
            sinks.write_parquet(gold.agg_dept_kpis(stored("fact_admissions")), self.path("gold", "agg_dept_kpis"))
            sinks.write_parquet(gold.agg_revenue_summary(stored("fact_billing")), self.path("gold", "agg_revenue_summary"))

    def _facts(self, touched: dict[str, upkeep.Years], full: bool) -> None:
        silver_of = lambda name: self.read("silver", name)
        stored = lambda name: self.read("gold", name)
        builds: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
            "fact_admissions": ("admissions", lambda df: gold.fact_admissions(df, stored("dim_department"), stored("dim_doctor"))),
            "fact_billing": ("billing", gold.fact_billing),
            "fact_bed_occupancy": ("bed_occupancy", lambda df: gold.fact_bed_occupancy(df, stored("dim_department"))),
        }
        keyed = "fact_billing_keyed"
        every = {
            name for name, (source, _) in builds.items()
            if full or upkeep.ALL_YEARS in touched.get(source, []) or not raw.stored(self.spark, self.path("gold", name))
        }
        whole = not raw.stored(self.spark, self.path("gold", keyed)) or bool(every & {"fact_admissions", "fact_billing"})
        for name, (source, build) in builds.items():
            column, years = gold.PARTITIONS[name], touched.get(source, [])
            if name in every:
                sinks.write_parquet(build(silver_of(source)), self.path("gold", name), partition_by=column)
            elif years:
                rows = build(silver_of(source).where(upkeep.in_years(SILVER_YEAR[source], years)))
                upkeep.write_years(rows, self.path("gold", name), self.path("staging", name), column, years)
        if whole:
            rows = gold.fact_billing_keyed(stored("fact_billing"), stored("fact_admissions"))
            sinks.write_parquet(rows, self.path("gold", keyed), partition_by=gold.PARTITIONS[keyed])
        elif touched.get("admissions") or touched.get("billing"):
            self._keyed_bills(touched.get("admissions", []), touched.get("billing", []))

    def _keyed_bills(self, admission_years: upkeep.Years, bill_years: upkeep.Years) -> None:
        """Write the bills of the admission years again that changed admissions or bills stand in, and those without an admission.

        A bill that was or is in none of these has neither changed itself nor has its admission.
        """
        column = gold.PARTITIONS["fact_billing_keyed"]
        old, bills, admissions = self.read("gold", "fact_billing_keyed"), self.read("gold", "fact_billing"), self.read("gold", "fact_admissions")
        new = bills.where(upkeep.in_years("bill_year", bill_years)) if bill_years else bills.limit(0)
        years = {None, *admission_years}
        years |= set(upkeep.years_of(old.join(new.select("bill_id"), "bill_id", "left_semi"), column))
        years |= set(upkeep.years_of(admissions.join(new.select("admission_id"), "admission_id", "left_semi"), "admission_year"))
        ordered = sorted(years, key=lambda y: (y is None, y or 0))
        ids = old.where(upkeep.in_years(column, ordered)).select("bill_id").unionByName(new.select("bill_id")).distinct()
        rows = gold.fact_billing_keyed(bills.join(ids, "bill_id", "left_semi"), admissions.where(upkeep.in_years("admission_year", ordered)))
        upkeep.write_years(rows.select(*old.columns), self.path("gold", "fact_billing_keyed"), self.path("staging", "fact_billing_keyed"), column, ordered)

    def star(self, last_date: str = "data") -> Star:
        return Star.read(self.spark, f"{self.root}/gold", last_date)

    # ---- the whole run ---------------------------------------------------------------------

    def _guard(self, name: str, stage: str, step: Callable[[], T]) -> T:
        try:
            return step()
        except Exception as error:
            control.log_failure(
                self.spark, self.path("control", "failures"), name, stage, error, self.run_id, self.run_ts
            )
            control.log_run(self.spark, self.path("control", "runs"), NAME, "FAILED", self.run_id, self.run_ts)
            raise

    def all(
        self, rebuild_dims: bool = True, rebuild_facts: bool = True, rebuild_aggs: bool = True, full: bool = False
    ) -> DataFrame:
        """Run every step and return the stage counts; a failure is logged and raised. ``full`` builds silver and gold from all loads."""
        self._guard("*", "check_files", self.check_files)
        fit_shuffles(self.spark, raw.stored_bytes(self.spark, self.landing))
        for name in self.tables:
            self._guard(name, "bronze", lambda name=name: self.bronze(name))
        counts = [self._guard(name, "silver", lambda name=name: self.silver(name, full)) for name in self.tables]
        self._guard("*", "gold", lambda: self.gold(rebuild_dims, rebuild_facts, rebuild_aggs, full))
        control.log_run(self.spark, self.path("control", "runs"), NAME, "SUCCESS", self.run_id, self.run_ts)
        return summary([c for c in counts if c is not None])

