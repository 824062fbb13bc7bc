import datetime as dt

import pytest
from pyspark.sql import functions as F

from oreline.plans import silver
from oreline.plans.measures import pick
from oreline.plans.pipeline import Run
from oreline.schemas import TABLES
from oreline.sources import control, ledger
from oreline.streaming.ingest import ingest_available

D = dt.date
STAMP = dt.datetime(2024, 7, 1, 6, 0, 0)

PATIENTS = [
    "P1,A,B, female ,1980-05-01,A+, new delhi ,Star Health,900,2022-01-01 00:00:00",
    "P2,A,B,MALE,1990-05-01,A+,pune,,900,2022-01-02 00:00:00",
    "P3,A,B,unclear,1990-05-01,A+,pune,X,900,2022-01-03 00:00:00",
    "P4,A,B,Other,1990-13-01,A+,pune,X,900,2022-01-04 00:00:00",
]
ADMISSIONS = [
    "A1,P1,ICU,dr. x,emergency,2024-01-01,2024-01-05,4,ICU,flu,Recovered,0,W01,2024-01-01 00:00:00,2024-01-01 01:00:00",
    "A2,P2, cardiology,dr. y,Planned,2024-02-01,,,General,flu,,1,W01,2024-02-01 00:00:00,2024-02-01 01:00:00",
    "A3,P2,Cardiology,dr. y,Planned,2024-03-05,2024-03-01,,General,flu,Death,0,W01,2024-03-05 00:00:00,2024-03-05 01:00:00",
    "A4,P1,Cardiology,dr. x,Planned,2024-03-05,2024-03-05,,General,flu,Death,0,W01,2024-03-05 00:00:00,2024-03-05 02:00:00",
]
BILLING = [
    "B1,A1,P1,2024-01-05,10000.00,3500,2500,3000,1000,Star Health,8000,2000,Partial,2024-01-05",
    "B1,A1,P1,2024-01-05,10000.00,3500,2500,3000,1000,Star Health,8000,2000,Paid,2024-01-06",
    "B2,A4,P1,2024-03-05,500.00,100,100,100,100,Self-Pay,0,500,,2024-03-05",
]
OCCUPANCY = [
    "O1,ICU,2024-01-01,10,10,0,0,2024-01-01 23:00:00",
    "O2,ICU,2024-01-02,8,5,3,0,2024-01-02 23:00:00",
    "O3,ICU,someday,8,5,3,0,2024-01-03 23:00:00",
    "O4,ICU,2024-01-03,0,0,0,0,2024-01-03 23:00:00",
]
SOURCES = {"patients": PATIENTS, "admissions": ADMISSIONS, "billing": BILLING, "bed_occupancy": OCCUPANCY}


def drop(folder, name, lines, file_name=None):
    folder.mkdir(exist_ok=True)
    table = TABLES[name]
    text = "\n".join([",".join(table.columns), *lines]) + "\n"
    (folder / (file_name or table.file_name)).write_text(text)


def run(spark, base, run_id, **options):
    return Run(
        spark, str(base / "landing"), str(base / "lake"), run_id, D(2024, 6, 30), STAMP,
        calendar=(D(2023, 1, 1), D(2024, 12, 31)), **options,
    )


@pytest.fixture
def landing(tmp_path):
    for name, lines in SOURCES.items():
        drop(tmp_path / "landing", name, lines)
    return tmp_path


def test_two_runs_read_only_new_rows(spark, landing):
    first = run(spark, landing, "r1")
    counts = {(r["table"], r["stage"]): (r["before"], r["after"], r["dropped_stage"]) for r in first.all().collect()}
    assert counts == {
        ("patients", "dedup_patient_id"): (4, 4, 0),
        ("patients", "valid_dob"): (4, 2, 2),
        ("admissions", "dedup_admission_id"): (4, 4, 0),
        ("admissions", "valid_date_order"): (4, 3, 1),
        ("billing", "dedup_bill_id"): (3, 2, 1),
    }
    patients = {r["patient_id"]: r for r in first.read("silver", "patients").collect()}
    assert patients["P1"]["gender"] == "Female" and patients["P1"]["city"] == "New Delhi" and patients["P1"]["age"] == 44
    assert patients["P2"]["insurance_type"] == "Unknown" and patients["P2"]["age_band"] == "19-35"

    admissions = {r["admission_id"]: r for r in first.read("silver", "admissions").collect()}
    assert admissions["A2"]["length_of_stay"] == 150 and admissions["A2"]["discharge_status"] == "Active"
    assert admissions["A4"]["los_category"] == "Same Day" and admissions["A4"]["mortality_flag"] == 1
    assert admissions["A1"]["department"] == "Icu" and admissions["A1"]["_source_file"] == "admissions_raw.csv"
    rejected = first.read("quarantine", "admissions").collect()
    assert [(r["admission_id"], r["_reject_reason"], r["department"]) for r in rejected] == [
        ("A3", "discharge_before_admission", "Cardiology")
    ]
    bills = {r["bill_id"]: r for r in first.read("silver", "billing").collect()}
    assert bills["B1"]["payment_status"] == "Paid" and bills["B1"]["outstanding_amount"] == 0
    assert not bills["B2"]["_amount_check"] and bills["B2"]["payment_status"] == "Unknown"
    beds = {r["occupancy_id"]: r for r in first.read("silver", "bed_occupancy").collect()}
    assert set(beds) == {"O1", "O2", "O4"}
    assert beds["O4"]["occupancy_rate"] is None and beds["O4"]["occupancy_status"] == "Low"
    assert beds["O1"]["occupancy_status"] == "Critical" and beds["O2"]["occupancy_rate"] == 62.5

    report = spark.read.json(first.path("reports", "bronze/load=r1/billing")).first()
    assert report["status"] == "PASS" and report["row_count"] == 3

    star = first.star()
    row = star.query(pick("total_admissions", "total_revenue", "occupied_beds", "avg_occupancy_rate_pct")).first()
    assert tuple(row) == (3, 10500.0, 0, 81.25)

    # A2 is closed, A5 is new; A1 comes again unchanged and below the mark.
    drop(
        landing / "landing", "admissions",
        [ADMISSIONS[0],
         "A2,P2,cardiology,dr. y,Planned,2024-02-01,2024-02-03,,General,flu,Recovered,1,W01,2024-02-01 00:00:00,2024-04-01 00:00:00",
         "A5,P2,Urology,dr. z,Referral,2024-04-01,,,General,flu,,0,W01,2024-04-01 00:00:00,2024-04-01 03:00:00"],
    )
    second = run(spark, landing, "r2")
    second.all()
    assert second.read("bronze", "admissions/load=r2").count() == 2
    assert second.read("bronze", "billing/load=r2").count() == 0
    admissions = {r["admission_id"]: r for r in second.read("silver", "admissions").collect()}
    assert set(admissions) == {"A1", "A2", "A4", "A5"} and admissions["A2"]["length_of_stay"] == 2
    marks = {r["table"]: r["mark"] for r in control.read_marks(spark, second.path("control", "marks")).collect()}
    assert marks["admissions"] == "2024-04-01 03:00:00"
    runs = control.read_runs(spark, second.path("control", "runs")).collect()
    assert sorted((r["run_id"], r["status"]) for r in runs) == [("r1", "SUCCESS"), ("r2", "SUCCESS")]
    departments = {r["department_name"]: r["department_key"] for r in second.read("gold", "dim_department").collect()}
    assert departments == {"Cardiology": 1, "Icu": 2, "Urology": 3}


def test_a_repeated_load_replaces_itself(spark, landing):
    once = run(spark, landing, "r1", load_type="full")
    once.bronze("billing")
    once.bronze("billing")
    assert once.read("bronze", "billing").count() == 3


def bill(number, stamp):
    return f"B{number},A1,P1,2024-01-05,100.00,35,25,30,10,Self-Pay,0,100,Paid,{stamp}"


def bills_of(one, run_id=None):
    df = one.read("bronze", "billing")
    return sorted(r["bill_id"] for r in (df.where(f"load = '{run_id}'") if run_id else df).collect())


@pytest.mark.parametrize("order", [["r1", "r2", "r1"], ["r1", "r2", "r3", "r2", "r1"]])
def test_a_replay_reads_what_its_run_has_read(spark, tmp_path, order):
    (tmp_path / "landing").mkdir()
    stamps = {"r1": [1, 2], "r2": [3], "r3": [4, 5]}
    seen, lines = set(), []
    for run_id in order:
        if run_id not in seen:
            lines += [bill(n, f"2024-01-0{n}") for n in stamps[run_id]]
            drop(tmp_path / "landing", "billing", lines)
        seen.add(run_id)
        one = run(spark, tmp_path, run_id)
        one.bronze("billing")
        for other in seen:
            assert bills_of(one, other) == [f"B{n}" for n in stamps[other]]
    marks = {r["run_id"]: (r["start_mark"], r["end_mark"], r["rows"]) for r in ledger.loads(spark, one.path("control", "loads")).collect()}
    assert marks["r1"] == (None, "2024-01-02", 2) and marks["r2"] == ("2024-01-02", "2024-01-03", 1)


def test_a_replay_never_loses_rows_of_its_load(spark, tmp_path):
    """The source of an older run is gone: the stored load stays."""
    drop(tmp_path / "landing", "billing", [bill(1, "2024-01-01"), bill(2, "2024-01-02")])
    run(spark, tmp_path, "r1").bronze("billing")
    drop(tmp_path / "landing", "billing", [bill(3, "2024-01-03")])
    run(spark, tmp_path, "r2").bronze("billing")
    again = run(spark, tmp_path, "r1")
    with pytest.raises(ledger.ReplayError, match="2 rows"):
        again.bronze("billing")
    assert bills_of(again) == ["B1", "B2", "B3"]


def test_a_load_that_was_lost_half_way_starts_where_it_began(spark, tmp_path, monkeypatch):
    drop(tmp_path / "landing", "billing", [bill(1, "2024-01-01")])
    run(spark, tmp_path, "r1").bronze("billing")
    drop(tmp_path / "landing", "billing", [bill(1, "2024-01-01"), bill(2, "2024-01-02")])
    broken = run(spark, tmp_path, "r2")
    monkeypatch.setattr(ledger, "finish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        broken.bronze("billing")
    monkeypatch.undo()
    drop(tmp_path / "landing", "billing", [bill(n, f"2024-01-0{n}") for n in (1, 2, 3)])
    run(spark, tmp_path, "r3").bronze("billing")
    again = run(spark, tmp_path, "r2")
    again.bronze("billing")
    # Without an end the replay reads all above its start; silver counts a bill of two loads once.
    assert bills_of(again, "r2") == ["B2", "B3"] and bills_of(again, "r1") == ["B1"]
    again.silver("billing")
    assert again.read("silver", "billing").count() == 3


def test_data_without_a_record_is_not_overwritten(spark, tmp_path):
    drop(tmp_path / "landing", "billing", [bill(1, "2024-01-01")])
    one = run(spark, tmp_path, "r1")
    spark.range(3).write.parquet(one.path("bronze", "billing/load=r1"))
    with pytest.raises(ledger.ReplayError, match="does not know"):
        one.bronze("billing")
    assert spark.read.parquet(one.path("bronze", "billing/load=r1")).count() == 3


def test_rows_without_a_mark_are_loaded_once(spark, tmp_path):
    lines = [bill(1, "2024-01-01"), bill(2, "unknown"), bill(3, "")]
    drop(tmp_path / "landing", "billing", lines)
    run(spark, tmp_path, "r1").bronze("billing")
    drop(tmp_path / "landing", "billing", [*lines, bill(4, "2024-01-04"), bill(5, "unknown")])
    second = run(spark, tmp_path, "r2")
    second.bronze("billing")
    assert bills_of(second, "r2") == ["B4", "B5"]
    second.bronze("billing")
    assert bills_of(second, "r2") == ["B4", "B5"] and bills_of(second, "r1") == ["B1", "B2", "B3"]


def test_first_version_on_request(spark, landing):
    parity = run(spark, landing, "r1", keep="first", load_type="full")
    parity.bronze("billing")
    parity.silver("billing")
    (b1,) = parity.read("silver", "billing").filter("bill_id = 'B1'").collect()
    assert b1["payment_status"] == "Partial" and float(b1["outstanding_amount"]) == 1000.0


def test_stage_counts_follow_the_kept_version(spark, landing):
    first_version = PATIENTS[0].replace("1980-05-01", "unknown").replace("2022-01-01", "2021-01-01")
    drop(landing / "landing", "patients", [*PATIENTS, first_version])
    for keep, valid in (("last", 2), ("first", 1)):
        chosen = run(spark, landing, f"r-{keep}", keep=keep, load_type="full")
        chosen.root = str(landing / keep)
        chosen.bronze("patients")
        counts = {r["stage"]: (r["before"], r["after"]) for r in chosen.silver("patients").collect()}
        assert counts == {"dedup_patient_id": (5, 4), "valid_dob": (5, valid)}
        assert chosen.read("silver", "patients").count() == valid


def test_snapshots_and_rejects_of_two_full_loads_count_once(spark, landing):
    for run_id in ("r1", "r2"):
        full = run(spark, landing, run_id, load_type="full")
        for name in ("bed_occupancy", "admissions"):
            full.bronze(name)
            full.silver(name)
    assert full.read("bronze", "bed_occupancy").count() == 8
    assert sorted(r["occupancy_id"] for r in full.read("silver", "bed_occupancy").collect()) == ["O1", "O2", "O4"]
    assert [r["admission_id"] for r in full.read("quarantine", "admissions").collect()] == ["A3"]


def test_selective_rebuild(spark, landing):
    first = run(spark, landing, "r1")
    first.all(rebuild_aggs=False)
    gold = landing / "lake" / "gold"
    assert (gold / "fact_billing").exists() and not (gold / "agg_dept_kpis").exists()
    before = (gold / "dim_date" / "_SUCCESS").stat().st_mtime_ns
    first.gold(rebuild_dims=False, rebuild_facts=False, rebuild_aggs=True)
    assert (gold / "agg_dept_kpis").exists()
    assert (gold / "dim_date" / "_SUCCESS").stat().st_mtime_ns == before


def test_missing_file_fails_and_is_logged(spark, landing):
    other = run(spark, landing, "r9")
    other.landing = str(landing / "landing2")
    drop(landing / "landing2", "patients", PATIENTS)
    with pytest.raises(FileNotFoundError, match="billing_raw.csv"):
        other.all()
    failures = control.read_failures(spark, other.path("control", "failures")).collect()
    assert [(r["stage"], r["run_id"]) for r in failures] == [("check_files", "r9")]
    assert control.read_runs(spark, other.path("control", "runs")).first()["status"] == "FAILED"


def test_nothing_rejected_writes_no_quarantine(spark, landing):
    drop(landing / "landing", "admissions", ADMISSIONS[:2])
    clean = run(spark, landing, "r1", load_type="full")
    clean.bronze("admissions")
    clean.silver("admissions")
    assert not (landing / "lake" / "quarantine").exists()


def test_missing_column_warns_and_goes_on(spark, landing):
    text = (landing / "landing" / "patients_raw.csv").read_text().replace("blood_group", "blood")
    (landing / "landing" / "patients_raw.csv").write_text(text)
    warned = run(spark, landing, "r1", load_type="full")
    report = warned.bronze("patients").first()
    assert (report["status"], report["missing_columns"], report["extra_columns"]) == ("WARN", ["blood_group"], ["blood"])
    warned.silver("patients")
    assert warned.read("silver", "patients").filter("blood_group is null").count() == 2


def test_valid_quarantined_and_dropped_add_up(spark):
    data = [
        (f"A{i % 50}", f"2024-01-{i % 28 + 1:02d}", None if i % 7 == 0 else f"2024-01-{(i * 5) % 28 + 1:02d}", str(i))
        for i in range(120)
    ]
    df = spark.createDataFrame(data, "admission_id string, admission_date string, discharge_date string, updated_at string")
    for c in TABLES["admissions"].columns:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast(TABLES["admissions"].type_of(c)))
    valid, rejected = silver.admissions(df, D(2024, 6, 30))
    assert valid.count() + rejected.count() + (120 - 50) == 120


# ---- file stream ----------------------------------------------------------------------------


def stream(spark, base, **options):
    query = ingest_available(
        spark, str(base / "in"), str(base / "bronze"), str(base / "checkpoint"), TABLES["admissions"], STAMP, **options
    )
    query.awaitTermination(120)
    return query


def test_each_file_is_read_once(spark, tmp_path):
    drop(tmp_path / "in", "admissions", ADMISSIONS[:2], "one.csv")
    stream(spark, tmp_path)
    drop(tmp_path / "in", "admissions", ADMISSIONS[2:], "two.csv")
    stream(spark, tmp_path)
    stream(spark, tmp_path)
    stored = spark.read.parquet(str(tmp_path / "bronze"))
    assert sorted(r["admission_id"] for r in stored.collect()) == ["A1", "A2", "A3", "A4"]
    assert {r["_source_file"] for r in stored.collect()} == {"one.csv", "two.csv"}
    hashes = stored.filter("admission_id = 'A1'").first()["_record_hash"]
    assert len(hashes) == 64


def test_repeats_within_the_delay_are_dropped(spark, tmp_path):
    drop(tmp_path / "in", "admissions", ADMISSIONS[:2], "one.csv")
    stream(spark, tmp_path, repeats_within="2 days")
    drop(tmp_path / "in", "admissions", ADMISSIONS[1:3], "two.csv")
    stream(spark, tmp_path, repeats_within="2 days")
    stored = spark.read.parquet(str(tmp_path / "bronze"))
    assert sorted(r["admission_id"] for r in stored.collect()) == ["A1", "A2", "A3"]


def test_late_rows_and_new_versions_are_no_repeats(spark, tmp_path):
    drop(tmp_path / "in", "admissions", ADMISSIONS[2:], "march.csv")
    stream(spark, tmp_path, repeats_within="1 day")
    changed = ADMISSIONS[2].replace("2024-03-01,", "2024-03-09,")
    drop(tmp_path / "in", "admissions", [*ADMISSIONS[:2], changed], "january.csv")
    stream(spark, tmp_path, repeats_within="1 day")
    stored = spark.read.parquet(str(tmp_path / "bronze"))
    assert sorted(r["admission_id"] for r in stored.collect()) == ["A1", "A2", "A3", "A3", "A4"]
