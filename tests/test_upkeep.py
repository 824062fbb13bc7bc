"""Silver and gold after several loads equal a full build, and only touched years are written again."""

import datetime as dt
import random
import shutil

import pytest
from pyspark.sql import functions as F

from oreline.operators.keys import register
from oreline.plans import upkeep
from oreline.plans.measures import pick
from oreline.plans.pipeline import Run
from test_pipeline import D, STAMP, drop

SILVER = ["patients", "admissions", "billing", "bed_occupancy"]
GOLD = [
    "dim_patient", "dim_department", "dim_doctor", "fact_admissions", "fact_billing", "fact_bed_occupancy", "fact_billing_keyed",
    "agg_monthly_admissions", "agg_dept_kpis", "agg_revenue_summary",
]
STAMPS = ["_ingestion_timestamp", "_silver_processed_at"]


def admission(n, year, stamp, department="Cardiology", doctor="dr. x", leaves="2", patient=1):
    start = f"{year}-03-0{n % 9 + 1}" if year else "someday"
    end = "" if leaves is None else f"{year or 2023}-04-0{leaves}" if leaves != "before" else f"{(year or 2023) - 1}-01-01"
    return f"A{n},P{patient},{department},{doctor},Planned,{start},{end},,General,flu,Recovered,0,W01,{start},{stamp}"


def bill(n, admission_id, year, stamp, amount="100.00", status="Paid"):
    day = f"{year}-05-01" if year else "unknown"
    return f"B{n},{admission_id},P1,{day},{amount},35,25,30,10,Self-Pay,0,{amount},{status},{stamp}"


def patient(n, stamp, born="1980-05-01", gender="Female"):
    return f"P{n},A,B,{gender},{born},A+,pune,X,900,{stamp}"


def bed(n, year, stamp, department="ICU"):
    return f"O{n},{department},{year}-01-0{n % 9 + 1},10,{n % 11},0,0,{stamp}"


FIRST = {
    "patients": [patient(1, "2022-01-01"), patient(2, "2022-01-02", born="never")],
    "admissions": [
        admission(1, 2021, "2024-01-01"), admission(2, 2022, "2024-01-02"), admission(3, 2022, "2024-01-03", department="ICU", leaves=None),
        admission(4, 2023, "2024-01-04", leaves="before"), admission(5, 2020, "2024-01-05", doctor="dr. b"),
    ],
    "billing": [
        bill(1, "A1", 2021, "2024-01-01"), bill(2, "A2", 2022, "2024-01-02"), bill(3, "A4", 2023, "2024-01-03"), bill(4, "A9", 2023, "2024-01-04"),
        bill(5, "A5", 2020, "2024-01-05"), bill(6, "A3", None, "2024-01-06"),
    ],
    "bed_occupancy": [bed(1, 2021, "2024-01-01"), bed(2, 2022, "2024-01-02")],
}
# A2 moves to 2023, A4 is mended, A1 becomes invalid, A9 arrives, a late old version of A2 must not win, two bills change.
SECOND = {
    "patients": [patient(2, "2022-02-01"), patient(1, "2022-02-02", gender="unclear"), patient(3, "2022-02-03")],
    "admissions": [
        admission(2, 2023, "2024-02-01", department="Anatomy"), admission(4, 2023, "2024-02-02"), admission(1, 2021, "2024-02-03", leaves="before"),
        admission(9, 2022, "2024-02-04", doctor="dr. a"), admission(2, 2022, "2023-01-01", department="Oncology"), admission(6, None, "2024-02-05"),
    ],
    "billing": [bill(2, "A2", 2022, "2024-02-01", "250.00"), bill(3, "A3", 2023, "2024-02-02"), bill(7, "A6", 2023, "2024-02-03", status="")],
    "bed_occupancy": [bed(2, 2022, "2024-02-01", "Cardiology"), bed(3, 2023, "2024-02-02")],
}


def make(spark, base, lake, run_id, as_of=D(2024, 6, 30), **options):
    stamp = STAMP + dt.timedelta(days=int(run_id[1:]))
    return Run(spark, str(base / "landing"), str(base / lake), run_id, as_of, stamp, calendar=(D(2019, 1, 1), D(2024, 12, 31)), **options)


def land(base, *drops):
    for name in SILVER:
        drop(base / "landing", name, [line for one in drops for line in one[name]])


def content(run, layer, name, keys=True):
    df = run.read(layer, name)
    df = df.select(*sorted(c for c in df.columns if c not in STAMPS and (keys or not c.endswith(("department_key", "doctor_key")))))
    return df.columns, sorted(map(str, df.collect()))


def named(run, name):
    """A fact with names for surrogate keys."""
    df = run.read("gold", name)
    for kind in ("department", "doctor"):
        for column in (f"{kind}_key", f"fact_admissions__{kind}_key"):
            if column in df.columns:
                names = run.read("gold", f"dim_{kind}").select(F.col(f"{kind}_key").alias(column), f"{kind}_name")
                df = df.join(names, column, "left").drop(column)
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def same(one, other):
    for name in SILVER:
        assert content(one, "silver", name) == content(other, "silver", name), name
    for name in GOLD:
        if name.startswith("fact"):
            assert named(one, name) == named(other, name), name
        elif name in ("dim_department", "dim_doctor", "agg_dept_kpis"):
            assert content(one, "gold", name, False) == content(other, "gold", name, False), name
        else:
            assert content(one, "gold", name) == content(other, "gold", name), name


def files(base, lake, table):
    """Data files by year directory."""
    return {d.name: sorted(f.name for f in d.glob("*.parquet")) for d in (base / lake / table).iterdir() if d.is_dir()}


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory):
    """All rows in one build."""
    base = tmp_path_factory.mktemp("whole")
    land(base, FIRST, SECOND)
    one = make(spark, base, "lake", "r9")
    one.all()
    return one


@pytest.fixture(scope="module")
def first_lake(spark, tmp_path_factory):
    """What the first drop gives; copied for each test."""
    base = tmp_path_factory.mktemp("first")
    land(base, FIRST)
    make(spark, base, "lake", "r1").all()
    return base / "lake"


@pytest.fixture
def base(first_lake, tmp_path):
    shutil.copytree(first_lake, tmp_path / "lake")
    land(tmp_path, FIRST, SECOND)
    return tmp_path


def test_two_loads_equal_a_full_build(spark, base, whole):
    tables = ("silver/admissions", "silver/billing", "gold/fact_admissions", "gold/fact_billing", "gold/fact_billing_keyed")
    before = {t: files(base, "lake", t) for t in tables}
    second = make(spark, base, "lake", "r2")
    stages = {(r["table"], r["stage"]): r["after"] for r in second.all().collect()}
    same(second, whole)
    # Nothing of 2020 has changed.
    for table, old in before.items():
        new = files(base, "lake", table)
        (year,) = [y for y in old if y.endswith("=2020")]
        assert new[year] == old[year] and new != old, table
    assert "admission_year=2021" not in files(base, "lake", "silver/admissions")
    assert {r["admission_id"] for r in second.read("quarantine", "admissions").collect()} == {"A1"}
    ids = {r["bill_id"]: (r["fact_admissions__found"], r["fact_admissions__admission_year"]) for r in second.read("gold", "fact_billing_keyed").collect()}
    assert ids == {"B1": (False, None), "B2": (True, 2023), "B3": (True, 2022), "B4": (True, 2022), "B5": (True, 2020), "B6": (True, 2022), "B7": (True, None)}
    assert stages[("admissions", "dedup_admission_id")] == 7 and stages[("admissions", "valid_date_order")] == 6 and stages[("patients", "valid_dob")] == 2
    assert upkeep.noted(spark, second.path("control", "touched")) == {}
    # Open stays are counted to another date; nothing else of silver is written again.
    old = files(base, "lake", "silver/admissions")
    later = make(spark, base, "lake", "r4", as_of=D(2024, 7, 31))
    later.silver("admissions")
    stays = {r["admission_id"]: r["length_of_stay"] for r in later.read("silver", "admissions").collect()}
    assert stays["A3"] == (dt.date(2024, 7, 31) - dt.date(2022, 3, 4)).days
    assert {y for y, f in files(base, "lake", "silver/admissions").items() if f != old[y]} == {"admission_year=2022"}


def test_first_versions_stay(spark, tmp_path):
    """With the first version kept, a late older row wins and newer ones do not."""
    for lake, drops in (("lake", [[FIRST], [SECOND]]), ("whole", [[FIRST, SECOND]])):
        for k, one in enumerate(drops):
            land(tmp_path, *one)
            run = make(spark, tmp_path, lake, f"r{k}", keep="first", load_type="full")
            for name in ("admissions", "bed_occupancy"):
                run.bronze(name)
                run.silver(name)
    merged = make(spark, tmp_path, "lake", "r5")
    for name in ("admissions", "bed_occupancy"):
        assert content(merged, "silver", name) == content(run, "silver", name)
    assert merged.read("silver", "admissions").where("admission_id = 'A2'").first()["department"] == "Oncology"


def test_a_run_lost_in_the_exchange_is_made_good(spark, base, whole, monkeypatch):
    """A run is lost when one year of silver is exchanged, the next one before gold; the third makes both good."""
    lost = make(spark, base, "lake", "r2")
    write = upkeep.write_years

    def half(df, path, staged, column, years):
        write(df.where(F.col(column) == 2023), path, staged, column, [2023])
        raise OSError("lost")

    monkeypatch.setattr(upkeep, "write_years", half)
    with pytest.raises(OSError):
        lost.all()
    assert lost.read("silver", "admissions").where("admission_id = 'A2'").count() == 2
    monkeypatch.setattr(upkeep, "write_years", write)
    monkeypatch.setattr(Run, "gold", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        make(spark, base, "lake", "r2").all()
    monkeypatch.undo()
    following = make(spark, base, "lake", "r5")
    following.all()
    same(following, whole)
    assert upkeep.noted(spark, following.path("control", "touched")) == {}


def test_keys_of_names_never_move(spark, base):
    first = make(spark, base, "lake", "r1")
    old = {r["department_name"]: r["department_key"] for r in first.read("gold", "dim_department").collect()}
    second = make(spark, base, "lake", "r2")
    second.bronze("admissions")
    second.silver("admissions")
    # Dimensions are built, the facts are not: their keys must still mean the same names.
    second.gold(rebuild_facts=False, rebuild_aggs=False)
    new = {r["department_name"]: r["department_key"] for r in second.read("gold", "dim_department").collect()}
    assert {n: new[n] for n in old if n in new} == {n: k for n, k in old.items() if n in new} and new["Anatomy"] > max(old.values())
    doctors = {r["doctor_name"]: r["doctor_key"] for r in second.read("gold", "dim_doctor").collect()}
    assert doctors == {"Dr. B": 1, "Dr. X": 2, "Dr. A": 3}


def test_a_registry_gives_each_name_one_key(spark):
    pick_ = random.Random(3)
    known, seen = None, {}
    for _ in range(4):
        names = sorted({f"n{pick_.randint(0, 60)}" for _ in range(25)})
        df = spark.createDataFrame([(n,) for n in names] + [(None,)], "name string")
        fresh = [(r["key"], r["name"]) for r in register(df, known, "name", "key").collect()]
        assert [n for _, n in sorted(fresh)] == sorted(n for n in names if n not in seen)
        seen |= {n: k for k, n in fresh}
        known = spark.createDataFrame([(k, n) for n, k in seen.items()], "key int, name string")
    assert sorted(seen.values()) == list(range(1, len(seen) + 1))


def test_the_companion_gives_the_results_of_the_join(whole):
    """Also for bills without an admission and admissions without a date or a department."""
    measures = pick("total_revenue", "avg_bill_amount", "pending_bills", "ytd_revenue", "revenue_per_admission", "collection_rate_pct")
    groupings = [["dim_date.year_month"], ["fact_admissions.admission_type"], ["fact_billing.payment_status", "dim_department.department_name"]]
    filters = [{}, {"dim_date.year": 2023, "dim_department.department_name": ["Icu", "Cardiology"]}, {"fact_admissions.admission_type": None},
               {"fact_billing.payment_status": "Paid", "fact_admissions.admission_type": "Planned"}]
    plain = whole.star().with_tables({"fact_billing_keyed": None})
    for by in groupings:
        for where in filters:
            got, want = (sorted(map(str, star.query(measures, by, where).collect())) for star in (whole.star(), plain))
            assert got == want, (by, where)
