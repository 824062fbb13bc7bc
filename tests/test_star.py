"""All measures against a brute-force evaluation of their definitions on a small star."""

import calendar as cal
import datetime as dt
import random
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from oreline.plans import gold, reports
from oreline.plans.measures import MEASURES, PEOPLE, pick
from oreline.plans.security import secure
from oreline.plans.star import Measure, Star

D = dt.date
START, END = D(2023, 1, 1), D(2025, 12, 31)
CALENDAR = [START + dt.timedelta(n) for n in range((END - START).days + 1)]
DEPARTMENTS = {1: "Cardiology", 2: "Emergency", 3: "Icu", 4: "Urology"}  # Urology stays without admissions
DOCTORS = {1: "Dr. A", 2: "Dr. B"}


def key(day):
    return None if day is None else day.year * 10000 + day.month * 100 + day.day


def make_rows():
    rnd = random.Random(11)
    patients = [
        {"patient_key": f"P{i}", "gender": rnd.choice(["Male", "Female", "Other"]), "age": rnd.choice([None, rnd.randrange(90)]), "city": f"C{i % 3}"}
        for i in range(30)
    ]
    admissions = []
    for i in range(400):
        day = START + dt.timedelta(rnd.randrange(790))
        if D(2023, 7, 1) <= day <= D(2023, 8, 31):  # two empty months
            day = D(2024, 2, 29)
        department = rnd.choice([1, 1, 2, 3, None])
        admissions.append(
            {
                "admission_id": f"A{i}",
                "patient_id": "P0" if i % 3 == 0 else rnd.choice([f"P{rnd.randrange(35)}", None]),
                "department_key": department,
                "doctor_key": rnd.choice([1, 2]),
                "day": None if i % 50 == 7 else day,
                "discharge_date_key": None if rnd.random() < 0.2 else 20240101,
                "admission_type": rnd.choice(["Emergency", "Planned", "Referral"]),
                "length_of_stay": rnd.choice([None, rnd.randrange(40)]),
                "readmission_flag": 0 if department == 2 else rnd.choice([0, 1]),
                "high_risk_flag": rnd.choice([0, 1]),
                "mortality_flag": rnd.choice([0, 0, 1]),
            }
        )
    bills = []
    for i in range(700):
        total = Decimal(rnd.randrange(100, 10_000_000)) / 100
        insured = (total / 3).quantize(Decimal("0.01"))
        bills.append(
            {
                "bill_id": f"B{i}",
                "admission_id": "A1" if i % 3 == 0 else f"A{rnd.randrange(420)}",
                "patient_id": f"P{rnd.randrange(35)}",
                "total_amount": None if i % 90 == 5 else total,
                "insurance_amount": insured,
                "patient_payable": total - insured,
                "outstanding_amount": rnd.choice([Decimal(0), total - insured]),
                "insurance_type": rnd.choice(["X", "Y", None]),
                "payment_status": rnd.choice(["Paid", "Pending", "Partial", "Waived"]),
            }
        )
    beds = []
    for n in range(0, 700, 3):
        for department in (1, 2, 3):
            if department == 3 and n > 600:
                continue
            rate = rnd.choice([40.25, 80.0, 94.99, 95.0, 99.5, None])
            beds.append(
                {
                    "occupancy_id": f"O{n}-{department}", "department_key": department, "day": START + dt.timedelta(n),
                    "total_beds": 10, "occupied_beds": rnd.randrange(10), "available_beds": rnd.randrange(10),
                    "occupancy_rate": rate,
                }
            )
    return patients, admissions, bills, beds


PATIENTS, ADMISSIONS, BILLS, BEDS = make_rows()


def frame(spark, rows, schema, rename=None):
    names = [part.split()[0] for part in schema.split(", ")]
    rename = rename or {}
    return spark.createDataFrame(
        [tuple(key(r["day"]) if n == rename.get("day") else r[n] for n in names) for r in rows], schema
    )


def make_star(spark, last_date="data"):
    info = gold.department_info(spark)
    departments = spark.createDataFrame(list(DEPARTMENTS.items()), "department_key int, department_name string")
    return Star(
        {
            "dim_date": gold.dim_date(gold.fixed_span(spark, START, END)),
            "dim_patient": frame(spark, PATIENTS, "patient_key string, gender string, age int, city string"),
            "dim_department": departments.join(info, "department_name", "left"),
            "dim_doctor": spark.createDataFrame(list(DOCTORS.items()), "doctor_key int, doctor_name string"),
            "fact_admissions": frame(
                spark, ADMISSIONS,
                "admission_id string, patient_id string, department_key int, doctor_key int, admission_date_key int, "
                "discharge_date_key int, admission_type string, length_of_stay int, readmission_flag int, "
                "high_risk_flag int, mortality_flag int",
                {"day": "admission_date_key"},
            ).withColumn("admission_year", (F.col("admission_date_key") / 10000).cast("int")),
            "fact_billing": frame(
                spark, BILLS,
                "bill_id string, admission_id string, patient_id string, total_amount decimal(18,2), "
                "insurance_amount decimal(18,2), patient_payable decimal(18,2), outstanding_amount decimal(18,3), "
                "insurance_type string, payment_status string",
            ),
            "fact_bed_occupancy": frame(
                spark, BEDS,
                "occupancy_id string, department_key int, snapshot_date_key int, total_beds int, occupied_beds int, "
                "available_beds int, occupancy_rate double",
                {"day": "snapshot_date_key"},
            ).withColumn("snapshot_year", (F.col("snapshot_date_key") / 10000).cast("int")),
        },
        last_date,
    )


@pytest.fixture(scope="module")
def star(spark):
    made = make_star(spark)
    made.tables = {name: table.cache() for name, table in made.tables.items()}
    return made


# ---- brute force ----------------------------------------------------------------------------

_PATIENT = {p["patient_key"]: p for p in PATIENTS}


def _date_attributes(day):
    if day is None:
        return dict.fromkeys(["year_month", "year", "quarter_label", "full_date", "month"])
    return {
        "year_month": f"{day:%Y-%m}", "year": day.year, "quarter_label": f"Q{(day.month + 2) // 3}",
        "full_date": day, "month": day.month,
    }


ATTRIBUTES = {day: _date_attributes(day) for day in CALENDAR}


def _patient_attributes(pid):
    p = _PATIENT.get(pid, {})
    return {"gender": p.get("gender"), "city": p.get("city")}


def _wide():
    adm = {}
    for a in ADMISSIONS:
        adm[a["admission_id"]] = {
            **a, **_date_attributes(a["day"]), **_patient_attributes(a["patient_id"]),
            "department_name": DEPARTMENTS.get(a["department_key"]), "doctor_name": DOCTORS[a["doctor_key"]],
        }
    nothing = dict.fromkeys(next(iter(adm.values())))
    bills = []
    for b in BILLS:
        a = adm.get(b["admission_id"], nothing)
        bills.append({**{k: a[k] for k in nothing}, **_patient_attributes(b["patient_id"]), **b})
    beds = [{**o, **_date_attributes(o["day"]), "department_name": DEPARTMENTS.get(o["department_key"])} for o in BEDS]
    return list(adm.values()), bills, beds


ADM, BILL, BED = _wide()
DATE_COLUMNS = {"year_month", "year", "quarter_label", "full_date", "month"}
REACH = {
    "A": DATE_COLUMNS | {"department_name", "doctor_name", "gender", "city", "admission_type", "readmission_flag"},
    "B": DATE_COLUMNS | {"department_name", "doctor_name", "gender", "city", "admission_type", "readmission_flag", "insurance_type", "payment_status"},
    "O": DATE_COLUMNS | {"department_name"},
    "P": {"gender", "city"},
}
ROWS = {"A": ADM, "B": BILL, "O": BED, "P": PATIENTS}


def month_end(day):
    return D(day.year, day.month, cal.monthrange(day.year, day.month)[1])


def add_months(day, n):
    month = day.year * 12 + day.month - 1 + n
    year, month = divmod(month, 12)
    return D(year, month + 1, min(day.day, cal.monthrange(year, month + 1)[1]))


def span(first, last):
    return {first + dt.timedelta(n) for n in range((last - first).days + 1)} if first <= last else set()


class Context:
    def __init__(self, filters, last_date="data"):
        self.filters, self.last_date, self._dates = filters, last_date, None

    def rows(self, fact, drop=(), extra=None, dates=None):
        tests = {c: v for c, v in self.filters.items() if c in REACH[fact] and c not in drop}
        if dates is not None:
            tests = {c: v for c, v in tests.items() if c not in DATE_COLUMNS}
        out = [r for r in ROWS[fact] if all(r[c] == v for c, v in tests.items())]
        if dates is not None:
            out = [r for r in out if r["day"] in dates]
        return [r for r in out if extra is None or extra(r)]

    def dates(self):
        if self._dates is None:
            tests = {c: v for c, v in self.filters.items() if c in DATE_COLUMNS}
            self._dates = [d for d in CALENDAR if all(ATTRIBUTES[d][c] == v for c, v in tests.items())]
        return self._dates

    def last(self, fact):
        days = self.dates()
        if self.last_date == "data":
            held = {r["day"] for r in ROWS["O" if fact == "O" else "A"]}
            days = [d for d in days if d in held]
        return max(days, default=None)

    def prior_year(self):
        days = set(self.dates())
        out = set()
        for d in days:
            first = d.replace(day=1)
            if span(first, month_end(d)) <= days:
                target = add_months(first, -12)
                out |= span(target, month_end(target))
            else:
                out.add(add_months(d, -12))
        return out

    def to_date(self, months):
        hi = max(self.dates(), default=None)
        if hi is None:
            return set()
        return span(D(hi.year, (hi.month - 1) // months * months + 1, 1), hi)

    def previous_month(self):
        lo = min(self.dates(), default=None)
        if lo is None:
            return set()
        before = lo.replace(day=1) - dt.timedelta(1)
        return span(before.replace(day=1), before)

    def rolling(self, fact, n):
        hi = self.last(fact)
        if hi is None:
            return set()
        back = add_months(hi, -n)
        if hi == month_end(hi):
            back = month_end(back)
        return span(back + dt.timedelta(1), hi)


def size(rows):
    return len(rows) or None


def total(rows, column):
    values = [r[column] for r in rows if r[column] is not None]
    return float(sum(values)) if values else None


def mean(rows, column):
    values = [r[column] for r in rows if r[column] is not None]
    return float(sum(values)) / len(values) if values else None


def distinct(rows, column):
    return len({r[column] for r in rows}) or None


def pct(a, b):
    return None if a is None or not b else a / b * 100


def minus(a, b):
    return None if a is None and b is None else (a or 0) - (b or 0)


def growth(now, before):
    return pct(minus(now, before), before)


def color(value, red, orange):
    return "#D32F2F" if red(value or 0) else "#F57C00" if orange(value or 0) else "#388E3C"


def brute(name, c):
    return definitions_in(c)[name]()


def definitions_in(c):
    n = size(c.rows("A"))
    readmitted = size(c.rows("A", {"readmission_flag"}, lambda r: r["readmission_flag"] == 1))
    revenue, owed = total(c.rows("B"), "total_amount"), total(c.rows("B"), "outstanding_amount")
    last = c.last("O")
    at_end = c.rows("O", dates={last})
    los, occ = mean(c.rows("A"), "length_of_stay"), mean(c.rows("O"), "occupancy_rate")
    collected = pct(minus(revenue, owed), revenue)
    people = distinct(c.rows("A"), "patient_id")

    def rank():
        if "department_name" not in c.filters:
            return 1
        values = {
            size(Context({**c.filters, "department_name": d}).rows("A")) or 0 for d in [*DEPARTMENTS.values(), None]
        }
        return 1 + sum(v > (n or 0) for v in values)

    def daily_mean():
        days = {}
        for r in c.rows("A", dates=c.rolling("A", 3)):
            days.setdefault(r["day"], []).append(r)
        means = [m for m in (mean(rows, "length_of_stay") for rows in days.values()) if m is not None]
        return sum(means) / len(means) if means else None

    return {
        "total_admissions": lambda: n,
        "ytd_admissions": lambda: size(c.rows("A", dates=c.to_date(12))),
        "py_admissions": lambda: size(c.rows("A", dates=c.prior_year())),
        "admission_growth_yoy_pct": lambda: growth(n, size(c.rows("A", dates=c.prior_year()))),
        "active_admissions": lambda: size(c.rows("A", extra=lambda r: r["discharge_date_key"] is None)),
        "emergency_rate_pct": lambda: pct(size(c.rows("A", {"admission_type"}, lambda r: r["admission_type"] == "Emergency")), n),
        "avg_length_of_stay": lambda: los,
        "los_vs_target": lambda: (los or 0) - 5,
        "los_rolling_3m": daily_mean,
        "readmission_count": lambda: readmitted,
        "readmission_rate_pct": lambda: pct(readmitted, n),
        "readmission_vs_benchmark": lambda: (pct(readmitted, n) or 0) - 15,
        "mortality_count": lambda: size(c.rows("A", extra=lambda r: r["mortality_flag"] == 1)),
        "mortality_rate_pct": lambda: pct(size(c.rows("A", extra=lambda r: r["mortality_flag"] == 1)), n),
        "high_risk_patients": lambda: size(c.rows("A", extra=lambda r: r["high_risk_flag"] == 1)),
        "avg_occupancy_rate_pct": lambda: occ,
        "current_occupancy_pct": lambda: mean(at_end, "occupancy_rate"),
        "total_beds": lambda: total(at_end, "total_beds"),
        "occupied_beds": lambda: total(at_end, "occupied_beds"),
        "available_beds": lambda: total(at_end, "available_beds"),
        "departments_at_critical_capacity": lambda: distinct(
            c.rows("O", extra=lambda r: (r["occupancy_rate"] or 0) >= 95), "department_key"
        ),
        "total_revenue": lambda: revenue,
        "ytd_revenue": lambda: total(c.rows("B", dates=c.to_date(12)), "total_amount"),
        "py_revenue": lambda: total(c.rows("B", dates=c.prior_year()), "total_amount"),
        "revenue_growth_yoy_pct": lambda: growth(revenue, total(c.rows("B", dates=c.prior_year()), "total_amount")),
        "insurance_revenue": lambda: total(c.rows("B"), "insurance_amount"),
        "patient_revenue": lambda: total(c.rows("B"), "patient_payable"),
        "outstanding_revenue": lambda: owed,
        "collection_rate_pct": lambda: collected,
        "revenue_per_admission": lambda: None if revenue is None or n is None else revenue / n,
        "avg_bill_amount": lambda: mean(c.rows("B"), "total_amount"),
        "insurance_coverage_pct": lambda: pct(total(c.rows("B"), "insurance_amount"), revenue),
        "pending_bills": lambda: size(c.rows("B", {"payment_status"}, lambda r: r["payment_status"] in ("Pending", "Partial"))),
        "mom_revenue_change_pct": lambda: growth(revenue, total(c.rows("B", dates=c.previous_month()), "total_amount")),
        "qtd_admissions": lambda: size(c.rows("A", dates=c.to_date(3))),
        "revenue_rolling_12m": lambda: total(c.rows("B", dates=c.rolling("B", 12)), "total_amount"),
        "dept_rank_by_admissions": rank,
        "is_top_3_department": lambda: "Top 3" if rank() <= 3 else "Others",
        "readmission_kpi_color": lambda: color(pct(readmitted, n), lambda x: x >= 20, lambda x: x >= 15),
        "occupancy_kpi_color": lambda: color(occ, lambda x: x >= 95, lambda x: x >= 80),
        "collection_kpi_color": lambda: color(collected, lambda x: x < 70, lambda x: x < 85),
        "total_unique_patients": lambda: people,
        "ytd_unique_patients": lambda: distinct(c.rows("A", dates=c.to_date(12)), "patient_id"),
        "unique_patients_rolling_12m": lambda: distinct(c.rows("A", dates=c.rolling("A", 12)), "patient_id"),
        "avg_patient_age": lambda: mean(c.rows("P"), "age"),
        "female_patient_pct": lambda: pct(
            distinct(c.rows("A", {"gender"}, lambda r: r["gender"] == "Female"), "patient_id"), people
        ),
    }


MEMBERS = {
    "year_month": sorted({f"{d:%Y-%m}" for d in CALENDAR}),
    "year": [2023, 2024, 2025],
    "quarter_label": ["Q1", "Q2", "Q3", "Q4"],
    "full_date": [D(2023, 3, 1), D(2024, 2, 28), D(2024, 2, 29), D(2024, 3, 31), D(2025, 2, 28), D(2025, 12, 31)],
    "department_name": list(DEPARTMENTS.values()),
    "gender": ["Male", "Female", "Other"],
    "insurance_type": ["X", "Y", None],
    "admission_type": ["Emergency", "Planned", "Referral"],
    "payment_status": ["Paid", "Pending", "Partial", "Waived"],
}
TABLE_OF = {
    "department_name": "dim_department", "gender": "dim_patient", "insurance_type": "fact_billing",
    "admission_type": "fact_admissions", "payment_status": "fact_billing",
}


def close(a, b):
    if isinstance(a, (int, float)) and isinstance(b, (int, float)):
        return a == pytest.approx(b, rel=1e-9, abs=1e-9)
    return a == b


def check(star, names, by, combos, base=None, last_date="data", where=None, exact_rows=True):
    base = base or {}
    qualified = [f"{TABLE_OF.get(c, 'dim_date')}.{c}" for c in by]
    result = star.query(pick(*names), qualified, where)
    got = {tuple(r[c] for c in by): r for r in result.collect()}
    shown = 0
    for combo in combos:
        definitions = definitions_in(Context({**base, **dict(zip(by, combo))}, last_date))
        expected = {name: definitions[name]() for name in names}
        row = got.get(combo)
        if row is None:
            assert all(v is None for v in expected.values()), (combo, expected)
            continue
        shown += 1
        for name, value in expected.items():
            assert close(row[name], value), (combo, name, row[name], value)
    if exact_rows:
        extra = set(got) - set(combos)
        assert all(None in combo for combo in extra), extra  # only members for unmatched keys
    return got


# Other columns get all measures; quarters over several years are no contiguous dates.
FEWER = {
    "year": ["py_admissions", "ytd_revenue", "los_rolling_3m", "revenue_rolling_12m", "occupied_beds", "occupancy_kpi_color"],
    "quarter_label": ["total_admissions", "py_revenue", "qtd_admissions", "current_occupancy_pct", "los_vs_target"],
    "insurance_type": [
        "total_revenue", "revenue_per_admission", "collection_kpi_color", "pending_bills", "py_revenue", "total_admissions",
        "avg_patient_age", "dept_rank_by_admissions", "total_beds",
    ],
    "admission_type": [
        "emergency_rate_pct", "total_admissions", "total_revenue", "ytd_revenue", "avg_occupancy_rate_pct", "female_patient_pct",
    ],
    "payment_status": ["pending_bills", "total_revenue", "total_unique_patients"],
}


@pytest.mark.parametrize("column", ["year_month", "year", "quarter_label", "department_name", "gender", "insurance_type", "admission_type", "payment_status"])
def test_all_measures_by_one_column(star, column):
    names = FEWER.get(column, list(MEASURES))
    combos = [(m,) for m in MEMBERS[column]]
    check(star, names, [column], combos)


def test_all_measures_in_total(star):
    check(star, list(MEASURES), [], [()])


LAST = ["current_occupancy_pct", "total_beds", "occupied_beds", "available_beds", "los_rolling_3m", "revenue_rolling_12m"]


def test_all_measures_with_the_strict_calendar(spark, star):
    strict = Star(star.tables, "calendar")
    check(strict, list(MEASURES), [], [()], last_date="calendar")
    check(strict, LAST, ["year_month"], [(m,) for m in MEMBERS["year_month"]], last_date="calendar")
    row = strict.query(pick("current_occupancy_pct", "total_beds", "total_admissions")).first()
    assert row["current_occupancy_pct"] is None and row["total_beds"] is None and row["total_admissions"] == 400


TIME = [
    "ytd_admissions", "py_admissions", "admission_growth_yoy_pct", "qtd_admissions", "los_rolling_3m", "ytd_revenue",
    "py_revenue", "mom_revenue_change_pct", "revenue_rolling_12m", "total_beds", "current_occupancy_pct",
]


def test_calendar_functions_by_day(star):
    combos = [(d,) for d in MEMBERS["full_date"]]
    check(star, TIME, ["full_date"], combos, exact_rows=False)


def test_two_tables_show_the_groups_that_occur(star):
    names = ["total_admissions", "emergency_rate_pct", "ytd_admissions", "py_revenue", "revenue_rolling_12m", "los_rolling_3m", "total_revenue"]
    combos = [(m, d) for m in MEMBERS["year_month"] for d in MEMBERS["department_name"]]
    check(star, names, ["year_month", "department_name"], combos)


def test_filters_limit_the_context_and_are_replaced(star):
    base = {"admission_type": "Planned", "year": 2024}
    where = {"fact_admissions.admission_type": "Planned", "dim_date.year": 2024}
    names = ["total_admissions", "emergency_rate_pct", "total_revenue", "ytd_admissions", "py_admissions", "female_patient_pct", "avg_patient_age"]
    check(star, names, [], [()], base, where=where)
    check(star, names, ["department_name"], [(d,) for d in DEPARTMENTS.values()], base, where=where)


def test_rank_is_over_all_departments_also_under_a_filter(star):
    where = {"dim_department.department_name": ["Icu", "Urology"]}
    got = star.query(pick("dept_rank_by_admissions"), ["dim_department.department_name"], where).collect()
    expected = {d: brute("dept_rank_by_admissions", Context({"department_name": d})) for d in ("Icu", "Urology")}
    assert {r[0]: r[1] for r in got} == expected


def test_filter_by_function_and_null(star):
    where = {"dim_date.full_date": lambda day: day >= F.lit(D(2024, 6, 1)), "fact_admissions.discharge_date_key": None}
    got = star.query(pick("total_admissions", "active_admissions"), where=where).first()
    open_since = [r for r in ADM if r["day"] and r["day"] >= D(2024, 6, 1) and r["discharge_date_key"] is None]
    assert tuple(got) == (len(open_since), len(open_since))


def test_keep_empty_shows_every_member(star):
    rows = star.query(pick("total_revenue"), ["dim_department.department_name"], keep_empty=True).collect()
    assert {r[0] for r in rows} >= set(DEPARTMENTS.values())


def test_invariants(star):
    by_department = star.query(pick("total_admissions", "total_beds"), ["dim_department.department_name"]).collect()
    total = star.query(pick("total_admissions", "total_beds")).first()
    assert sum(r["total_admissions"] or 0 for r in by_department) == total["total_admissions"]
    assert sum(r["total_beds"] or 0 for r in by_department) == total["total_beds"]
    months = {r[0]: r for r in star.query(pick("ytd_admissions"), ["dim_date.year_month"]).collect()}
    years = {r[0]: r for r in star.query(pick("total_admissions"), ["dim_date.year"]).collect()}
    for year in (2023, 2024):
        assert months[f"{year}-12"]["ytd_admissions"] == years[year]["total_admissions"]


def test_rollup_recomputes_each_level(star):
    rows = star.rollup(pick("total_unique_patients"), ["dim_date.year", "dim_department.department_name"]).collect()
    totals = [r for r in rows if r["level"] == 0]
    assert len(totals) == 1 and totals[0]["total_unique_patients"] == len({a["patient_id"] for a in ADMISSIONS})
    by_year = {r["year"]: r["total_unique_patients"] for r in rows if r["level"] == 1}
    assert by_year[2024] == len({a["patient_id"] for a in ADM if a["year"] == 2024})


@pytest.mark.parametrize("by", [["dim_date.year", "dim_department.department_name"], ["fact_admissions.admission_type"], ["dim_patient.gender", "dim_doctor.doctor_name"]])
@pytest.mark.parametrize("where", [{}, {"dim_date.year": 2024}, {"dim_department.department_name": "nowhere"}])
def test_rollup_in_one_pass_equals_a_query_per_level(star, monkeypatch, by, where):
    measures = pick("total_admissions", "avg_length_of_stay", "readmission_rate_pct", "total_unique_patients")
    got = star.rollup(measures, by, where)
    once = sorted(map(str, got.collect()))
    monkeypatch.setattr(Star, "_expandable", lambda *a: False)
    assert once == sorted(map(str, star.rollup(measures, by, where).select(*got.columns).collect()))


@pytest.mark.parametrize("last_date", ["data", "calendar"])
@pytest.mark.parametrize(
    ("by", "where"),
    [([], {}), (["dim_date.year_month"], {}), (["dim_date.year", "dim_department.department_name"], {}), (["dim_date.full_date"], {"dim_date.year": 2024}),
     (["dim_date.year_quarter"], {"dim_department.department_name": ["Icu", "Cardiology"]})],
)
def test_merged_patients_equal_spread_ones(star, by, where, last_date):
    """Whole months by bitmaps and other days by the fact, for every calendar function."""
    fact = star.tables["fact_admissions"]
    numbers = gold.patient_numbers(fact.select("patient_id").distinct())
    months = gold.patient_months(fact, numbers)
    plain = Star(star.tables, last_date)
    merged = plain.with_tables({"patient_numbers": numbers, "patient_months": months})
    periods = ["ytd", "qtd", "prior_year", "previous_month", "rolling_3", "rolling_12"]
    measures = {p: Measure(lambda v, p=p: v(replace(PEOPLE, period=p))) for p in periods}
    got = merged.query(measures, by, where)
    assert "bitmap_or_agg" in got._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.query(measures, by, where).collect()))


def test_names_must_be_unique(star):
    with pytest.raises(ValueError):
        star.query(pick("total_revenue"), ["dim_patient.city", "fact_billing.city"])


# ---- security -------------------------------------------------------------------------------


def figures(star):
    row = star.query(pick("total_admissions", "total_revenue", "avg_occupancy_rate_pct")).first()
    return tuple(row)


def test_department_manager_sees_one_department(star):
    context = Context({"department_name": "Icu"})
    expected = tuple(brute(n, context) for n in ("total_admissions", "total_revenue", "avg_occupancy_rate_pct"))
    assert figures(secure(star, ["DeptManager"], "Icu")) == pytest.approx(expected)
    assert figures(secure(star, ["DeptManager"], "nobody")) == (None, None, None)


def test_read_only_sees_no_bills_but_the_schema(star):
    seen = secure(star, ["ReadOnly"], "Icu")
    assert figures(seen)[0] == 400 and figures(seen)[1] is None
    assert seen.tables["fact_billing"].schema == star.tables["fact_billing"].schema


def test_roles_add_up(star):
    both = figures(secure(star, ["DeptManager", "ReadOnly"], "Icu"))
    assert both[0] == 400 and both[1] == pytest.approx(brute("total_revenue", Context({"department_name": "Icu"})))
    with pytest.raises(ValueError):
        secure(star, [], "Icu")


def test_session_user_binds_to_the_session(spark, star):
    me = spark.sql("select session_user()").first()[0]
    mine = star.with_tables(
        {"dim_department": star.tables["dim_department"].withColumn("department_name", F.lit(me))}
    )
    assert figures(secure(mine, ["DeptManager"], F.session_user()))[0] == sum(a["department_key"] is not None for a in ADMISSIONS)


# ---- reports --------------------------------------------------------------------------------


def test_heatmap_and_alerts(star):
    cells = {r["department_name"]: r for r in reports.dept_heatmap(star).collect()}
    assert cells["Icu"]["m02"] == size([r for r in ADM if r["department_name"] == "Icu" and r["month"] == 2])
    latest = {}
    for o in BED:
        if o["department_name"] not in latest or o["day"] > latest[o["department_name"]]["day"]:
            latest[o["department_name"]] = o
    expected = {d for d, o in latest.items() if (o["occupancy_rate"] or 0) >= 95}
    assert {r["department_name"] for r in reports.critical_alerts(star).collect()} == expected


def test_shares_add_up(star):
    assert sum(r["share_pct"] for r in reports.admission_type(star).collect()) == pytest.approx(100)
