"""SQL for each registered query, over the same tables, written apart from the Spark code."""

from __future__ import annotations

_TITLE = (
    "array_to_string(list_transform(regexp_extract_all({0}, '[A-Za-z]+|[^A-Za-z]+'), "
    "lambda x: upper(x[1]) || lower(x[2:])), '')"
)


def _title(expression: str) -> str:
    return _TITLE.format(f"trim({expression}, ' ' || chr(9) || chr(10))")


_PATIENTS = """
raw_patients as (
  select 'PAT' || lpad(c_custkey::varchar, 7, '0') as patient_id,
         c_name as first_name,
         'Surname_' || (c_custkey % 500)::varchar as last_name,
         case c_custkey % 5 when 0 then ' male ' when 1 then 'FEMALE' when 2 then 'female'
              when 3 then 'Other' else 'unknown' end as gender,
         case when c_custkey % 37 = 0 then 'not-a-date'
              else (date '1930-01-01' + ((c_custkey * 97) % 26000)::int)::date::varchar end as date_of_birth,
         case c_custkey % 4 when 0 then 'A+' when 1 then 'B+' when 2 then 'O+' else 'AB-' end as blood_group,
         lower(n_name) as city,
         case when c_acctbal < 0 then null else ' ' || c_mktsegment end as insurance_type,
         '9000000000' as contact_number,
         '2001-01-01 00:00:00' as created_at
  from customer join nation on c_nationkey = n_nationkey)
"""

_ADMISSIONS = """
ships as (select l_orderkey, max(l_shipdate)::date as ship from lineitem group by l_orderkey),
placed as (
  select o.*, o_orderdate::date as placed_on, ship, datediff('day', o_orderdate::date, ship) as gap
  from orders o left join ships on l_orderkey = o_orderkey),
raw_admissions as (
  select 'ADM' || lpad(o_orderkey::varchar, 7, '0') as admission_id,
         'PAT' || lpad(o_custkey::varchar, 7, '0') as patient_id,
         case o_custkey % 10 when 0 then 'Cardiology' when 1 then ' orthopedics' when 2 then 'NEUROLOGY'
              when 3 then 'Emergency' when 4 then 'Pediatrics' when 5 then 'Oncology'
              when 6 then 'general medicine' when 7 then 'ICU' when 8 then 'Gynecology ' else 'Urology' end as department,
         'dr. doc-' || (o_orderkey % 12)::varchar as doctor_name,
         case o_orderstatus when 'F' then 'emergency' when 'O' then 'Planned' else 'Referral' end as admission_type,
         placed_on::varchar as admission_date,
         (placed_on + (sign(gap) * floor(abs(gap) / 50.0))::int)::date::varchar as discharge_date,
         null::int as length_of_stay,
         case when o_orderkey % 10 = 7 then 'ICU' when o_orderkey % 2 = 0 then 'General' else 'Private' end as bed_type,
         case o_orderkey % 3 when 0 then 'cancer - stage ii' when 1 then 'covid-19' else ' asthma' end as diagnosis_primary,
         case when ship is null then null when o_orderkey % 20 = 3 then 'Death' else 'Recovered' end as discharge_status,
         case when o_orderkey % 7 = 0 then 1 else 0 end as readmission_flag,
         'W' || lpad((o_orderkey % 20 + 1)::varchar, 2, '0') as ward_number,
         placed_on::varchar as created_at,
         coalesce(ship, placed_on)::varchar as updated_at,
         o_totalprice
  from placed)
"""

_BILLING = """
charged as (
  select l.*, o_custkey, l_extendedprice::decimal(18,2) as amt
  from lineitem l left join orders on o_orderkey = l_orderkey),
insured as (
  select *, round(amt * case l_returnflag when 'A' then 0.80 when 'N' then 0.00 else 0.90 end, 2)::decimal(18,2) as covered
  from charged),
raw_billing as (
  select 'BILL' || (l_orderkey * 10 + l_linenumber)::varchar as bill_id,
         'ADM' || lpad(l_orderkey::varchar, 7, '0') as admission_id,
         'PAT' || lpad(o_custkey::varchar, 7, '0') as patient_id,
         l_shipdate::date::varchar as bill_date,
         amt as total_amount,
         round(amt * 0.35, 2)::decimal(18,2) as room_charges,
         round(amt * 0.25, 2)::decimal(18,2) as medicine_charges,
         round(amt * 0.30, 2)::decimal(18,2) as procedure_charges,
         (round(amt * 0.10, 2) + case when l_partkey % 11 = 0 then 5 else 0 end)::decimal(18,2) as misc_charges,
         case l_returnflag when 'A' then 'Star Health' when 'N' then 'Self-Pay' else 'Government' end as insurance_type,
         covered as insurance_amount,
         (amt - covered)::decimal(18,2) as patient_payable,
         case when l_partkey % 50 = 0 then null when l_suppkey % 20 < 13 then 'Paid'
              when l_suppkey % 20 < 17 then 'Pending' when l_suppkey % 20 < 19 then 'Partial' else 'Waived' end as payment_status,
         l_shipdate::date::varchar as created_at
  from insured)
"""

_OCCUPANCY = """
event_days as (
  select ts::date as seen, event_type, count(*)::int as occupied_beds from events group by all),
raw_bed_occupancy as (
  select 'OCC' || seen::varchar || '-' || event_type as occupancy_id,
         case event_type when 'click' then 'Cardiology' when 'error' then 'ICU' when 'purchase' then 'Emergency'
              when 'signup' then 'Oncology' else 'Urology' end as department,
         seen::varchar as snapshot_date,
         max(occupied_beds) over (partition by event_type) as total_beds,
         occupied_beds,
         (max(occupied_beds) over (partition by event_type) - occupied_beds)::int as available_beds,
         null::double as occupancy_rate,
         seen::varchar || ' 23:00:00' as created_at
  from event_days)
"""

_BILL_ORDER = [
    "created_at", "admission_id", "patient_id", "bill_date", "total_amount", "room_charges", "medicine_charges",
    "procedure_charges", "misc_charges", "insurance_type", "insurance_amount", "patient_payable", "payment_status",
]


def _bill_rank(direction: str) -> str:
    return "row_number() over (partition by bill_id order by " + ", ".join(
        f"{c} {direction}" for c in _BILL_ORDER
    ) + ")"


_SILVER_PATIENTS = f"""
silver_patients as (
  select patient_id, first_name, last_name, g as gender, dob as date_of_birth, blood_group,
         {_title('city')} as city, coalesce(trim(insurance_type), 'Unknown') as insurance_type,
         contact_number, created_at, age,
         case when age >= 0 and age < 18 then '0-18' when age >= 18 and age < 35 then '19-35'
              when age >= 35 and age < 50 then '36-50' when age >= 50 and age < 65 then '51-65'
              when age >= 65 and age < 200 then '65+' end as age_band,
         true as _silver_valid
  from (select *, {_title('gender')} as g, try_cast(date_of_birth as date) as dob,
               trunc(datediff('day', try_cast(date_of_birth as date), date '2002-01-01') / 365.25::double)::int as age
        from raw_patients)
  where g in ('Male', 'Female', 'Other') and dob is not null)
"""

_SILVER_ADMISSIONS = f"""
unique_admissions as (
  select * from raw_admissions
  qualify row_number() over (partition by admission_id order by updated_at desc) = 1),
dated_admissions as (
  select * replace (try_cast(admission_date as date) as admission_date, try_cast(discharge_date as date) as discharge_date)
  from unique_admissions),
stays as (
  select *, datediff('day', admission_date, coalesce(discharge_date, date '2002-01-01'))::int as days
  from dated_admissions where not coalesce(discharge_date < admission_date, false)),
silver_admissions as (
  select admission_id, patient_id, {_title('department')} as department, {_title('doctor_name')} as doctor_name,
         {_title('admission_type')} as admission_type, admission_date, discharge_date, days as length_of_stay,
         bed_type, {_title('diagnosis_primary')} as diagnosis_primary,
         coalesce(discharge_status, 'Active') as discharge_status, readmission_flag, ward_number, created_at, updated_at,
         case when days is null then 'Unknown' when days <= 1 then 'Same Day' when days <= 3 then 'Short (1-3d)'
              when days <= 7 then 'Medium (4-7d)' when days <= 14 then 'Long (8-14d)' else 'Extended (15d+)' end as los_category,
         year(admission_date)::int as admission_year, month(admission_date)::int as admission_month,
         strftime(admission_date, '%b') as admission_month_name, quarter(admission_date)::int as admission_quarter,
         week(admission_date)::int as admission_week,
         (case when bed_type = 'ICU' or readmission_flag = 1 then 1 else 0 end)::int as high_risk_flag,
         (case when discharge_status = 'Death' then 1 else 0 end)::int as mortality_flag,
         true as _silver_valid
  from stays)
"""

_SILVER_BILLING = f"""
unique_bills as (select * from raw_billing qualify {_bill_rank('desc nulls last')} = 1),
"""

_BILL_BODY = """
  select b.* replace (try_cast(bill_date as date) as bill_date, coalesce(payment_status, 'Unknown') as payment_status),
         (room_charges + medicine_charges + procedure_charges + misc_charges)::decimal(18,2) as _calc_total,
         abs(total_amount - (room_charges + medicine_charges + procedure_charges + misc_charges))::decimal(18,2) as _amount_variance,
         coalesce(abs(total_amount - (room_charges + medicine_charges + procedure_charges + misc_charges)) < 1, false) as _amount_check,
         case when total_amount < 10000 then 'Low (<10K)' when total_amount < 50000 then 'Medium (10K-50K)'
              when total_amount < 100000 then 'High (50K-1L)' else 'Premium (>1L)' end as revenue_tier,
         (case when payment_status = 'Paid' then 0 when payment_status = 'Partial' then patient_payable * 0.5
               else patient_payable end)::decimal(18,3) as outstanding_amount,
         year(try_cast(bill_date as date))::int as bill_year, month(try_cast(bill_date as date))::int as bill_month,
         quarter(try_cast(bill_date as date))::int as bill_quarter
  from unique_bills b"""

_SILVER_BILLING += f"silver_billing as ({_BILL_BODY})\n"

_SILVER_OCCUPANCY = f"""
silver_bed_occupancy as (
  select occupancy_id, {_title('department')} as department, try_cast(snapshot_date as date) as snapshot_date,
         total_beds, occupied_beds, available_beds, rate as occupancy_rate, created_at,
         case when rate >= 95 then 'Critical' when rate >= 80 then 'High' when rate >= 60 then 'Moderate' else 'Low' end as occupancy_status,
         year(snapshot_date::date)::int as snapshot_year, month(snapshot_date::date)::int as snapshot_month,
         quarter(snapshot_date::date)::int as snapshot_quarter
  from (select *, round_even(occupied_beds::double / nullif(total_beds, 0)::double * 100, 2) as rate from raw_bed_occupancy)
  where try_cast(snapshot_date as date) is not null)
"""

_DIM_DATE = """
dim_date as (
  select d as full_date, strftime(d, '%Y%m%d')::int as date_key, day(d)::int as day, month(d)::int as month,
         strftime(d, '%B') as month_name, strftime(d, '%b') as month_short, quarter(d)::int as quarter,
         'Q' || quarter(d)::varchar as quarter_label, year(d)::int as year,
         year(d)::varchar || '-Q' || quarter(d)::varchar as year_quarter, strftime(d, '%Y-%m') as year_month,
         week(d)::int as week_number, isodow(d)::int as day_of_week, strftime(d, '%A') as day_name,
         (isodow(d) >= 6)::int as is_weekend, (day(d) = 1)::int as is_month_start, (d = last_day(d))::int as is_month_end
  from (select unnest(generate_series({0}, {1}, interval 1 day))::date as d))
"""
_CALENDAR = """
fact_days as (
  select admission_date as day from silver_admissions union all select snapshot_date from silver_bed_occupancy),
""" + _DIM_DATE.format(
    "(select date_trunc('year', min(day))::date from fact_days)", "(select (date_trunc('year', max(day)) + interval 1 year - interval 1 day)::date from fact_days)"
)

_DIMS = """
dim_patient as (
  select patient_id as patient_key, gender, date_of_birth, age, age_band, blood_group, city, insurance_type
  from silver_patients),
dim_department as (
  select row_number() over (order by name)::int as department_key, name as department_name,
         case name when 'Cardiology' then 'Heart & Vascular' when 'Orthopedics' then 'Bones & Joints'
              when 'Neurology' then 'Brain & Nerves' when 'Emergency' then 'Emergency Care' when 'Pediatrics' then 'Children'
              when 'Oncology' then 'Cancer Care' when 'Icu' then 'Intensive Care' when 'Gynecology' then 'Women''s Health'
              when 'Urology' then 'Urinary Tract' else 'General' end as specialty,
         case name when 'Orthopedics' then 'Surgical' when 'Emergency' then 'Emergency' when 'Icu' then 'Critical Care'
              when 'Gynecology' then 'Surgical' when 'Urology' then 'Surgical' else 'Medical' end as dept_type
  from (select distinct department as name from silver_admissions where department is not null)),
doctor_departments as (
  select doctor_name, department, count(*) as n from silver_admissions where doctor_name is not null group by all),
dim_doctor as (
  select row_number() over (order by doctor_name)::int as doctor_key, doctor_name, department as primary_department
  from (select * from doctor_departments
        qualify row_number() over (partition by doctor_name order by n desc, department) = 1))
"""

_FACTS = """
fact_admissions as (
  select admission_id, patient_id, department_key, doctor_key,
         strftime(admission_date, '%Y%m%d')::int as admission_date_key,
         strftime(discharge_date, '%Y%m%d')::int as discharge_date_key,
         admission_type, bed_type, diagnosis_primary, length_of_stay, los_category, discharge_status,
         readmission_flag, high_risk_flag, mortality_flag, ward_number, admission_year, admission_month, admission_quarter
  from silver_admissions s
  left join dim_department d on d.department_name = s.department
  left join dim_doctor p on p.doctor_name = s.doctor_name),
fact_billing as (
  select bill_id, admission_id, patient_id, total_amount, room_charges, medicine_charges, procedure_charges, misc_charges,
         insurance_type, insurance_amount, patient_payable, outstanding_amount, payment_status, revenue_tier,
         bill_year, bill_month, bill_quarter
  from silver_billing),
fact_bed_occupancy as (
  select occupancy_id, department_key, strftime(snapshot_date, '%Y%m%d')::int as snapshot_date_key,
         total_beds, occupied_beds, available_beds, occupancy_rate, occupancy_status,
         snapshot_year, snapshot_month, snapshot_quarter
  from silver_bed_occupancy s left join dim_department d on d.department_name = s.department)
"""

# Admissions, bills and snapshots with the dimension columns the measures group by.
_WIDE = """
adm as (
  select f.*, full_date, year_month, year, year_quarter, quarter_label, month, department_name, dept_type, doctor_name,
         gender, city
  from fact_admissions f
  left join dim_date on date_key = admission_date_key
  left join dim_department using (department_key)
  left join dim_doctor using (doctor_key)
  left join dim_patient on patient_key = patient_id),
bill as (
  select f.*, a.full_date, a.year_month, a.year, a.year_quarter, a.quarter_label, a.month, a.department_name,
         a.admission_type, p.city
  from fact_billing f
  left join adm a using (admission_id)
  left join dim_patient p on p.patient_key = f.patient_id),
occ as (
  select f.*, full_date, year_month, year, month, department_name
  from fact_bed_occupancy f
  left join dim_date on date_key = snapshot_date_key
  left join dim_department using (department_key))
"""

_STAR = ",".join(
    [
        _PATIENTS, _ADMISSIONS, _BILLING, _OCCUPANCY, _SILVER_PATIENTS, _SILVER_ADMISSIONS, _SILVER_BILLING,
        _SILVER_OCCUPANCY, _CALENDAR, _DIMS, _FACTS, _WIDE,
    ]
)


def _with(*parts: str) -> str:
    return "with " + ",".join(parts)


def _star(sql: str) -> str:
    return f"with {_STAR} {sql}"


_LOS = "sum(length_of_stay)::double / nullif(count(length_of_stay), 0)"
_READ = "nullif(count(*) filter (readmission_flag = 1), 0)"
_DEAD = "nullif(count(*) filter (mortality_flag = 1), 0)"
_RISK = "nullif(count(*) filter (high_risk_flag = 1), 0)"
_ADM = "nullif(count(*), 0)"
_EMERGENCY = "nullif(count(*) filter (admission_type = 'Emergency'), 0)"


def _pct(a: str, b: str) -> str:
    return f"(({a})::double / nullif({b}, 0)::double * 100)"


_ADMISSION_COLUMNS = f"""
  {_ADM} as total_admissions,
  nullif(count(*) filter (discharge_date_key is null), 0) as active_admissions,
  {_pct(_EMERGENCY, _ADM)} as emergency_rate_pct,
  {_LOS} as avg_length_of_stay,
  coalesce({_LOS}, 0) - 5 as los_vs_target,
  {_READ} as readmission_count,
  {_pct(_READ, _ADM)} as readmission_rate_pct,
  coalesce({_pct(_READ, _ADM)}, 0) - 15 as readmission_vs_benchmark,
  {_DEAD} as mortality_count,
  {_pct(_DEAD, _ADM)} as mortality_rate_pct,
  {_RISK} as high_risk_patients
"""
_EMPTY_ADMISSIONS = """
  null::bigint, null::bigint, null::double, null::double, -5::double, null::bigint, null::double, -15::double,
  null::bigint, null::double, null::bigint
"""

_REV, _OWED = "sum(total_amount)::double", "sum(outstanding_amount)::double"
_INS = "sum(insurance_amount)::double"
_COLLECTED = _pct(f"{_REV} - {_OWED}", _REV)
_REVENUE_COLUMNS = f"""
  {_REV} as total_revenue, {_INS} as insurance_revenue, sum(patient_payable)::double as patient_revenue,
  {_OWED} as outstanding_revenue, {_COLLECTED} as collection_rate_pct,
  {_REV} / nullif(count(total_amount), 0)::double as avg_bill_amount,
  {_pct(_INS, _REV)} as insurance_coverage_pct,
  nullif(count(*) filter (payment_status in ('Pending', 'Partial')), 0) as pending_bills
"""
_RATE = "sum(occupancy_rate::decimal(9,2))::double / nullif(count(occupancy_rate), 0)"


def _revenue_per_admission(by: str) -> str:
    return _star(
        f"""
        select b.*, total_revenue / nullif(n, 0)::double as revenue_per_admission
        from (select {by}, {_REVENUE_COLUMNS} from bill group by {by}) b
        left join (select {by}, count(*) as n from adm group by {by}) a on a.{by} is not distinct from b.{by}
        """
    )


def _occupancy_columns(by: str, last: str) -> str:
    """``last`` is the date on which balances are read, per row of the outer query."""
    return _star(
        f"""
        , groups as (
          select {by}, {_RATE} as avg_occupancy_rate_pct,
                 nullif(count(distinct department_key) filter (occupancy_rate >= 95), 0) as departments_at_critical_capacity
          from occ group by {by}),
        ends as ({last}),
        balance as (
          select o.{by}, {_RATE} as current_occupancy_pct, sum(total_beds)::bigint as total_beds,
                 sum(occupied_beds)::bigint as occupied_beds, sum(available_beds)::bigint as available_beds
          from occ o join ends e on o.full_date = e.last_day and (e.{by} is null or e.{by} = o.{by}) group by o.{by})
        select g.*, b.* exclude ({by}) from groups g left join balance b using ({by})
        """
    )


_BY_MONTH_BOUNDS = """
, months as (
  select year_month, min(full_date) as lo, max(full_date) as hi from dim_date group by year_month)
"""


def _periods(condition: str, value: str, table: str, name: str, groups: str = "months") -> str:
    """``name``: groups joined to the facts of the period that ``condition`` describes."""
    return f"""
    , {name} as (
      select g.year_month, {value} as v from {groups} g join {table} f on {condition} group by g.year_month)
    """


_PY_RANGE = """f.full_date between (g.lo - interval 1 year)::date and last_day((date_trunc('month', g.hi) - interval 1 year)::date)"""
_YTD_RANGE = "f.full_date between date_trunc('year', g.hi)::date and g.hi"
_PM_RANGE = "f.full_date between (date_trunc('month', g.lo) - interval 1 month)::date and (date_trunc('month', g.lo) - interval 1 day)::date"

_REVENUE = "sum(total_amount)::double"
_COUNT = "count(*)"

# Last dates of a month up to the last date that has admissions.
_DATA_MONTHS = """
, data_months as (
  select year_month, max(full_date) as hi from dim_date
  where date_key in (select admission_date_key from fact_admissions) group by year_month)
"""


def _rolling_start(hi: str, n: int) -> str:
    return f"""(case when {hi} = last_day({hi})
        then (last_day(({hi} - interval {n} month)::date) + 1)::date
        else (({hi} - interval {n} month)::date + 1)::date end)"""


_RANKED = """
, counts as (select department_name, count(*) as n from adm group by department_name)
"""


def _color(expression: str, red: str, orange: str) -> str:
    return (
        f"case when coalesce({expression}, 0) {red} then '#D32F2F' "
        f"when coalesce({expression}, 0) {orange} then '#F57C00' else '#388E3C' end"
    )


def _secured(adm: str, bill: str, occ: str, departments: str) -> str:
    return _star(
        f"""
        , a as (select department_name, count(*) as total_admissions from adm where {adm} group by all),
        b as (select department_name, sum(total_amount)::double as total_revenue from bill where {bill} group by all),
        o as (select department_name, {_RATE} as avg_occupancy_rate_pct from occ where {occ} group by all)
        select department_name, total_admissions, total_revenue, avg_occupancy_rate_pct
        from (select department_name from a union select department_name from b union select department_name from o)
        left join a using (department_name)
        left join (select * from b) b using (department_name)
        left join o using (department_name)
        where {departments}
          and (total_admissions is not null or total_revenue is not null or avg_occupancy_rate_pct is not null)
        """
    )


_MONTH_CELLS = ", ".join(f"max({{0}}) filter (month = {m}) as m{m:02d}" for m in range(1, 13))

_HASH = "sha256(concat(" + ", ".join(
    f"coalesce(length({c}::varchar) || ':' || {c}::varchar, '-1:')"
    for c in [
        "admission_id", "patient_id", "department", "doctor_name", "admission_type", "admission_date", "discharge_date",
        "length_of_stay", "bed_type", "diagnosis_primary", "discharge_status", "readmission_flag", "ward_number",
        "created_at", "updated_at",
    ]
) + "))"

_RAW_COLUMNS = {
    "patients": [
        "patient_id", "first_name", "last_name", "gender", "date_of_birth", "blood_group", "city", "insurance_type",
        "contact_number", "created_at",
    ],
    "admissions": [
        "admission_id", "patient_id", "department", "doctor_name", "admission_type", "admission_date", "discharge_date",
        "length_of_stay", "bed_type", "diagnosis_primary", "discharge_status", "readmission_flag", "ward_number",
        "created_at", "updated_at",
    ],
    "billing": [
        "bill_id", "admission_id", "patient_id", "bill_date", "total_amount", "room_charges", "medicine_charges",
        "procedure_charges", "misc_charges", "insurance_type", "insurance_amount", "patient_payable", "payment_status",
        "created_at",
    ],
    "bed_occupancy": [
        "occupancy_id", "department", "snapshot_date", "total_beds", "occupied_beds", "available_beds", "occupancy_rate",
        "created_at",
    ],
}
_RAW = _with(_PATIENTS, _ADMISSIONS, _BILLING, _OCCUPANCY)
_NULLS = " union all ".join(
    f"select '{c}' as column_name, round_even(avg(({c} is null)::int) * 100, 2) as null_pct, '{t}' as \"table\" from raw_{t}"
    for t, columns in _RAW_COLUMNS.items()
    for c in columns
)

_BILL_DOUBLES = """* replace (
  total_amount::double as total_amount, room_charges::double as room_charges, medicine_charges::double as medicine_charges,
  procedure_charges::double as procedure_charges, misc_charges::double as misc_charges,
  insurance_amount::double as insurance_amount, patient_payable::double as patient_payable{0})"""
_BILL_EXTRA = """, _calc_total::double as _calc_total, _amount_variance::double as _amount_variance,
  outstanding_amount::double as outstanding_amount"""

_MARKS = {"patients": "created_at", "admissions": "updated_at", "billing": "created_at", "bed_occupancy": "created_at"}
_KEYS = {"patients": "patient_id", "admissions": "admission_id", "billing": "bill_id", "bed_occupancy": "occupancy_id"}
# Rows up to the cut are in the first load, the others in the second, which starts at the highest mark of the first.
_TWO_LOADS = _RAW + ", drops as (" + " union all ".join(
    f"""
    select '{t}' as "table", {_MARKS[t]} as mark, {_KEYS[t]} as key, ({", ".join(f"{c}::varchar" for c in cs)})::varchar as content,
      case when {_MARKS[t]}::timestamp <= timestamp '1998-06-30 12:00:00' then 'r1' else 'r2' end as load
    from raw_{t}"""
    for t, cs in _RAW_COLUMNS.items()
) + """), sized as (
  select "table", load, count(*) as rows, count(distinct key) as keys, count(distinct content) as distinct_rows,
         min(mark) as first_mark, max(mark) as last_mark
  from drops group by all
), every as (
  select t."table", l.load, l.seq from (select distinct "table" from drops) t, (select 'r1' as load, 1::bigint as seq union all select 'r2', 2) l
)
select e."table", e.load, e.seq, case when e.load = 'r2' then a.last_mark end as start_mark,
       case when e.load = 'r1' then a.last_mark else coalesce(b.last_mark, a.last_mark) end as end_mark,
       coalesce(s.rows, 0) as ledger_rows, coalesce(s.rows, 0) as rows, coalesce(s.keys, 0) as keys,
       coalesce(s.distinct_rows, 0) as distinct_rows, s.first_mark, s.last_mark
from every e
left join sized s on s."table" = e."table" and s.load = e.load
left join sized a on a."table" = e."table" and a.load = 'r1'
left join sized b on b."table" = e."table" and b.load = 'r2'
"""
_EVIDENCE = _RAW + """, lines as (
  select 'billing' as "table", bill % 101 = 0 as corrupt, bill % 97 = 0 as bad_1, 'total_amount' as name_1, bill % 89 = 0 as bad_2, 'misc_charges' as name_2
  from (select substr(bill_id, 5)::bigint as bill from raw_billing)
  union all
  select 'bed_occupancy', false, day(snapshot_date::date) % 7 = 0, 'occupied_beds', day(snapshot_date::date) % 5 = 0, 'total_beds' from raw_bed_occupancy
  union all
  select 'patients', false, false, null, false, null from raw_patients
), sizes as (
  select "table", count(*) as row_count, count(*) filter (where corrupt) as corrupt_records, count(*) filter (where corrupt or bad_1 or bad_2) as wrong
  from lines group by "table"
), cells as (
  select "table", name_1 as column_name, count(*) as rejected from lines where bad_1 and not corrupt group by all
  union all
  select "table", name_2, count(*) from lines where bad_2 and not corrupt group by all
)
select s."table", row_count, 0::bigint as duplicate_rows, corrupt_records, case when wrong > 0 then 'WARN' else 'PASS' end as status,
       column_name, rejected
from sizes s left join cells c on c."table" = s."table"
"""

ORACLES: dict[str, str] = {
    "bronze_audit_hash": _with(_ADMISSIONS)
    + f"""
      select admission_id, 'admissions_raw.csv' as _source_file, 'bronze' as _layer, {_HASH} as _record_hash
      from raw_admissions""",
    "dq_profile": _RAW
    + " union all ".join(
        f"""
        select '{t}' as "table", count(*) as row_count, {len(c)} as column_count, '' as missing_columns,
               '' as extra_columns,
               count(*) - (select count(*) from (select distinct {", ".join(c)} from raw_{t})) as duplicate_rows,
               'PASS' as status
        from raw_{t}"""
        for t, c in _RAW_COLUMNS.items()
    ),
    "dq_null_pct": _RAW + _NULLS,
    "dq_high_null": _RAW + f"select * from ({_NULLS}) where null_pct > 5",
    "dq_duplicates": _with(_BILLING)
    + """
      select (select count(*) from raw_billing)
           - (select count(*) from (select distinct insurance_type, payment_status, bill_date from raw_billing)) as duplicate_rows
      """,
    "stage_metrics": _with(_PATIENTS, _ADMISSIONS, _BILLING, _SILVER_PATIENTS, _SILVER_ADMISSIONS)
    + """
    , n as (
      select (select count(*) from raw_patients) as p0, (select count(distinct patient_id) from raw_patients) as p1,
             (select count(*) from silver_patients) as p2,
             (select count(*) from raw_admissions) as a0, (select count(distinct admission_id) from raw_admissions) as a1,
             (select count(*) from silver_admissions) as a2,
             (select count(*) from raw_billing) as b0, (select count(distinct bill_id) from raw_billing) as b1)
    select 'patients' as "table", 'dedup_patient_id' as stage, p0 as "before", p1 as "after",
           p0 - p1 as dropped_cumulative, p0 - p1 as dropped_stage from n
    union all select 'patients', 'valid_dob', p0, p2, p0 - p2, p1 - p2 from n
    union all select 'admissions', 'dedup_admission_id', a0, a1, a0 - a1, a0 - a1 from n
    union all select 'admissions', 'valid_date_order', a0, a2, a0 - a2, a1 - a2 from n
    union all select 'billing', 'dedup_bill_id', b0, b1, b0 - b1, b0 - b1 from n""",
    "pipeline_two_loads": _TWO_LOADS,
    "scan_evidence": _EVIDENCE,
    "incremental_admissions": _with(_ADMISSIONS)
    + """
      select admission_id, admission_date, discharge_date, updated_at from raw_admissions
      where updated_at > '1999-06-30'""",
    "silver_patients": _with(_PATIENTS, _SILVER_PATIENTS) + " select * from silver_patients",
    "silver_admissions": _with(_ADMISSIONS, _SILVER_ADMISSIONS) + " select * from silver_admissions",
    "quarantine_admissions": _with(_ADMISSIONS, _SILVER_ADMISSIONS)
    + """
      select * exclude (o_totalprice), 'discharge_before_admission' as _reject_reason
      from dated_admissions where discharge_date < admission_date""",
    "silver_billing": _with(_BILLING, _SILVER_BILLING)
    + f" select {_BILL_DOUBLES.format(_BILL_EXTRA)} from silver_billing",
    "silver_billing_keep_first": _with(_BILLING)
    + f""", unique_bills as (select * from raw_billing qualify {_bill_rank('asc nulls first')} = 1),
        silver_billing as ({_BILL_BODY})
        select {_BILL_DOUBLES.format(_BILL_EXTRA)} from silver_billing""",
    "silver_bed_occupancy": _with(_OCCUPANCY, _SILVER_OCCUPANCY) + " select * from silver_bed_occupancy",
    "dim_date": _with(
        _ADMISSIONS,
        _DIM_DATE.format(
            "(select date_trunc('year', min(admission_date::date))::date from raw_admissions)",
            "(select (date_trunc('year', max(admission_date::date)) + interval 1 year - interval 1 day)::date from raw_admissions)",
        ),
    )
    + " select * from dim_date",
    "dim_patient": _star("select * from dim_patient"),
    "dim_department": _star("select * from dim_department"),
    "dim_doctor": _star("select * from dim_doctor"),
    "fact_admissions": _star("select * from fact_admissions"),
    "fact_billing": _star(
        "select " + _BILL_DOUBLES.format(", outstanding_amount::double as outstanding_amount") + " from fact_billing"
    ),
    "fact_bed_occupancy": _star("select * from fact_bed_occupancy"),
    "orphan_keys": _star(
        """
        select 'fact_admissions' as fact_table, 'dim_department' as dimension,
               count(*) as orphans from fact_admissions f
                  where not exists (from dim_department d where d.department_key = f.department_key)
        union all select 'fact_admissions', 'dim_doctor', count(*) from fact_admissions f
                  where not exists (from dim_doctor d where d.doctor_key = f.doctor_key)
        union all select 'fact_admissions', 'dim_date', count(*) from fact_admissions
                  where not exists (from dim_date where date_key = admission_date_key)
        union all select 'fact_bed_occupancy', 'dim_department', count(*) from fact_bed_occupancy f
                  where not exists (from dim_department d where d.department_key = f.department_key)
        union all select 'fact_bed_occupancy', 'dim_date', count(*) from fact_bed_occupancy
                  where not exists (from dim_date where date_key = snapshot_date_key)
        union all select 'fact_admissions', 'dim_patient', count(*) from fact_admissions
                  where not exists (from dim_patient where patient_key = patient_id)
        union all select 'fact_billing', 'dim_patient', count(*) from fact_billing
                  where not exists (from dim_patient where patient_key = patient_id)
        union all select 'fact_billing', 'fact_admissions', count(*) from fact_billing b
                  where not exists (from fact_admissions a where a.admission_id = b.admission_id)
        """
    ),
    "agg_monthly_admissions": _star(
        """
        select admission_year, admission_month, count(admission_id) as total_admissions,
               round_even(sum(length_of_stay)::double / count(length_of_stay), 1) as avg_los,
               sum(readmission_flag)::bigint as readmissions, sum(mortality_flag)::bigint as mortality_count,
               count(*) filter (admission_type = 'Emergency') as emergency_count,
               round_even(sum(readmission_flag)::double / count(*) * 100, 2) as readmission_rate,
               round_even(sum(mortality_flag)::double / count(*) * 100, 2) as mortality_rate
        from fact_admissions where admission_year is not null group by all
        """
    ),
    "agg_dept_kpis": _star(
        """
        select department_key, count(admission_id) as total_admissions,
               round_even(sum(length_of_stay)::double / count(length_of_stay), 1) as avg_los,
               sum(readmission_flag)::bigint as total_readmit, sum(mortality_flag)::bigint as total_mortality,
               sum(high_risk_flag)::bigint as high_risk_count
        from fact_admissions where department_key is not null group by all
        """
    ),
    "agg_revenue_summary": _star(
        f"""
        select bill_year, bill_month, insurance_type, {_REV} as total_revenue, {_INS} as insurance_covered,
               sum(patient_payable)::double as patient_payable, {_OWED} as outstanding, count(bill_id) as bill_count,
               round_even(({_REV} - {_OWED}) / nullif({_REV}, 0) * 100, 2) as collection_rate
        from fact_billing where bill_year is not null and insurance_type is not null group by all
        """
    ),
    "bill_derivation": _with(_PATIENTS, _ADMISSIONS)
    + """
    , bills as (
      select admission_id, a.patient_id, discharge_date as bill_date, o_totalprice::decimal(18,2) as amt,
             coalesce(trim(insurance_type), 'Self-Pay') as insurance_type
      from raw_admissions a left join raw_patients using (patient_id) where discharge_date is not null),
    shared as (
      select *, round(amt * case insurance_type when 'AUTOMOBILE' then 0.80 when 'BUILDING' then 0.75
                                 when 'MACHINERY' then 0.65 else 0.00 end, 2)::decimal(18,2) as covered from bills)
    select admission_id, patient_id, bill_date, amt::double as total_amount,
           round(amt * 0.35, 2)::double as room_charges, round(amt * 0.25, 2)::double as medicine_charges,
           round(amt * 0.30, 2)::double as procedure_charges, round(amt * 0.10, 2)::double as misc_charges,
           insurance_type, covered::double as insurance_amount, (amt - covered)::double as patient_payable
    from shared""",
    "occupancy_arithmetic": _with(_OCCUPANCY)
    + """
    select occupancy_id, total_beds, occupied_beds, (total_beds - occupied_beds)::int as available_beds,
           round_even(occupied_beds::double / nullif(total_beds, 0)::double * 100, 2) as occupancy_rate
    from raw_bed_occupancy""",
    "m_admissions_total": _star(f"select {_ADMISSION_COLUMNS} from adm"),
    "m_admissions_by_month": _star(
        f"""
        , found as (select year_month, {_ADMISSION_COLUMNS} from adm group by year_month)
        select * from found
        union all
        select year_month, {_EMPTY_ADMISSIONS} from (select distinct year_month from dim_date) m
        where not exists (from found f where f.year_month = m.year_month)
        """
    ),
    "m_clinical_by_department": _star(
        f"select department_name, {_ADMISSION_COLUMNS} from adm group by department_name"
    ),
    "m_admissions_by_doctor": _star(
        f"select doctor_name, {_ADM} as total_admissions, {_LOS} as avg_length_of_stay from adm group by doctor_name"
    ),
    "m_admissions_by_patient_city": _star(
        f"""
        , a as (select city, count(*) as total_admissions, count(distinct patient_id) as total_unique_patients from adm group by city),
        b as (select city, {_REV} as total_revenue from bill group by city)
        select coalesce(a.city, b.city) as city, total_admissions, total_unique_patients, total_revenue
        from a full join b on a.city is not distinct from b.city
        """
    ),
    "m_occupancy_by_month": _occupancy_columns(
        "year_month", "select year_month, max(full_date) as last_day from occ group by year_month"
    ),
    "m_occupancy_by_department": _occupancy_columns(
        "department_name", "select null::varchar as department_name, max(full_date) as last_day from occ"
    ),
    "m_occupancy_last_date": _star(
        f"""
        select (select {_RATE} from occ) as avg_occupancy_rate_pct, {_RATE} as current_occupancy_pct,
               sum(total_beds)::bigint as total_beds, sum(occupied_beds)::bigint as occupied_beds,
               sum(available_beds)::bigint as available_beds
        from occ where full_date = (select max(full_date) from occ)
        """
    ),
    "m_occupancy_last_date_strict": _star(
        f"""
        , ends as (select year_month, max(full_date) as last_day from dim_date group by year_month),
        balance as (
          select o.year_month, {_RATE} as current_occupancy_pct, sum(total_beds)::bigint as total_beds,
                 sum(occupied_beds)::bigint as occupied_beds, sum(available_beds)::bigint as available_beds
          from occ o join ends e on o.full_date = e.last_day group by o.year_month)
        select g.*, b.* exclude (year_month)
        from (select year_month, {_RATE} as avg_occupancy_rate_pct from occ group by year_month) g
        left join balance b using (year_month)
        """
    ),
    "m_revenue_total": _star(
        f"""
        select {_REVENUE_COLUMNS}, {_REV} / (select count(*) from adm)::double as revenue_per_admission from bill
        """
    ),
    "m_revenue_by_insurance": _star(
        f"select insurance_type, {_REVENUE_COLUMNS} from bill group by insurance_type"
    ),
    "m_revenue_by_department": _revenue_per_admission("department_name"),
    "m_revenue_by_month": _revenue_per_admission("year_month"),
    "m_revenue_per_admission_by_insurance": _star(
        f"""
        select insurance_type, {_REV} as total_revenue, (select count(*) from adm) as total_admissions,
               {_REV} / (select count(*) from adm)::double as revenue_per_admission
        from bill group by insurance_type
        """
    ),
    "m_pending_by_status": _star(
        f"""
        select payment_status, {_REV} as total_revenue,
               (select nullif(count(*), 0) from bill where payment_status in ('Pending', 'Partial')) as pending_bills
        from bill group by payment_status
        """
    ),
    "m_patients": _star(
        f"""
        select count(distinct patient_id) as total_unique_patients,
               (select sum(age)::double / count(age) from dim_patient) as avg_patient_age,
               {_pct("count(distinct patient_id) filter (gender = 'Female')", "count(distinct patient_id)")} as female_patient_pct
        from adm
        """
    ),
    "m_patients_by_department": _star(
        f"""
        select department_name, count(distinct patient_id) as total_unique_patients,
               (select sum(age)::double / count(age) from dim_patient) as avg_patient_age,
               {_pct("nullif(count(distinct patient_id) filter (gender = 'Female'), 0)", "count(distinct patient_id)")} as female_patient_pct
        from adm group by department_name
        """
    ),
    "m_patients_by_gender": _star(
        f"""
        , women as (select count(distinct patient_id) as n from adm where gender = 'Female'),
        ages as (select gender, sum(age)::double / count(age) as avg_patient_age from dim_patient group by gender),
        seen as (select gender, count(distinct patient_id) as total_unique_patients from adm group by gender)
        select coalesce(s.gender, a.gender) as gender, total_unique_patients, avg_patient_age,
               {_pct("(select n from women)", "total_unique_patients")} as female_patient_pct
        from seen s full join ages a on s.gender is not distinct from a.gender
        """
    ),
    "m_totals_rollup": _star(
        f"""
        select dept_type, department_name, count(*) as total_admissions,
               {_pct(_READ, _ADM)} as readmission_rate_pct, count(distinct patient_id) as total_unique_patients,
               (2 - grouping(dept_type) - grouping(department_name))::int as level
        from adm group by rollup (dept_type, department_name)
        """
    ),
    "m_emergency_override": _star(
        f"""
        select admission_type, count(*) as total_admissions,
               {_pct("(select count(*) from adm where admission_type = 'Emergency')", "count(*)")} as emergency_rate_pct
        from adm group by admission_type
        """
    ),
    "m_emergency_by_type_department": _star(
        f"""
        , e as (select department_name, count(*) as n from adm where admission_type = 'Emergency' group by all)
        select admission_type, a.department_name, count(*) as total_admissions,
               {_pct("any_value(n)", "count(*)")} as emergency_rate_pct
        from adm a left join e on e.department_name is not distinct from a.department_name
        group by admission_type, a.department_name
        """
    ),
    "m_filtered_year": _star(
        f"""
        , q as (
          select quarter_label, min(full_date) as lo, max(full_date) as hi from dim_date where year = 1998 group by quarter_label),
        cur as (select quarter_label, count(*) as total_admissions from adm where year = 1998 group by all),
        rev as (select quarter_label, {_REV} as total_revenue from bill where year = 1998 group by all),
        ytd as (select q.quarter_label, count(*) as ytd_admissions from q join adm f on f.full_date between date '1998-01-01' and q.hi group by all),
        py as (select q.quarter_label, count(*) as py_admissions from q join adm f
               on f.full_date between (q.lo - interval 1 year)::date and (q.hi - interval 1 year)::date group by all)
        select quarter_label, total_admissions, total_revenue, ytd_admissions, py_admissions
        from q left join cur using (quarter_label) left join rev using (quarter_label)
        left join ytd using (quarter_label) left join py using (quarter_label)
        """
    ),
    "m_filtered_type": _star(
        f"""
        , a as (select department_name, count(*) as total_admissions from adm
                where admission_type in ('Planned', 'Referral') group by all),
        e as (select department_name, count(*) as n from adm where admission_type = 'Emergency' group by all),
        b as (select department_name, {_REV} as total_revenue from bill
              where admission_type in ('Planned', 'Referral') group by all)
        select department_name, total_admissions, {_pct("n", "total_admissions")} as emergency_rate_pct, total_revenue
        from a left join e using (department_name) left join b using (department_name)
        """
    ),
    "m_patients_ytd": _star(
        _BY_MONTH_BOUNDS
        + _periods(_YTD_RANGE, "count(distinct patient_id)", "adm", "people")
        + """
        , cur as (select year_month, count(distinct patient_id) as n from adm group by year_month)
        select year_month, n as total_unique_patients, nullif(people.v, 0) as ytd_unique_patients
        from months left join cur using (year_month) left join people using (year_month)
        where n is not null or people.v > 0
        """
    ),
    "m_patients_rolling_12m": _star(
        f"""
        , ends as (
          select year_month, max(full_date) as hi from dim_date
          where date_key in (select admission_date_key from fact_admissions) group by year_month)
        select e.year_month, f.department_name, count(distinct f.patient_id) as unique_patients_rolling_12m from ends e
        join adm f on f.full_date between {_rolling_start('e.hi', 12)} and e.hi group by all
        """
    ),
    "ti_ytd": _star(
        _BY_MONTH_BOUNDS
        + _periods(_YTD_RANGE, _COUNT, "adm", "ytd_a")
        + _periods(_YTD_RANGE, _REVENUE, "bill", "ytd_b")
        + """
        , cur as (select year_month, count(*) as total_admissions from adm group by year_month)
        select year_month, total_admissions, ytd_a.v as ytd_admissions, ytd_b.v as ytd_revenue
        from months left join cur using (year_month) left join ytd_a using (year_month) left join ytd_b using (year_month)
        where total_admissions is not null or ytd_a.v is not null or ytd_b.v is not null
        """
    ),
    "ti_qtd": _star(
        """
        , qtd as (
          select d.full_date, count(*) as n from dim_date d
          join adm f on f.full_date between date_trunc('quarter', d.full_date)::date and d.full_date group by d.full_date),
        cur as (select full_date, count(*) as total_admissions from adm group by full_date)
        select full_date, total_admissions, n as qtd_admissions from qtd left join cur using (full_date)
        """
    ),
    "ti_prior_year": _star(
        _BY_MONTH_BOUNDS
        + _periods(_PY_RANGE, _COUNT, "adm", "py_a")
        + _periods(_PY_RANGE, _REVENUE, "bill", "py_b")
        + f"""
        , ca as (select year_month, count(*) as n from adm group by year_month),
        cb as (select year_month, {_REVENUE} as r from bill group by year_month),
        j as (
          select m.year_month, n, r, py_a.v as pn, py_b.v as pr
          from months m left join ca using (year_month) left join cb using (year_month)
          left join py_a using (year_month) left join py_b using (year_month)
          union all
          select null, null, r, null, null from cb where year_month is null)
        select year_month, n as total_admissions, pn as py_admissions,
               case when pn is not null then (coalesce(n, 0) - pn)::double / nullif(pn, 0)::double * 100 end as admission_growth_yoy_pct,
               r as total_revenue, pr as py_revenue,
               case when pr is not null then (coalesce(r, 0) - pr) / nullif(pr, 0) * 100 end as revenue_growth_yoy_pct
        from j where n is not null or r is not null or pn is not null or pr is not null
        """
    ),
    "ti_prior_year_by_day": _star(
        """
        , cur as (select full_date, count(*) as n from adm group by full_date)
        select d.full_date, c.n as total_admissions, p.n as py_admissions
        from dim_date d left join cur c using (full_date)
        left join cur p on p.full_date = (d.full_date - interval 1 year)::date
        where c.n is not null or p.n is not null
        """
    ),
    "ti_prior_year_by_year": _star(
        """
        , cur as (select year, count(*) as n from adm group by year),
        years as (select distinct year from dim_date)
        select y.year, c.n as total_admissions, p.n as py_admissions,
               case when p.n is not null then (coalesce(c.n, 0) - p.n)::double / p.n::double * 100 end as admission_growth_yoy_pct
        from years y left join cur c on c.year = y.year left join cur p on p.year = y.year - 1
        where c.n is not null or p.n is not null
        """
    ),
    "ti_mom": _star(
        _BY_MONTH_BOUNDS
        + _periods(_PM_RANGE, _REVENUE, "bill", "pm")
        + f"""
        , cur as (select year_month, {_REVENUE} as r from bill group by year_month),
        j as (
          select year_month, r, pm.v as p from months left join cur using (year_month) left join pm using (year_month)
          union all select null, r, null from cur where year_month is null)
        select year_month, r as total_revenue,
               case when p is not null then (coalesce(r, 0) - p) / nullif(p, 0) * 100 end as mom_revenue_change_pct
        from j where r is not null or p is not null
        """
    ),
    "ti_rolling_12m": _star(
        _DATA_MONTHS
        + _periods(f"f.full_date between {_rolling_start('g.hi', 12)} and g.hi", _REVENUE, "bill", "r12", "data_months")
        + f"""
        , cur as (select year_month, {_REVENUE} as r from bill group by year_month)
        select coalesce(c.year_month, r12.year_month) as year_month, r as total_revenue, v as revenue_rolling_12m
        from cur c full join r12 on r12.year_month = c.year_month
        """
    ),
    "ti_rolling_12m_by_department": _star(
        f"""
        , ends as (
          select year_quarter, max(full_date) as hi from dim_date
          where date_key in (select admission_date_key from fact_admissions) group by year_quarter),
        r12 as (
          select e.year_quarter, f.department_name, {_REVENUE} as v from ends e
          join bill f on f.full_date between {_rolling_start('e.hi', 12)} and e.hi group by all),
        cur as (select year_quarter, department_name, {_REVENUE} as r from bill group by all)
        select coalesce(c.year_quarter, r12.year_quarter) as year_quarter,
               coalesce(c.department_name, r12.department_name) as department_name,
               r as total_revenue, v as revenue_rolling_12m
        from cur c full join r12
          on r12.year_quarter = c.year_quarter and r12.department_name is not distinct from c.department_name
        """
    ),
    "ti_los_rolling_3m": _star(
        _DATA_MONTHS
        + f"""
        , daily as (select full_date, avg(length_of_stay) as los from adm where full_date is not null group by full_date)
        select g.year_month, round_even(avg(los), 6) as los_rolling_3m
        from data_months g join daily f on f.full_date between {_rolling_start('g.hi', 3)} and g.hi
        group by g.year_month
        """
    ),
    "dept_rank_top3": _star(
        _RANKED
        + """
        select department_name, n as total_admissions, dense_rank() over (order by n desc)::int as dept_rank_by_admissions,
               case when dense_rank() over (order by n desc) <= 3 then 'Top 3' else 'Others' end as is_top_3_department
        from counts
        """
    ),
    "dept_rank_by_month": _star(
        """
        , counts as (select year_month, department_name, count(*) as n from adm group by all)
        select year_month, department_name, n as total_admissions,
               dense_rank() over (partition by year_month order by n desc)::int as dept_rank_by_admissions,
               case when dense_rank() over (partition by year_month order by n desc) <= 3 then 'Top 3' else 'Others' end as is_top_3_department
        from counts
        """
    ),
    "kpi_colors": _star(
        f"""
        , a as (select department_name, {_pct(_READ, _ADM)} as x from adm group by all),
        o as (select department_name, {_RATE} as x from occ group by all),
        b as (select department_name, {_COLLECTED} as x from bill group by all),
        names as (select department_name from dim_department union select department_name from a
                  union select department_name from b union select department_name from o)
        select n.department_name, {_color("a.x", ">= 20", ">= 15")} as readmission_kpi_color,
               {_color("o.x", ">= 95", ">= 80")} as occupancy_kpi_color,
               {_color("b.x", "< 70", "< 85")} as collection_kpi_color
        from names n
        left join a on a.department_name is not distinct from n.department_name
        left join o on o.department_name is not distinct from n.department_name
        left join b on b.department_name is not distinct from n.department_name
        """
    ),
    "rls_dept_manager": _secured(
        "department_name = 'Icu'", "department_name = 'Icu'", "department_name = 'Icu'", "true"
    ),
    "rls_read_only": _secured("true", "false", "true", "true"),
    "rls_multi_role": _secured("true", "department_name = 'Icu'", "true", "true"),
    "rpt_exec_cards": _star(
        f"""
        select count(*) as total_admissions, {_pct(_READ, _ADM)} as readmission_rate_pct,
               {_pct(_DEAD, _ADM)} as mortality_rate_pct, (select {_RATE} from occ) as avg_occupancy_rate_pct,
               (select {_REV} from bill) as total_revenue, (select {_COLLECTED} from bill) as collection_rate_pct
        from adm
        """
    ),
    "rpt_trends": _star(
        _BY_MONTH_BOUNDS
        + _periods(_YTD_RANGE, _COUNT, "adm", "ytd_a")
        + _periods(_YTD_RANGE, _REVENUE, "bill", "ytd_b")
        + _periods(_PM_RANGE, _REVENUE, "bill", "pm")
        + f"""
        , ca as (select year_month, count(*) as n from adm group by year_month),
        cb as (select year_month, {_REVENUE} as r from bill group by year_month),
        j as (
          select year_month, n, ytd_a.v as yn, r, ytd_b.v as yr, pm.v as p
          from months left join ca using (year_month) left join cb using (year_month)
          left join ytd_a using (year_month) left join ytd_b using (year_month) left join pm using (year_month)
          union all select null, null, null, r, null, null from cb where year_month is null)
        select year_month, n as total_admissions, yn as ytd_admissions, r as total_revenue, yr as ytd_revenue,
               case when p is not null then (coalesce(r, 0) - p) / nullif(p, 0) * 100 end as mom_revenue_change_pct
        from j where n is not null or yn is not null or r is not null or yr is not null or p is not null
        """
    ),
    "rpt_los_distribution": _star(
        "select los_category, count(*) as total_admissions from adm group by los_category"
    ),
    "rpt_admission_type": _star(
        f"""
        select admission_type, count(*) as total_admissions,
               {_pct("count(*)", "(select count(*) from adm)")} as share_pct
        from adm group by admission_type
        """
    ),
    "rpt_dept_heatmap": _star(
        "select department_name, "
        + _MONTH_CELLS.format("n")
        + " from (select department_name, month, count(*) as n from adm group by all) group by department_name"
    ),
    "rpt_quality": _star(
        f"""
        select department_name, {_pct(_READ, _ADM)} as readmission_rate_pct,
               coalesce({_pct(_READ, _ADM)}, 0) - 15 as readmission_vs_benchmark,
               {_pct(_DEAD, _ADM)} as mortality_rate_pct, {_RISK} as high_risk_patients,
               {_color(_pct(_READ, _ADM), ">= 20", ">= 15")} as readmission_kpi_color
        from adm group by department_name
        """
    ),
    "rpt_revenue_insurance": _star(
        f"""
        select insurance_type, {_REV} as total_revenue, {_INS} as insurance_revenue, {_OWED} as outstanding_revenue,
               {_COLLECTED} as collection_rate_pct, {_color(_COLLECTED, "< 70", "< 85")} as collection_kpi_color
        from bill group by insurance_type
        """
    ),
    "rpt_occupancy_heatmap": _star(
        "select department_name, "
        + _MONTH_CELLS.format("r")
        + f" from (select department_name, month, {_RATE} as r from occ group by all) group by department_name"
    ),
    "rpt_occupancy_trend": _star(
        f"select year_month, {_RATE} as avg_occupancy_rate_pct from occ group by year_month"
    ),
    "rpt_critical_alerts": _star(
        """
        select department_name, snapshot_date_key, occupancy_rate, occupied_beds, total_beds from (
          select * from occ
          qualify row_number() over (partition by department_key order by snapshot_date_key desc, occupancy_rate desc,
                                     occupied_beds desc, total_beds desc, occupancy_id desc) = 1)
        where occupancy_rate >= 95
        """
    ),
}
