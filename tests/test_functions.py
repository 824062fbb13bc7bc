import datetime as dt
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from oreline.functions import dates, numbers, rules, text

D = dt.date


def test_strip_removes_all_white_space(rows):
    assert rows([("\t a b \n",), ("  ",), (None,)], "s string", text.strip(F.col("s"))) == ["a b", "", None]


def test_title_case_samples(rows):
    samples = ["ICU", "semi-private", "o'neil st.", "dr. x2y", "cancer - stage ii", "", "éCOLE d'été", None]
    expected = [s.title() if s is not None else None for s in samples]
    assert rows([(s,) for s in samples], "s string", text.title_case(F.col("s"))) == expected


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(st.sampled_from("abcXYZ éÉñ0129-'./&_()")), min_size=1, max_size=60))
def test_title_case_equals_python_title(spark, samples):
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = [r[0] for r in df.select(text.title_case(F.col("s"))).collect()]
    assert got == [s.title() for s in samples]


def test_parse_date_is_tolerant(rows):
    data = [("2024-02-29",), ("2023-02-29",), ("not-a-date",), ("",), (None,)]
    assert rows(data, "s string", dates.parse_date(F.col("s"))) == [D(2024, 2, 29), None, None, None, None]


def test_date_parts(rows):
    day = F.col("d")
    got = rows(
        [(D(2021, 1, 1),), (D(2024, 2, 29),), (D(2024, 9, 1),), (None,)], "d date",
        dates.date_key(day), F.weekofyear(day), dates.day_of_week(day), dates.is_weekend(day),
        dates.is_month_start(day), dates.is_month_end(day), dates.year_month(day), dates.iso_text(day),
    )
    assert got == [
        (20210101, 53, 5, 0, 1, 0, "2021-01", "2021-01-01"),
        (20240229, 9, 4, 0, 0, 1, "2024-02", "2024-02-29"),
        (20240901, 35, 7, 1, 1, 0, "2024-09", "2024-09-01"),
        (None,) * 8,
    ]


def test_stepping_through_the_calendar(rows):
    got = rows(
        [(D(2024, 2, 28),), (None,)], "d date",
        dates.plus_days(F.col("d"), 2), dates.plus_days(F.col("d"), -59), dates.plus_hours(F.col("d"), 25).cast("string"),
    )
    assert got == [(D(2024, 3, 1), D(2023, 12, 31), "2024-02-29 01:00:00"), (None, None, None)]


def test_open_stay_counts_to_as_of(rows):
    data = [(D(2024, 1, 1), D(2024, 1, 5)), (D(2024, 1, 1), None), (None, D(2024, 1, 5)), (None, None)]
    stay = dates.stay_days(F.col("a"), F.col("b"), D(2024, 1, 31))
    assert rows(data, "a date, b date", stay) == [4, 30, None, None]


def test_age_truncates(rows):
    born = [D(1984, 1, 1), D(2023, 12, 31), D(2024, 6, 1), None]
    as_of = D(2024, 1, 1)
    expected = [int((as_of - b).days / 365.25) if b else None for b in born]
    assert rows([(b,) for b in born], "d date", dates.age_years(F.col("d"), as_of)) == expected


def test_age_bands_are_half_open(rows):
    data = [(a,) for a in (-1, 0, 17, 18, 34, 35, 50, 65, 199, 200, None)]
    assert rows(data, "a int", rules.age_band(F.col("a"))) == [
        None, "0-18", "0-18", "19-35", "19-35", "36-50", "51-65", "65+", "65+", None, None,
    ]


def test_stay_categories(rows):
    data = [(n,) for n in (0, 1, 2, 3, 4, 7, 8, 14, 15, None)]
    assert rows(data, "n int", rules.stay_category(F.col("n"))) == [
        "Same Day", "Same Day", "Short (1-3d)", "Short (1-3d)", "Medium (4-7d)", "Medium (4-7d)",
        "Long (8-14d)", "Long (8-14d)", "Extended (15d+)", "Unknown",
    ]


def test_revenue_tiers(rows):
    data = [(n,) for n in (0.0, 9999.99, 10000.0, 49999.99, 50000.0, 99999.99, 100000.0, None)]
    assert rows(data, "n double", rules.revenue_tier(F.col("n"))) == [
        "Low (<10K)", "Low (<10K)", "Medium (10K-50K)", "Medium (10K-50K)", "High (50K-1L)", "High (50K-1L)",
        "Premium (>1L)", "Premium (>1L)",
    ]


def test_occupancy_statuses(rows):
    data = [(n,) for n in (100.0, 95.0, 94.99, 80.0, 79.99, 60.0, 59.99, None)]
    assert rows(data, "n double", rules.occupancy_status(F.col("n"))) == [
        "Critical", "Critical", "High", "High", "Moderate", "Moderate", "Low", "Low",
    ]


def test_outstanding(rows):
    data = [(s, 10.01) for s in ("Paid", "Partial", "Pending", "Waived", "Unknown")] + [("Pending", None)]
    owed = rules.outstanding(F.col("s"), F.col("p").cast("decimal(18,2)")).cast("double")
    assert rows(data, "s string, p double", owed) == [0.0, 5.005, 10.01, 10.01, 10.01, None]


def test_flags_treat_unknown_as_no(rows):
    data = [("ICU", 0), ("General", 1), ("General", None), (None, None), (None, 1)]
    assert rows(data, "b string, r int", rules.high_risk(F.col("b"), F.col("r"))) == [1, 1, 0, 0, 1]


def test_payer_shares(rows):
    data = [("Star Health",), ("Self-Pay",), ("Other",), (None,)]
    assert [float(v) for v in rows(data, "s string", rules.payer_share(F.col("s")))] == [0.8, 0.0, 0.0, 0.0]


def test_half_even(rows):
    data = [(0.125,), (0.375,), (2.675,), (-0.125,), (None,)]
    assert rows(data, "x double", numbers.half_even(F.col("x"), 2)) == [0.12, 0.38, round(267.5) / 100, -0.12, None]


def test_safe_percent(rows):
    data = [(1, 4), (1, 0), (None, 4), (1, None), (0, 5)]
    assert rows(data, "a int, b int", numbers.percent(F.col("a"), F.col("b"))) == [25.0, None, None, None, 0.0]


@pytest.mark.parametrize("a,b,expected", [(3, 1, 2), (None, 1, -1), (3, None, 3), (None, None, None)])
def test_blank_minus(rows, a, b, expected):
    got = rows([(a, b)], "a int, b int", numbers.blank_minus(F.col("a"), F.col("b")))
    assert got == [expected]


def test_rates_never_turn_into_nan(rows):
    (value,) = rows([(0, 0)], "a int, b int", numbers.percent(F.col("a"), F.col("b")))
    assert value is None or not math.isnan(value)
