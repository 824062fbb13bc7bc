import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from oreline.operators import audit, profile
from oreline.operators.dedup import dedup
from oreline.operators.keys import dense_keys
from oreline.operators.split import split_rules
from oreline.operators.stages import stage_counts, stage_sizes

STAMP = dt.datetime(2024, 5, 1, 6, 0, 0)


def test_hash_marks_nulls_and_is_stable(spark):
    data = [("a", None, "b"), ("a", "b", None), ("a", "b", None)]
    df = spark.createDataFrame(data, "x string, y string, z string")
    first = [r[0] for r in audit.add_audit(df, df.columns, STAMP, "f.csv").select("_record_hash").collect()]
    later = STAMP + dt.timedelta(days=1)
    again = [r[0] for r in audit.add_audit(df, df.columns, later, "g.csv").select("_record_hash").collect()]
    assert first == again
    assert first[0] != first[1] and first[1] == first[2]


def test_audit_columns(spark):
    row = audit.add_audit(spark.createDataFrame([(1,)], "x int"), ["x"], STAMP, "f.csv").first()
    assert (row["_ingestion_timestamp"], row["_source_file"], row["_layer"]) == (STAMP, "f.csv", "bronze")


def test_dedup_keeps_latest_or_first(spark):
    data = [("k", "2024-01-01", "old"), ("k", "2024-02-01", "new"), ("m", "2024-01-01", "only")]
    df = spark.createDataFrame(data, "id string, updated_at string, v string")
    latest = {r["id"]: r["v"] for r in dedup(df, "id", ["updated_at"]).collect()}
    first = {r["id"]: r["v"] for r in dedup(df, "id", ["updated_at"], keep="first").collect()}
    assert latest == {"k": "new", "m": "only"} and first == {"k": "old", "m": "only"}
    with pytest.raises(ValueError):
        dedup(df, "id", ["updated_at"], keep="any")


def test_dedup_with_a_hot_key_against_brute_force(spark):
    rnd = random.Random(3)
    data = [("hot" if i % 3 == 0 else f"k{rnd.randrange(200)}", rnd.choice([None, 1, 2, 3]), rnd.randrange(50)) for i in range(3000)]
    df = spark.createDataFrame(data, "id string, at int, v int").repartition(7)
    expected = {}
    for key, at, v in data:
        candidate = (-1 if at is None else at, v)
        expected[key] = max(expected.get(key, candidate), candidate)
    got = {r["id"]: (-1 if r["at"] is None else r["at"], r["v"]) for r in dedup(df, "id", ["at"]).collect()}
    assert got == expected


def test_dedup_cuts_keys_before_the_shuffle(spark):
    df = spark.createDataFrame([("k", 1)], "id string, at int").repartition(3)
    plan = dedup(df, "id", ["at"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_null_key_is_one_key(spark):
    df = spark.createDataFrame([(None, 1), (None, 2)], "id string, at int")
    assert [r["at"] for r in dedup(df, "id", ["at"]).collect()] == [2]


def test_split_keeps_unknown_as_valid(spark):
    data = [(1, 2), (2, 1), (2, 2), (None, 1), (1, None)]
    df = spark.createDataFrame(data, "a int, b int")
    valid, rejected = split_rules(df, {"b_before_a": F.col("b") < F.col("a")})
    assert [tuple(r) for r in rejected.collect()] == [(2, 1, "b_before_a")]
    assert valid.count() == 4 and valid.columns == ["a", "b"]


def test_profile(spark):
    data = [("a", None, 1)] * 2 + [(None, None, 1)] * 2 + [(f"r{i}", "x", i) for i in range(16)]
    df = spark.createDataFrame(data, "p string, q string, extra int")
    row = profile.profile(df, ["p", "q", "gone"], "t").first()
    assert row["row_count"] == 20 and row["column_count"] == 3
    assert row["missing_columns"] == ["gone"] and row["extra_columns"] == ["extra"]
    assert row["null_percentages"] == {"p": 10.0, "q": 20.0, "extra": 0.0}
    assert row["duplicate_rows"] == 2 and row["status"] == "WARN"
    assert profile.profile(df, df.columns, "t").first()["status"] == "PASS"


def test_high_nulls_are_strictly_above_the_limit(spark):
    df = spark.createDataFrame([(None if i == 0 else 1, None if i < 2 else 1) for i in range(20)], "five int, ten int")
    assert [tuple(r) for r in profile.high_null_columns(df).collect()] == [("ten", 10.0)]
    report = profile.profile(df, df.columns, "t")
    assert [tuple(r) for r in profile.high_nulls_of(report).collect()] == [("t", "ten", 10.0)]


def test_profile_of_an_empty_table(spark):
    row = profile.profile(spark.createDataFrame([], "p string"), ["p"], "t").first()
    assert (row["row_count"], row["duplicate_rows"], row["null_percentages"]) == (0, 0, {"p": None})


def test_stage_counts_both_ways(spark):
    data = [("a", 1, True), ("a", 2, False), ("b", 1, True), ("c", 1, None)]
    df = spark.createDataFrame(data, "id string, at int, ok boolean")
    counts = stage_counts(df, "t", "id", ["at"], [("dedup", None), ("ok", F.col("ok"))])
    got = [tuple(r) for r in counts.collect()]
    assert got == [("t", "dedup", 4, 3, 1, 1), ("t", "ok", 4, 1, 3, 2)]
    unique = dedup(df, "id", ["at"])
    stored = stage_sizes(df, "t", [("dedup", unique), ("ok", unique.filter("ok"))])
    assert [tuple(r) for r in stored.collect()] == got


@pytest.mark.parametrize("count", [0, 1, 10, 3000])
def test_dense_keys_against_a_plain_sort(spark, count):
    names = [f"Dr. {'same prefix ' * 3}{random.Random(i).random()}" for i in range(count)]
    df = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "name string, at int").repartition(5)
    got = sorted((r["key"], r["name"], r["at"]) for r in dense_keys(df, "name", "key").collect())
    assert got == [(i, n, names.index(n)) for i, n in enumerate(sorted(names), 1)]


def test_record_hash_tells_shifted_values_and_nulls_apart(spark):
    rows = [("a||b", "c"), ("a", "b||c"), ("a", "\\N"), ("a", None), ("a", ""), ("a-1:", None), ("a", "-1:"), ("1:a", "")]
    df = spark.createDataFrame(rows, "x string, y string")
    hashes = [r[0] for r in df.select(audit.record_hash(["x", "y"])).collect()]
    assert len(set(hashes)) == len(rows)
