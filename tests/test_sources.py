import datetime as dt

import pytest

from oreline.plans import bronze
from oreline.schemas import TABLES
from oreline.sources import control, ledger, raw, sinks

NOW = dt.datetime(2024, 5, 1)
HEADER = ",".join(TABLES["bed_occupancy"].columns)


def write(path, *lines, header=HEADER):
    path.write_text("\n".join([header, *lines]) + "\n")
    return str(path)


def test_typed_scan_reads_missing_markers(spark, tmp_path):
    path = write(
        tmp_path / "o.csv",
        "O1,ICU,2024-01-01,10,9.0,1,90.0,2024-01-01",
        "O2,NA,None,null,oops,,NaN,2024-01-02",
    )
    first, second = raw.scan_raw(spark, path, TABLES["bed_occupancy"]).orderBy("occupancy_id").collect()
    assert (first["total_beds"], first["occupied_beds"], first["occupancy_rate"]) == (10, 9, 90.0)
    assert [second[c] for c in ("department", "snapshot_date", "total_beds", "occupied_beds", "available_beds", "occupancy_rate")] == [None] * 6
    assert first["_source_file"] == "o.csv"


def test_scan_keeps_extra_and_lacks_missing_columns(spark, tmp_path):
    path = write(tmp_path / "o.csv", "O1,7", header="occupancy_id,surprise")
    df = raw.scan_raw(spark, path, TABLES["bed_occupancy"])
    assert df.columns == ["occupancy_id", "surprise", "_source_file"]
    whole = raw.conform(df, TABLES["bed_occupancy"])
    assert dict(whole.dtypes)["total_beds"] == "int" and whole.first()["total_beds"] is None


def test_manifest_and_missing_files(spark, tmp_path):
    write(tmp_path / "a.csv", "x")
    checked = {r["file_name"]: r for r in raw.check_files(spark, str(tmp_path), ["a.csv", "b.csv"]).collect()}
    assert checked["a.csv"]["exists"] and checked["a.csv"]["size"] == (tmp_path / "a.csv").stat().st_size
    assert not checked["b.csv"]["exists"] and checked["b.csv"]["last_modified"] is None
    assert [r[0] for r in raw.missing_files(spark, str(tmp_path), ["a.csv", "b.csv"]).collect()] == ["b.csv"]


def test_incremental_is_strict_and_overlap_reads_again(spark):
    data = [("a", "2024-01-01 00:00:00"), ("b", "2024-01-02 00:00:00"), ("c", "2024-01-03 00:00:00")]
    df = spark.createDataFrame(data, "admission_id string, updated_at string")
    table, mark = TABLES["admissions"], "2024-01-02 00:00:00"

    def ids(frame):
        return sorted(r[0] for r in frame.select("admission_id").collect())

    assert ids(raw.load(df, table, "incremental", mark)) == ["c"]
    assert ids(raw.load(df, table, "incremental", None)) == ["a", "b", "c"]
    assert ids(raw.load(df, table, "full", mark)) == ["a", "b", "c"]
    assert ids(raw.load(df, table, "incremental", mark, overlap="12 hours")) == ["b", "c"]
    with pytest.raises(ValueError):
        raw.load(df, table, "some", mark)


def test_marks_only_move_up(spark, tmp_path):
    path = str(tmp_path / "marks")
    assert control.last_mark(spark, path, "t") is None
    for mark in ("2024-01-02", "2024-01-01", None):
        control.advance_mark(spark, path, "t", mark, "r", NOW)
    control.advance_mark(spark, path, "u", "2025", "r", NOW)
    assert control.last_mark(spark, path, "t") == "2024-01-02"
    assert {tuple(r) for r in control.read_marks(spark, path).collect()} == {("t", "2024-01-02"), ("u", "2025")}


def test_logs(spark, tmp_path):
    runs, failures = str(tmp_path / "runs"), str(tmp_path / "failures")
    control.log_run(spark, runs, "p", "SUCCESS", "r1", NOW)
    control.log_failure(spark, failures, "t", "silver", ValueError("bad"), "r1", NOW)
    assert [tuple(r) for r in control.read_runs(spark, runs).collect()] == [(NOW, "p", "SUCCESS", "r1")]
    assert control.read_failures(spark, failures).first()["error"] == "ValueError: bad"


def test_append_table_grows_columns(spark):
    spark.sql("drop table if exists grow")
    sinks.append_table(spark.createDataFrame([(1, "a")], "x int, y string"), "grow")
    sinks.append_table(spark.createDataFrame([("b", 2, 3.5)], "y string, x int, z double"), "grow")
    sinks.append_table(spark.createDataFrame([(9,)], "x int"), "grow")
    got = {tuple(r) for r in raw.scan_table(spark, "grow").select("x", "y", "z").collect()}
    assert got == {(1, "a", None), (2, "b", 3.5), (9, None, None)}
    sinks.overwrite_table(spark.createDataFrame([(7,)], "x int"), "grow")
    assert [tuple(r) for r in spark.table("grow").collect()] == [(7,)]


def test_csv_export_and_json_report(spark, tmp_path):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 2), None)], "x int, d date, s string")
    sinks.export_csv(df, str(tmp_path / "c"))
    # Partitions without rows leave files with a header only; the order of the files is not fixed.
    texts = [path.read_text() for path in (tmp_path / "c").glob("*.csv")]
    assert [t for t in texts if t != "x,d,s\n"] == ["x,d,s\n1,2024-01-02,\n"]
    sinks.write_json(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).first()["x"] == 1


def test_partitioned_parquet_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 2023), (2, 2024), (3, None)], "x int, y int")
    sinks.write_parquet(df, str(tmp_path / "p"), partition_by="y")
    back = raw.scan_layer(spark, str(tmp_path / "p"))
    assert {tuple(r) for r in back.select("x", "y").collect()} == {(1, 2023), (2, 2024), (3, None)}
    assert (tmp_path / "p" / "y=2023").exists()


def test_partitioned_parquet_is_written_without_a_shuffle(spark, tmp_path):
    df = spark.range(0, 1000, numPartitions=4).selectExpr("id as x", "cast(id % 3 as int) as y")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("partitioned_write", "partitioned write")
    try:
        sinks.write_parquet(df, str(tmp_path / "p"), partition_by="y")
    finally:
        spark.sparkContext.setJobGroup("", "")
    stages = [s for j in tracker.getJobIdsForGroup("partitioned_write") for s in tracker.getJobInfo(j).stageIds]
    assert len(set(stages)) == 1
    back = raw.scan_layer(spark, str(tmp_path / "p"))
    assert sorted(tuple(r) for r in back.select("x", "y").collect()) == [(i, i % 3) for i in range(1000)]


def test_watermarks_that_are_no_time_are_loaded_and_never_become_the_mark(spark):
    table = TABLES["admissions"]
    df = spark.createDataFrame(
        [("a", "2024-01-01 00:00:00"), ("b", "unknown time"), ("c", None), ("d", "2024-01-03 00:00:00")],
        f"admission_id string, {table.watermark} string",
    )
    for overlap in (None, "12 hours"):
        loaded = raw.load(df, table, "incremental", "2024-01-02 00:00:00", overlap)
        assert sorted(r.admission_id for r in loaded.collect()) == ["b", "c", "d"]
    assert bronze.high_mark(df, table) == "2024-01-03 00:00:00"


def test_a_run_does_not_see_its_own_mark(spark, tmp_path):
    path = str(tmp_path / "marks")
    control.advance_mark(spark, path, "t", "2024-01-01", "r1", dt.datetime(2024, 1, 1))
    control.advance_mark(spark, path, "t", "2024-01-05", "r2", dt.datetime(2024, 1, 5))
    assert control.last_mark(spark, path, "t", "r2") == "2024-01-01"
    assert control.last_mark(spark, path, "t", "r3") == "2024-01-05"


# ---- scan with evidence -----------------------------------------------------------------------

BILL_HEADER = ",".join(TABLES["billing"].columns)


def test_cells_that_do_not_fit_stay_as_evidence(spark, tmp_path):
    path = write(
        tmp_path / "b.csv",
        "B1,A1,P1,2024-01-05,10.00,1,2,3,4,Self-Pay,0,10,Paid,2024-01-05",
        "B2,A1,P1,2024-01-05,n/k,1,2,x3,4,Self-Pay,0,,Paid,2024-01-05",
        "B3,A1,P1,2024-01-05,11.00,1,2,3,4,Self-Pay,0,10,Paid,2024-01-05,more",
        "B4,A1,P1",
        "B5,A1,P1,2024-01-05,99999999999999999999.00,NA,2,3,4,Self-Pay,0,10,Paid,2024-01-05",
        header=BILL_HEADER,
    )
    rows = {r["bill_id"]: r for r in raw.scan_evident(spark, path, TABLES["billing"]).collect()}
    assert rows["B1"]["_rejected_cells"] is None and rows["B1"]["_corrupt_record"] is None
    assert rows["B2"]["_rejected_cells"] == {"total_amount": "n/k", "procedure_charges": "x3"}
    assert rows["B2"]["total_amount"] is None and rows["B2"]["patient_payable"] is None
    assert rows["B5"]["_rejected_cells"] == {"total_amount": "99999999999999999999.00"}
    for key in ("B3", "B4"):
        assert rows[key]["_corrupt_record"].startswith(key) and rows[key]["_rejected_cells"] is None
    assert len({r["_record_hash"] for r in rows.values()}) == 5


def test_the_hash_sees_the_text_of_a_rejected_cell(spark, tmp_path):
    path = write(
        tmp_path / "o.csv", "O1,ICU,2024-01-01,many,9.0,1,90.0,2024-01-01", "O1,ICU,2024-01-01,lots,9.0,1,90.0,2024-01-01", "O1,ICU,2024-01-01,7.5,9,1,90.0,2024-01-01"
    )
    rows = raw.scan_evident(spark, path, TABLES["bed_occupancy"]).collect()
    assert len({r["_record_hash"] for r in rows}) == 3 and {r["total_beds"] for r in rows} == {None} and {r["occupied_beds"] for r in rows} == {9}
    assert sorted(r["_rejected_cells"]["total_beds"] for r in rows) == ["7.5", "lots", "many"]


def test_the_report_counts_what_was_rejected(spark, tmp_path):
    path = write(
        tmp_path / "o.csv", "O1,ICU,2024-01-01,many,x,1,90.0,2024-01-01", "O1,ICU,2024-01-01,many,x,1,90.0,2024-01-01", "O2,ICU,2024-01-01,10,9,1,90.0,2024-01-01",
        "O3,ICU,2024-01-01,10,9,1,90.0,2024-01-01,?",
    )
    load, counts = bronze.ingest(spark, path, str(tmp_path / "bronze"), TABLES["bed_occupancy"], "r1", NOW)
    assert (counts.rows, counts.without_mark, counts.mark) == (4, 0, "2024-01-01")
    report = bronze.report(load, TABLES["bed_occupancy"]).first()
    assert (report["status"], report["row_count"], report["duplicate_rows"], report["corrupt_records"]) == ("WARN", 4, 1, 1)
    assert report["rejected_cells"] == {"total_beds": 2, "occupied_beds": 2}
    assert report["null_percentages"]["total_beds"] == 50.0 and report["column_count"] == 8
    assert [r["occupancy_id"] for r in bronze.read_all(spark, str(tmp_path / "bronze"), TABLES["bed_occupancy"]).orderBy("occupancy_id").collect()] == ["O1", "O1", "O2"]
    assert [r["_corrupt_record"][:2] for r in bronze.corrupt_records(spark, str(tmp_path / "bronze")).collect()] == ["O3"]


def test_an_extract_comes_back_as_it_was(spark, tmp_path):
    data = [("O1", " a b ", None), ("O2", "x,\"y\"", ""), ("O3", "NA", "z")]
    df = spark.createDataFrame(data, "occupancy_id string, department string, snapshot_date string")
    sinks.write_extract(df, str(tmp_path / "e.csv"))
    got = raw.scan_evident(spark, str(tmp_path / "e.csv"), TABLES["bed_occupancy"]).collect()
    assert {(r["occupancy_id"], r["department"], r["snapshot_date"]) for r in got} == {("O1", " a b ", None), ("O2", "x,\"y\"", None), ("O3", None, "z")}


# ---- ledger of loads --------------------------------------------------------------------------


def test_a_load_starts_at_the_finished_loads_and_keeps_its_start(spark, tmp_path):
    path = str(tmp_path / "loads")
    first = ledger.begin(spark, path, "t", "r1", "incremental", NOW)
    assert (first.seq, first.start_mark, first.done) == (1, None, False)
    # A second run begins before the first has ended, then both end.
    second = ledger.begin(spark, path, "t", "r2", "incremental", NOW)
    assert (second.seq, second.start_mark) == (2, None)
    ledger.finish(spark, path, first, "2024-01-02", 2, 1, NOW)
    ledger.finish(spark, path, second, None, 0, 0, NOW)
    third = ledger.begin(spark, path, "t", "r3", "incremental", NOW)
    assert (third.seq, third.start_mark) == (3, "2024-01-02")
    ledger.finish(spark, path, third, "2024-01-09", 5, 0, NOW)
    again = ledger.begin(spark, path, "t", "r1", "incremental", NOW)
    assert (again.seq, again.start_mark, again.end_mark, again.rows) == (1, None, "2024-01-02", 2)
    assert ledger.begin(spark, path, "t", "r4", "full", NOW).start_mark is None
    assert ledger.begin(spark, path, "u", "r4", "incremental", NOW).start_mark is None
    with pytest.raises(ledger.ReplayError, match="incremental"):
        ledger.begin(spark, path, "t", "r1", "full", NOW)
    # A record of the end that is written again counts once.
    ledger.finish(spark, path, first, "2024-01-02", 2, 1, NOW + dt.timedelta(days=1))
    got = {(r["table"], r["run_id"]): (r["rows"], r["without_mark"]) for r in ledger.loads(spark, path).collect()}
    assert got[("t", "r1")] == (2, 1) and got[("t", "r4")] == (None, None) and len(got) == 5


def test_a_load_of_nothing_is_replayed_as_nothing(spark, tmp_path):
    path = str(tmp_path / "loads")
    ledger.finish(spark, path, ledger.begin(spark, path, "t", "r1", "incremental", NOW), None, 0, 0, NOW)
    until = ledger.begin(spark, path, "t", "r1", "incremental", NOW).until
    df = spark.createDataFrame([("a", "2024-01-01")], "admission_id string, updated_at string")
    assert raw.load(df, TABLES["admissions"], "incremental", None, until=until).isEmpty()


def test_replay_ends_at_its_mark(spark):
    df = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-02"), ("c", "2024-01-03"), ("d", None)], "admission_id string, updated_at string")
    ids = lambda *a, **k: sorted(r[0] for r in raw.load(df, TABLES["admissions"], *a, **k).select("admission_id").collect())
    assert ids("incremental", "2024-01-01", until="2024-01-02") == ["b", "d"]
    assert ids("full", None, until="2024-01-02") == ["a", "b", "d"]
