"""Loads in two drops: their figures, and what they leave on disk."""

import datetime as dt
import time

import pytest

from oreline.plans import bronze, rehearsal
from oreline.schemas import TABLES
from oreline.session import FREE_SHUFFLES, freed_shuffles, shared_folder
from oreline.sources import ledger, raw, sinks

EARLY, LATE = dt.datetime(1998, 1, 5), dt.datetime(1999, 2, 3)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Two customers, four orders (one without lines), five lines (one twice, one without a day), three events."""
    folder = tmp_path_factory.mktemp("tables")
    rows = {
        "nation": ("n_nationkey int, n_name string", [(1, "INDIA")]),
        "customer": ("c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string", [(1, "a", 1, 1.0, "X"), (2, "b", 1, -1.0, None)]),
        "orders": (
            "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp",
            [(1, 1, "F", EARLY), (2, 2, "O", EARLY), (3, 1, "P", LATE), (4, 2, "F", EARLY)],
        ),
        "lineitem": (
            "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_extendedprice double, l_returnflag string, l_shipdate timestamp",
            [(1, 1, 1, 1, 10.0, "A", EARLY), (1, 1, 1, 1, 10.0, "A", EARLY), (2, 1, 2, 2, 20.0, "N", LATE), (3, 1, 3, 3, 30.0, "R", LATE), (3, 2, 4, 4, 40.0, "R", None)],
        ),
        "events": ("event_id bigint, ts timestamp, event_type string", [(1, EARLY, "click"), (2, LATE, "click"), (3, LATE, "error")]),
    }
    for name, (schema, data) in rows.items():
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(str(folder / f"{name}.parquet"))
    return str(folder)


@pytest.fixture(scope="module")
def loaded(spark, tables, tmp_path_factory):
    """The rows of the query and the folder that it worked in."""
    found = []
    place = rehearsal._folder
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(rehearsal, "_folder", lambda *a: found.append(place(*a)) or found[-1])
        rows = rehearsal.two_loads(spark, tables).collect()
    (folder,) = found
    return {(r["table"], r["load"]): r for r in rows}, folder


def test_figures_of_two_loads(loaded):
    rows, _ = loaded
    figures = {
        at: tuple(r[c] for c in ("seq", "start_mark", "end_mark", "ledger_rows", "rows", "keys", "first_mark", "last_mark", "distinct_rows"))
        for at, r in rows.items()
    }
    assert figures == {
        ("patients", "r1"): (1, None, None, 0, 0, 0, None, None, 0),
        ("patients", "r2"): (2, None, "2001-01-01 00:00:00", 2, 2, 2, "2001-01-01 00:00:00", "2001-01-01 00:00:00", 2),
        ("admissions", "r1"): (1, None, "1998-01-05", 2, 2, 2, "1998-01-05", "1998-01-05", 2),
        ("admissions", "r2"): (2, "1998-01-05", "1999-02-03", 2, 2, 2, "1999-02-03", "1999-02-03", 2),
        ("billing", "r1"): (1, None, "1998-01-05", 2, 2, 1, "1998-01-05", "1998-01-05", 1),
        ("billing", "r2"): (2, "1998-01-05", "1999-02-03", 2, 2, 2, "1999-02-03", "1999-02-03", 2),
        ("bed_occupancy", "r1"): (1, None, "1998-01-05 23:00:00", 1, 1, 1, "1998-01-05 23:00:00", "1998-01-05 23:00:00", 1),
        ("bed_occupancy", "r2"): (2, "1998-01-05 23:00:00", "1999-02-03 23:00:00", 2, 2, 2, "1999-02-03 23:00:00", "1999-02-03 23:00:00", 2),
    }


def test_two_loads_leave_the_stored_loads_and_no_copies(spark, loaded):
    _, folder = loaded
    assert folder.startswith(shared_folder(spark))
    for name, table in TABLES.items():
        for drop in ("a", "b"):
            assert not raw.stored(spark, f"{folder}/{drop}/{table.file_name}")
        assert not raw.stored(spark, f"{folder}/lake/bronze/{name}__replay/r1")
        for load in ("r1", "r2"):
            assert raw.stored(spark, f"{folder}/lake/bronze/{name}/load={load}")


def test_extracts_of_two_drops_hold_all_rows_compressed(spark, tables, tmp_path):
    rehearsal.write_drops(spark, tables, str(tmp_path), ["billing"])
    parts = [p for p in (tmp_path).rglob("part-*") if p.is_file()]
    assert parts and all(p.name.endswith(".csv.gz") for p in parts)
    lines = raw.scan_evident(spark, f"{tmp_path}/[ab]/billing_raw.csv", TABLES["billing"])
    assert sorted((r["bill_id"], r["created_at"]) for r in lines.collect()) == [
        ("BILL11", "1998-01-05"), ("BILL11", "1998-01-05"), ("BILL21", "1999-02-03"), ("BILL31", "1999-02-03"),
    ]


def test_held_counts_nulls_and_repeats_as_one_aggregate_does(spark):
    stored = spark.createDataFrame(
        [("r1", "B1", "2024-01-01", "aa"), ("r1", "B1", "2024-01-02", "ab"), ("r1", None, None, "ab"), ("r2", None, None, "aa"), ("r2", None, "2023", "aa")],
        "load string, bill_id string, created_at string, _record_hash string",
    )
    rows, keys, hashes = ({r["load"]: tuple(r)[1:] for r in part.collect()} for part in rehearsal.held(stored, TABLES["billing"]))
    assert rows == {"r1": (3, "2024-01-01", "2024-01-02"), "r2": (2, "2023", "2023")}
    assert keys == {"r1": (1,)} and hashes == {"r1": (2,), "r2": (1,)}


def test_a_replay_moves_its_copy_into_place(spark, tmp_path):
    table = TABLES["bed_occupancy"]
    source, target = tmp_path / "o.csv", str(tmp_path / "bronze")
    source.write_text(",".join(table.columns) + "\nO1,ICU,2024-01-01,10,9,1,90.0,2024-01-01\n")
    bronze.ingest(spark, str(source), target, table, "r1")
    before = spark.read.parquet(f"{target}/load=r1").cache()
    assert before.count() == 1
    source.write_text(source.read_text() + "O2,ICU,2024-01-02,10,9,1,90.0,2024-01-02\n")
    stored, counts = bronze.ingest(spark, str(source), target, table, "r1", least=1)
    assert counts.rows == 2 and sorted(r["occupancy_id"] for r in stored.collect()) == ["O1", "O2"]
    assert not raw.stored(spark, f"{target}__replay/r1")
    assert spark.read.parquet(f"{target}/load=r1").count() == 2
    with pytest.raises(ledger.ReplayError):
        bronze.ingest(spark, str(source), target, table, "r1", least=3)
    assert spark.read.parquet(f"{target}/load=r1").count() == 2
    before.unpersist()


def test_replace_raises_where_nothing_is_moved(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "new"))
    sinks.replace(spark, str(tmp_path / "below" / "t"), by=str(tmp_path / "new"))
    assert spark.read.parquet(str(tmp_path / "below" / "t")).count() == 2
    with pytest.raises(Exception, match="new"):
        sinks.replace(spark, str(tmp_path / "below" / "u"), by=str(tmp_path / "new"))


def test_bronze_packs_its_hashes(spark, tmp_path):
    """Half a byte for each hex digit, with a little for the rest."""
    table, n = TABLES["bed_occupancy"], 20000
    source = tmp_path / "o.csv"
    source.write_text(",".join(table.columns) + "\n" + "".join(f"O{k},ICU,2024-01-01,10,9,1,90.0,2024-01-01\n" for k in range(n)))
    bronze.ingest(spark, str(source), str(tmp_path / "bronze"), table, "r1")
    assert sum(p.stat().st_size for p in (tmp_path / "bronze").rglob("*.parquet")) < 50 * n


def test_shuffle_files_end_with_their_action(spark):
    files = lambda: sum(
        f.getName().startswith("shuffle_") for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(
            spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        )
    )
    before, held = files(), spark.conf.get(FREE_SHUFFLES, None)
    with freed_shuffles(spark):
        frame = spark.range(1000).repartition(5)
        frame.write.format("noop").mode("overwrite").save()
        deadline = time.time() + 20
        while files() > before and time.time() < deadline:
            time.sleep(0.2)
        assert files() <= before
    assert spark.conf.get(FREE_SHUFFLES, None) == held
