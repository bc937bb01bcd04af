"""Incremental ingestion: each file once, headers that change, repeated micro-batches."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from caretiers.config import DatasetConfig
from caretiers.sources.landing import land
from caretiers.streaming import bronze
from caretiers.streaming.bronze import await_all, bronze_stream, ingest_bronze, run_all, run_bronze
from caretiers.streaming.layouts import LayoutRegistry, evolve_schema, parse_header, read_headers

from conftest import plan_of, rows

NOW = datetime(2024, 1, 2, 12)


@pytest.fixture
def config(tmp_path, database):
    return DatasetConfig(
        "people", str(tmp_path / "landing"), str(tmp_path / "checkpoint"), f"{database}.people"
    )


def drop_file(config, day, name, text):
    from pathlib import Path

    folder = Path(config.source_path) / f"load_date={day}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


def test_each_file_once(spark, config):
    drop_file(config, "2024-01-01", "a.csv", "id,first\n1,Ann\n")
    run_all(spark, [config], NOW)
    run_all(spark, [config], NOW)
    assert rows(spark.table(config.target_table), "id", "first") == [("1", "Ann")]
    drop_file(config, "2024-01-02", "b b.csv", "id,first\n2,\"B, \"\"b\"\"\"\n")
    drop_file(config, "2024-01-02", "b.txt", "id,first\n3,no\n")
    drop_file(config, "2024-01-02", "none.csv", "")
    run_all(spark, [config], NOW)
    assert rows(spark.table(config.target_table), "id", "first", "load_date") == [
        ("1", "Ann", "2024-01-01"), ("2", 'B, "b"', "2024-01-02"),
    ]


def test_a_file_changed_in_place_is_not_read_again(spark, config):
    drop_file(config, "2024-01-01", "a.csv", "id,first\n1,Ann\n")
    run_all(spark, [config], NOW)
    drop_file(config, "2024-01-01", "a.csv", "id,first\n1,Changed\n")
    run_all(spark, [config], NOW)
    assert rows(spark.table(config.target_table), "first") == [("Ann",)]


def test_a_day_landed_again_is_taken_in_again(spark, config):
    frame = spark.createDataFrame([("1", "Ann")], "id string, first string")
    for _ in range(2):
        land(frame, config.source_path, "2024-01-01")
        run_all(spark, [config], NOW)
    assert spark.table(config.target_table).count() == 2


def test_lineage(spark, config):
    drop_file(config, "2024-01-01", "a.csv", "id,first\n1,Ann\n")
    run_all(spark, [config], NOW)
    got = spark.table(config.target_table).first()
    assert got["_ingestion_timestamp"] == NOW
    assert got["_load_date"] == date(2024, 1, 2)
    assert got["_source_file"].endswith("load_date=2024-01-01/a.csv")


def test_clock_of_the_run(spark, config):
    drop_file(config, "2024-01-01", "a.csv", "id,first\n1,Ann\n")
    run_all(spark, [config])
    age = spark.table(config.target_table).select(
        F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp("_ingestion_timestamp"),
        F.col("_load_date") == F.to_date("_ingestion_timestamp"),
    ).first()
    assert 0 <= age[0] < 300 and age[1]


def test_headers_may_grow_shrink_and_move(spark, config):
    drop_file(config, "2024-01-01", "a.csv", "ID,First,Last\n1,Ann,Dahl\n")
    run_all(spark, [config], NOW)
    drop_file(config, "2024-01-02", "b.csv", "last,zip,id,first\nBerg,02139,2,Bea\n")
    drop_file(config, "2024-01-02", "c.csv", "id\n3\n")
    drop_file(config, "2024-01-02", "d.csv", "﻿id,first,last\n4,Dan,Dorn\n")
    run_all(spark, [config], NOW)
    drop_file(config, "2024-01-03", "e.csv", "id,first,last\n5,Eva,Ek\n")
    run_all(spark, [config], NOW)
    assert rows(spark.table(config.target_table), "id", "first", "last", "zip") == [
        ("1", "Ann", "Dahl", None), ("2", "Bea", "Berg", "02139"), ("3", None, None, None),
        ("4", "Dan", "Dorn", None), ("5", "Eva", "Ek", None),
    ]
    registry = LayoutRegistry(spark, f"{config.checkpoint_path}/_layout")
    assert registry.layout.columns == ("id", "first", "last", "zip")


def test_after_mixed_headers_the_attempt_is_skipped_once(spark, config, monkeypatch):
    reads = []
    read = bronze.read_layout
    monkeypatch.setattr(bronze, "read_layout", lambda *a, **k: reads.append(a[1]) or read(*a, **k))

    def run(day, *texts):
        for i, text in enumerate(texts):
            drop_file(config, day, f"{i}.csv", text)
        run_all(spark, [config], NOW)
        attempts = len(reads)
        reads.clear()
        return attempts, LayoutRegistry(spark, f"{config.checkpoint_path}/_layout").layout.header

    assert run("2024-01-01", "id,a\n1,x\n", "a,id\ny,2\n") == (1, ())
    assert run("2024-01-02", "a,id\ny,3\n", "a,id\nz,4\n") == (0, ("a", "id"))
    assert run("2024-01-03", "a,id\ny,5\n") == (1, ("a", "id"))
    assert rows(spark.table(config.target_table), "id", "a") == [
        ("1", "x"), ("2", "y"), ("3", "y"), ("4", "z"), ("5", "y"),
    ]


def test_file_names_are_not_patterns(spark, config):
    drop_file(config, "2024-01-01", "a[1] {x}.csv", "id,a\n1,x\n")
    drop_file(config, "2024-01-01", "a1 x.csv", "a,id\ny,2\n")
    run_all(spark, [config], NOW)
    assert rows(spark.table(config.target_table), "id", "a") == [("1", "x"), ("2", "y")]


def test_landing_day_in_the_path_wins_over_one_in_the_data(spark, config):
    drop_file(config, "2024-01-01", "a.csv", "id,load_date,first\n1,1999-09-09,Ann\n")
    run_all(spark, [config], NOW)
    assert rows(spark.table(config.target_table), "id", "load_date", "first") == [
        ("1", "2024-01-01", "Ann")
    ]


def test_known_header_needs_no_header_scan(spark, config, monkeypatch):
    drop_file(config, "2024-01-01", "a.csv", "id,first\n1,Ann\n")
    run_all(spark, [config], NOW)
    monkeypatch.setattr(bronze, "read_headers", lambda *a: pytest.fail("header scan"))
    drop_file(config, "2024-01-02", "b.csv", "id,first\n2,Bea\n")
    run_all(spark, [config], NOW)
    assert spark.table(config.target_table).count() == 2


def test_repeated_micro_batch_replaces_itself(spark, config):
    drop_file(config, "2024-01-01", "a.csv", "id,first\n1,Ann\n")
    path = f"{config.source_path}/load_date=2024-01-01/a.csv"
    for _ in range(2):
        bronze._ingest_files(spark, config, [path], F.lit(NOW.isoformat()).cast("timestamp"), "q-0")
    assert spark.table(config.target_table).count() == 1


def test_failed_run_is_repeated_without_doubles(spark, config, monkeypatch):
    drop_file(config, "2024-01-01", "a.csv", "id,first\n1,Ann\n")
    write = bronze._write

    def fail_after_write(*args):
        write(*args)
        raise RuntimeError("lost driver")

    monkeypatch.setattr(bronze, "_write", fail_after_write)
    with pytest.raises(Exception, match="lost driver"):
        run_all(spark, [config], NOW)
    monkeypatch.setattr(bronze, "_write", write)
    run_all(spark, [config], NOW)
    spark.catalog.refreshTable(config.target_table)
    assert spark.table(config.target_table).count() == 1


def test_micro_batches_are_bounded(spark, config):
    small = DatasetConfig(
        config.name, config.source_path, config.checkpoint_path, config.target_table,
        max_files_per_trigger=2,
    )
    for i in range(5):
        drop_file(small, "2024-01-01", f"{i}.csv", f"id,first\n{i},x\n")
    query = ingest_bronze(spark, small, NOW)
    await_all([query])
    table = spark.table(small.target_table)
    assert table.count() == 5
    assert table.select("_batch").distinct().count() == 3


def test_bronze_is_cut_by_load_day(spark, config):
    from caretiers.operators.recent import recent

    drop_file(config, "2024-01-01", "a.csv", "id,first\n1,Ann\n")
    run_all(spark, [config], datetime(2024, 1, 1, 5))
    drop_file(config, "2024-01-03", "b.csv", "id,first\n2,Bea\n")
    run_all(spark, [config], datetime(2024, 1, 3, 5))
    kept = recent(spark.table(config.target_table), "2024-01-03")
    assert rows(kept, "id") == [("2",)]
    plan = plan_of(kept)
    assert "PartitionFilters: [isnotnull(_load_date" in plan
    assert "GreaterThanOrEqual(_ingestion_timestamp" in plan


def test_one_failing_zone_does_not_stop_the_others(spark, config, tmp_path, database):
    bad = DatasetConfig("bad", str(tmp_path / "bad"), str(tmp_path / "cp2"), f"{database}.bad")
    drop_file(bad, "2024-01-01", "a.csv", "id,id\n1,2\n")
    drop_file(config, "2024-01-01", "a.csv", "id,first\n1,Ann\n")
    with pytest.raises(Exception, match="no usable header"):
        run_all(spark, [bad, config], NOW)
    assert spark.table(config.target_table).count() == 1


def fixed(config):
    return DatasetConfig(
        config.name, config.source_path, config.checkpoint_path, config.target_table,
        columns=("id", "first"),
    )


def test_fixed_layout(spark, config):
    config = fixed(config)
    drop_file(config, "2024-01-01", "a.csv", "ID,FIRST\n1,Ann\n")
    for day in ("2024-01-02", "2024-01-03"):
        stream = bronze_stream(spark, config, NOW)
        await_all([run_bronze(stream, config.target_table, config.checkpoint_path)])
        drop_file(config, day, "b.csv", f"id,first\n{day},Bea\n")
    assert rows(spark.table(config.target_table), "id", "load_date") == [
        ("1", "2024-01-01"), ("2024-01-02", "2024-01-02"),
    ]


def test_fixed_layout_refuses_other_headers(spark, config):
    config = fixed(config)
    drop_file(config, "2024-01-01", "a.csv", "first,id\nAnn,1\n")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        stream = bronze_stream(spark, config, NOW)
        await_all([run_bronze(stream, config.target_table, config.checkpoint_path)])


def test_evolve_schema():
    assert evolve_schema(["a", "b"], ["c", "b", "c", "d"]) == ["a", "b", "c", "d"]
    assert evolve_schema([], ["b", "a"]) == ["b", "a"]


def test_parse_header():
    assert parse_header("Id,Name", "f") == ("id", "name")
    for bad in ("", "a,,b", "a,A"):
        with pytest.raises(ValueError):
            parse_header(bad, "f")


def test_headers_of_split_files(spark, tmp_path):
    big, small = tmp_path / "big.csv", tmp_path / "small.csv"
    big.write_text("id,first\n" + "1,Ann\n" * 200_000)
    small.write_text("first,id\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        got = read_headers(spark, [str(big), str(small)])
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {k.rsplit("/", 1)[1]: v for k, v in got.items()} == {
        "big.csv": ("id", "first"), "small.csv": ("first", "id"),
    }


def bytes_read(spark):
    store = spark._jvm.org.apache.hadoop.fs.FileSystem
    return sum(s.getBytesRead() for s in store.getAllStatistics())


def test_looking_up_headers_reads_no_more_of_larger_files(spark, tmp_path):
    read = []
    for k, lines in enumerate((10_000, 2_000_000)):
        path = tmp_path / f"{k}.csv"
        path.write_text("id,first\n" + "1,Ann of somewhere\n" * lines)
        before = bytes_read(spark)
        assert list(read_headers(spark, [str(path)]).values()) == [("id", "first")]
        read.append(bytes_read(spark) - before)
    assert max(read) < 3_000_000 and read[1] < read[0] + 2_000_000


def test_a_read_that_fails_for_another_reason_is_raised(spark, config, monkeypatch):
    drop_file(config, "2024-01-01", "a.csv", "id,first\n1,Ann\n")
    monkeypatch.setattr(bronze, "_write", lambda *a: (_ for _ in ()).throw(RuntimeError("disk full")))
    with pytest.raises(Exception, match="disk full"):
        run_all(spark, [config], NOW)


@pytest.mark.parametrize("layout", ["evolving", "fixed"])
def test_files_taken_in_leave_the_zone(spark, config, tmp_path, layout):
    import dataclasses
    import time
    from pathlib import Path

    config = dataclasses.replace(
        config, archive_path=str(tmp_path / "archive"), columns=("id", "first") if layout == "fixed" else None
    )

    def files(root):
        return sorted(p.name for p in Path(root).rglob("*.csv"))

    for k in range(4):
        drop_file(config, f"2024-01-0{k + 1}", f"{k}.csv", f"id,first\n{k},x\n")
        if layout == "fixed":
            stream = bronze_stream(spark, config, NOW)
            await_all([run_bronze(stream, config.target_table, config.checkpoint_path)])
        else:
            run_all(spark, [config], NOW)
        # The last micro-batch is cleaned up when the next one begins, by a thread of its own.
        wanted = [f"{k}.csv"]
        for _ in range(50):
            if files(config.source_path) == wanted:
                break
            time.sleep(0.1)
        assert files(config.source_path) == wanted
        assert files(config.archive_path) == [f"{i}.csv" for i in range(k)]
    assert rows(spark.table(config.target_table), "id") == [(str(i),) for i in range(4)]


def test_runs_are_counted(spark, config, database):
    table = f"{database}.run_metrics"
    drop_file(config, "2024-01-01", "a.csv", "id,first\n1,Ann\n2,Bea\n")
    drop_file(config, "2024-01-01", "b.csv", "first,id\nCleo,3\n")
    run_all(spark, [config], NOW, table)
    run_all(spark, [config], NOW, table)
    drop_file(config, "2024-01-02", "c.csv", "id,first\n")
    run_all(spark, [config], NOW, table)
    got = spark.table(table)
    assert rows(got, "zone", "ingested_at", "files", "n_rows") == [("people", NOW, 1, 0), ("people", NOW, 2, 3)]
    batches = {r[0] for r in spark.table(config.target_table).select("_batch").distinct().collect()}
    assert batches == {r["batch"] for r in got.where("n_rows > 0").collect()}
