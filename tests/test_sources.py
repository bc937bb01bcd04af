import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from caretiers.config import Layers, scratch_dir
from caretiers.sources.delimited import (
    REQUIRED_PATIENT_COLUMNS,
    csv_reader,
    malformed_records,
    read_csv_source,
    require_columns,
    require_non_empty,
    stamp,
)
from caretiers.sources.landing import land
from caretiers.sources.tables import append_table, materialize_table

from conftest import rows


def csv_file(tmp_path, text, name="x.csv"):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_csv_is_text_with_lower_case_header(spark, tmp_path):
    text = 'Id,FIRST,Zip,Note\na,"",02139,NA\nb,,1,"say ""hi"", ok"\n'
    df = read_csv_source(spark, csv_file(tmp_path, text))
    assert df.columns == ["id", "first", "zip", "note"]
    assert set(dict(df.dtypes).values()) == {"string"}
    assert rows(df) == [("a", None, "02139", "NA"), ("b", None, "1", 'say "hi", ok')]


def test_line_breaks_inside_quotes(spark, tmp_path):
    path = csv_file(tmp_path, 'id,first\na,"two\nlines"\n')
    assert rows(read_csv_source(spark, path, multi_line=True)) == [("a", "two\nlines")]


def test_empty_and_incomplete_extracts_are_refused(spark, tmp_path):
    empty = read_csv_source(spark, csv_file(tmp_path, "id,first\n"))
    with pytest.raises(ValueError, match="no rows"):
        require_non_empty(empty, "patients")
    other = read_csv_source(spark, csv_file(tmp_path, "id,last\na,b\n", "y.csv"))
    with pytest.raises(ValueError, match="first"):
        require_columns(other, REQUIRED_PATIENT_COLUMNS, "patients")
    assert require_columns(empty, REQUIRED_PATIENT_COLUMNS, "patients") is empty


def test_files_with_different_headers_are_not_mixed_up(spark, tmp_path):
    csv_file(tmp_path, "id,first\na,b\n", "1.csv")
    csv_file(tmp_path, "first,id\nc,d\n", "2.csv")
    with pytest.raises(Exception, match="header"):
        read_csv_source(spark, f"{tmp_path}/*.csv").collect()


def test_stamp(spark):
    got = stamp(spark.range(1), "feed", datetime(2024, 1, 2, 3, 4, 5)).first()
    assert got["source"] == "feed" and got["ingestion_time"] == datetime(2024, 1, 2, 3, 4, 5)


def test_landing_replaces_only_its_day(spark, tmp_path):
    root = str(tmp_path / "zone")
    frame = spark.createDataFrame([("1", ' a "q", '), ("2", None)], "id string, v string")
    land(frame, root, "2024-01-01")
    land(frame.where("id = '1'"), root, "2024-01-02")
    land(frame.where("id = '2'"), root, "2024-01-02")
    got = csv_reader(spark).csv(root).withColumn("load_date", F.col("load_date").cast("string"))
    assert rows(got) == [
        ("1", ' a "q", ', "2024-01-01"), ("2", None, "2024-01-01"), ("2", None, "2024-01-02"),
    ]
    assert sorted(d for d in os.listdir(root) if d.startswith("load_date")) == [
        "load_date=2024-01-01", "load_date=2024-01-02",
    ]


def test_append_keeps_and_adds(spark, database):
    for _ in range(2):
        append_table(spark.range(3), f"{database}.appended")
    assert spark.table(f"{database}.appended").count() == 6


def test_materialize_replaces_whole_table(spark, database):
    name = f"{database}.full"
    for values in ([1, 2], [3], [], [4, 5]):
        df = spark.createDataFrame([(v,) for v in values], "v int")
        materialize_table(df, name)
        assert rows(spark.table(name)) == [(v,) for v in values]
        assert spark.table(name).columns == ["v"]


def test_materialize_can_read_what_it_replaces(spark, database):
    name = f"{database}.grow"
    materialize_table(spark.createDataFrame([(1,)], "v int"), name)
    materialize_table(spark.table(name).select((F.col("v") + 1).alias("v")), name)
    assert rows(spark.table(name)) == [(2,)]


def test_failed_refresh_leaves_old_rows(spark, database):
    name = f"{database}.safe"
    materialize_table(spark.createDataFrame([("1",)], "v string"), name)
    broken = spark.createDataFrame([("x",)], "v string").select(
        F.col("v").cast("int").cast("string").alias("v")
    )
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        materialize_table(broken, name)
    assert rows(spark.table(name)) == [("1",)]


def test_refresh_follows_columns_and_types(spark, database):
    name = f"{database}.columns"
    materialize_table(spark.createDataFrame([(1,)], "v int"), name)
    materialize_table(spark.createDataFrame([(0.5, "a")], "v double, w string"), name)
    assert rows(spark.table(name)) == [(0.5, "a")]
    materialize_table(spark.table(name).drop("w"), name)
    assert spark.table(name).schema.simpleString() == "struct<v:double>"


def test_line_breaks_and_surplus_fields(spark, tmp_path):
    (tmp_path / "x.csv").write_text('id,first\n1,"An\nna"\n2,Bea,EXTRA,MORE\n3\n4,"Do""ra"\n')
    assert rows(read_csv_source(spark, str(tmp_path))) == [("1", "An\nna"), ("4", 'Do"ra')]
    assert rows(malformed_records(spark, str(tmp_path)), "content") == [("2,Bea,EXTRA,MORE",), ("3",)]


@pytest.mark.parametrize("multi_line", [True, False])
def test_malformed_records_keep_their_blanks(spark, tmp_path, multi_line):
    path = csv_file(tmp_path, "id,first\n1,a\n2,Bea,EXTRA ,MORE \t \n3 \n4,ok\n ,x, ")
    got = {r["content"] for r in malformed_records(spark, path, multi_line).collect()}
    assert got == {"2,Bea,EXTRA ,MORE \t ", "3 ", " ,x, "}


def test_layers_are_created(spark, tmp_path):
    layers = Layers("t_bronze", "t_silver", "t_gold")
    layers.create(spark, str(tmp_path))
    layers.create(spark, str(tmp_path))
    names = {r.namespace for r in spark.sql("SHOW DATABASES LIKE 't_*'").collect()}
    assert {"t_bronze", "t_silver", "t_gold"} <= names
    for name in ("t_bronze", "t_silver", "t_gold"):
        spark.sql(f"DROP DATABASE {name}")


def test_scratch_is_below_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first.startswith(root) and first != second
