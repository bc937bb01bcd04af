from datetime import datetime

import pytest
from pyspark.sql import functions as F

from caretiers.operators import upsert as upsert_module
from caretiers.operators.latest import latest_by
from caretiers.operators.upsert import data_table, upsert, versions_since
from caretiers.plans.gold import dim_patient, fact_encounter, mart_patient_summary
from caretiers.schemas import (
    DIM_PATIENT_COLUMNS,
    FACT_ENCOUNTER_COLUMNS,
    MART_COLUMNS,
    SILVER_ENCOUNTER_COLUMNS,
    SILVER_PATIENT_COLUMNS,
)
from caretiers.sources.tables import append_load, loads, loads_since, taken_from_source

from conftest import plan_of, rows

T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2)
FACT = (
    "encounter_id string, patient_id string, total_claim_cost double, payer_coverage double, "
    "encounter_duration_minutes double"
)
DIM = "patient_id string, full_name string, gender string, city string, state string"


def silver(spark, columns, *found):
    """Silver rows with the given values; all other columns are NULL."""
    df = spark.createDataFrame([(i,) for i in range(len(found))], "n int")

    def column(name):
        value = F.lit(None)
        for i, row in enumerate(found):
            value = F.when(F.col("n") == i, F.lit(row.get(name))).otherwise(value)
        kind = "timestamp" if name in ("ingestion_time", "silver_load_time") else "string"
        return value.cast(kind).alias(name)

    return df.select(*[column(c) for c in columns])


def test_dimension_has_newest_row_and_full_name(spark):
    rows_in = silver(
        spark, SILVER_PATIENT_COLUMNS,
        dict(patient_id="a", first_name="Ann", last_name="Old", ingestion_time=T1, ssn="s"),
        dict(patient_id="a", first_name="Ann", last_name="New", ingestion_time=T2),
        dict(patient_id="b", first_name="Bea", ingestion_time=T1),
        dict(patient_id=None, last_name="x", ingestion_time=T1),
        dict(patient_id=None, last_name="y", ingestion_time=T2),
    )
    dim = dim_patient(rows_in)
    assert tuple(dim.columns) == DIM_PATIENT_COLUMNS
    assert rows(dim, "patient_id", "last_name", "full_name") == [
        (None, "y", None), ("a", "New", "Ann New"), ("b", None, None),
    ]


def test_fact_keeps_repeated_rows(spark):
    df = silver(spark, SILVER_ENCOUNTER_COLUMNS, dict(encounter_id="e"), dict(encounter_id="e"))
    fact = fact_encounter(df)
    assert tuple(fact.columns) == FACT_ENCOUNTER_COLUMNS and fact.count() == 2


def mart_of(spark, dim, fact):
    return mart_patient_summary(
        spark.createDataFrame(dim, DIM), spark.createDataFrame(fact, FACT)
    )


def test_mart(spark):
    dim = [("a", "Ann", "F", "X", None), ("b", None, None, None, None), (None, "N", "F", "Y", "Z")]
    fact = [
        ("1", "a", 10.0, 5.0, 30.0), ("2", "a", 0.0, 0.0, 60.0), (None, "a", 2.0, None, None),
        ("3", "unknown", 7.0, 7.0, 7.0), ("4", None, 9.0, 9.0, 9.0),
    ]
    mart = mart_of(spark, dim, fact)
    assert tuple(mart.columns) == MART_COLUMNS
    assert dict(mart.dtypes)["total_encounters"] == "bigint"
    assert rows(mart) == [
        (None, "N", "F", "Y", "Z", 0, None, None, None, None),
        ("a", "Ann", "F", "X", None, 2, 12.0, 5.0, 4.0, 45.0),
        ("b", None, None, None, None, 0, None, None, None, None),
    ]


def test_mart_of_a_dimension_with_repeated_rows(spark):
    """Equal rows of the dimension join every encounter each and fall into one group."""
    dim = [("a", "Ann", "F", "X", "S")] * 2 + [("a", "Ann", "F", "Y", "S")]
    mart = mart_of(spark, dim, [("1", "a", 4.0, 1.0, 10.0), ("2", "a", 8.0, 1.0, 20.0)])
    assert rows(mart) == [
        ("a", "Ann", "F", "X", "S", 4, 24.0, 4.0, 6.0, 15.0),
        ("a", "Ann", "F", "Y", "S", 2, 12.0, 2.0, 6.0, 15.0),
    ]


def test_mart_equals_joining_first(spark):
    dim = spark.range(50).select(
        F.col("id").cast("string").alias("patient_id"), F.lit("n").alias("full_name"),
        F.lit("g").alias("gender"), (F.col("id") % 3).cast("string").alias("city"),
        F.lit(None).cast("string").alias("state"),
    )
    fact = spark.range(5000).select(
        F.col("id").cast("string").alias("encounter_id"),
        F.when(F.col("id") % 3 == 0, "7").otherwise((F.col("id") % 40).cast("string"))
        .alias("patient_id"),
        (F.col("id") % 11).cast("double").alias("total_claim_cost"),
        F.when(F.col("id") % 5 > 0, (F.col("id") % 7).cast("double")).alias("payer_coverage"),
        F.when(F.col("id") % 2 > 0, (F.col("id") % 13).cast("double"))
        .alias("encounter_duration_minutes"),
    )
    joined = dim.join(fact.withColumnRenamed("patient_id", "p"), F.col("patient_id") == F.col("p"),
                      "left")
    naive = joined.groupBy("patient_id", "full_name", "gender", "city", "state").agg(
        F.count("encounter_id"), F.sum("total_claim_cost"), F.sum("payer_coverage"),
        F.round(F.avg("total_claim_cost"), 9), F.round(F.avg("encounter_duration_minutes"), 9),
    )
    mart = mart_patient_summary(dim, fact).withColumns(
        {c: F.round(c, 9) for c in ("avg_claim_cost", "avg_encounter_duration")}
    )
    assert rows(mart) == rows(naive)


def test_mart_plan_sums_before_it_shuffles(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(mart_of(spark, [("a",) * 5], [("1", "a", 1.0, 1.0, 1.0)]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 2
    assert plan.rindex("partial_count") > plan.rindex("Exchange")


# --- upsert -----------------------------------------------------------------------------------


def batch(spark, *found):
    return spark.createDataFrame(list(found), "k string, t int, v string")


def test_a_missing_key_is_one_key(spark, database):
    name = f"{database}.missing"
    for t in (1, 2, 2):
        upsert(batch(spark, (None, t, f"n{t}"), ("a", t, "x")), name, "k", ["t"])
    assert rows(spark.table(name), "k", "v") == [(None, "n2"), ("a", "x")]


def test_upsert_inserts_then_replaces(spark, database):
    name = f"{database}.people"
    upsert(batch(spark, ("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")), name, "k", ["t"], 4)
    assert rows(spark.table(name)) == [("a", 2, "y"), ("b", 1, "z")]
    second = batch(spark, ("b", 3, "zz"), ("c", 1, "w"))
    for _ in range(3):
        upsert(second, name, "k", ["t"], 4)
        assert rows(spark.table(name)) == [("a", 2, "y"), ("b", 3, "zz"), ("c", 1, "w")]
    upsert(second.limit(0), name, "k", ["t"])
    assert spark.table(name).count() == 3


def test_upsert_of_nothing_makes_an_empty_table(spark, database):
    name = f"{database}.nothing"
    upsert(batch(spark, ("a", 1, "x")).limit(0), name, "k", ["t"], 4)
    assert spark.table(name).columns == ["k", "t", "v"] and spark.table(name).count() == 0
    upsert(batch(spark, ("a", 1, "x")), name, "k", ["t"])
    assert spark.table(name).count() == 1


def test_upsert_from_a_query_over_the_table_itself(spark, database):
    name = f"{database}.own"
    upsert(batch(spark, ("a", 1, "x"), ("b", 1, "x")), name, "k", ["t"], 2)
    upsert(spark.table(name).where("k = 'a'").withColumn("v", F.lit("y")), name, "k", ["t"])
    assert rows(spark.table(name), "k", "v") == [("a", "y"), ("b", "x")]


def files_of(spark, name):
    return {r[0] for r in spark.sql(f"SELECT DISTINCT _metadata.file_path FROM {data_table(name)}").collect()}


def test_upsert_writes_what_the_batch_holds(spark, database):
    name = f"{database}.small"
    upsert(batch(spark, *[(f"k{i}", 1, "x") for i in range(2000)]), name, "k", ["t"])
    before = files_of(spark, name)
    upsert(batch(spark, ("k0", 2, "y")), name, "k", ["t"])
    assert before < files_of(spark, name) and len(files_of(spark, name) - before) == 1
    assert spark.table(name).count() == 2000


def test_versions_are_merged(spark, database):
    name = f"{database}.merged"
    for t in range(1, 12):
        upsert(batch(spark, ("a", t, f"v{t}"), (f"k{t}", t, "x")), name, "k", ["t"], 3)
        assert spark.table(name).count() == t + 1
        assert spark.table(name).where("k = 'a'").first()["v"] == f"v{t}"
    assert spark.sql(f"SHOW PARTITIONS {data_table(name)}").count() <= 8


def test_upsert_of_other_types_or_columns_is_refused(spark, database):
    name = f"{database}.types"
    upsert(batch(spark, ("a", 1, "x")), name, "k", ["t"])
    with pytest.raises(ValueError, match="double"):
        upsert(batch(spark, ("a", 1, "x")).withColumn("t", F.lit(2.75)), name, "k", ["t"])
    with pytest.raises(ValueError, match="columns"):
        upsert(batch(spark, ("a", 1, "x")).drop("v"), name, "k", ["t"])
    upsert(batch(spark, ("a", 1, "z")).withColumn("t", F.lit(2).cast("short")), name, "k", ["t"])
    assert rows(spark.table(name)) == [("a", 2, "z")]


def test_first_upsert_that_died_is_forgotten(spark, database, monkeypatch):
    name = f"{database}.first"

    def die(*args):
        raise RuntimeError("lost driver")

    with monkeypatch.context() as patched:
        patched.setattr(upsert_module, "publish", die)
        with pytest.raises(RuntimeError):
            upsert(batch(spark, *[(f"k{i}", 1, "crashed") for i in range(50)]), name, "k", ["t"])
    upsert(batch(spark, ("k1", 1, "good")), name, "k", ["t"])
    assert rows(spark.table(name), "k", "v") == [("k1", "good")]


def test_upsert_that_dies_before_publishing_changes_nothing(spark, database, monkeypatch):
    name = f"{database}.safe"
    upsert(batch(spark, ("a", 1, "x"), ("b", 1, "x")), name, "k", ["t"], 2)

    def die(*args):
        raise RuntimeError("lost driver")

    with monkeypatch.context() as patched:
        patched.setattr(upsert_module, "publish", die)
        with pytest.raises(RuntimeError):
            upsert(batch(spark, ("a", 2, "y"), ("c", 2, "y")), name, "k", ["t"])
    assert rows(spark.table(name), "k", "v") == [("a", "x"), ("b", "x")]
    upsert(batch(spark, ("a", 2, "y"), ("c", 2, "y")), name, "k", ["t"])
    assert rows(spark.table(name), "k", "v") == [("a", "y"), ("b", "x"), ("c", "y")]


def test_a_table_is_read_and_joined_without_shuffling_it(spark, database):
    name = f"{database}.people"
    upsert(batch(spark, ("a", 1, "x"), ("b", 1, "x"), (None, 1, "x")), name, "k", ["t"], 3, 4)
    upsert(batch(spark, ("b", 2, "y")), name, "k", ["t"], 3, 4)
    for _ in range(2):
        shown = spark.table(name)
        assert "Exchange" not in plan_of(shown)
        assert rows(shown, "k", "v") == [(None, "x"), ("a", "x"), ("b", "y")]
        other = spark.range(10).select(F.concat(F.lit("k"), F.col("id")).alias("k"), "id")
        joined = shown.join(other.hint("merge"), "k", "left")
        assert plan_of(joined).count("Exchange hashpartitioning") == 1
        # A merged version keeps the buckets.
        upsert(batch(spark, ("b", 3, "y")), name, "k", ["t"], 3, 4)
        upsert(batch(spark, ("b", 4, "y")), name, "k", ["t"], 3, 4)
    files = [r[0] for r in spark.sql(f"SELECT DISTINCT _metadata.file_path FROM {data_table(name)}").collect()]
    assert len(files) <= 4 * spark.sql(f"SHOW PARTITIONS {data_table(name)}").count()


def test_what_was_upserted_since_a_version(spark, database):
    name = f"{database}.people"
    upsert(batch(spark, ("a", 1, "x"), ("b", 1, "x")), name, "k", ["t"], 3, 4)
    upsert(batch(spark, ("b", 2, "y")), name, "k", ["t"], 3, 4)
    upsert(batch(spark, ("b", 3, "z"), ("c", 3, "z")), name, "k", ["t"], 3, 4)

    def since(taken):
        found, last = versions_since(spark, name, "k", taken)
        return rows(found, "k", "v"), last

    assert since(0) == ([("a", "x"), ("b", "z"), ("c", "z")], 3)
    assert since(1) == ([("b", "z"), ("c", "z")], 3)
    assert since(3) == ([], 3)
    # The fourth version is merged with the others into a fifth: all rows count as new.
    upsert(batch(spark, ("d", 4, "w")), name, "k", ["t"], 3, 4)
    assert since(3) == ([("a", "x"), ("b", "z"), ("c", "z"), ("d", "w")], 5)
    upsert(batch(spark, ("d", 5, "v")), name, "k", ["t"], 3, 4)
    assert since(5) == ([("d", "v")], 6)


def test_a_table_says_how_much_of_its_source_it_holds(spark, database):
    name = f"{database}.people"
    assert taken_from_source(spark, name) == 0
    upsert(batch(spark, ("a", 1, "x")), name, "k", ["t"], 2, 4, taken=3)
    assert taken_from_source(spark, name) == 3
    for t in range(2, 5):
        upsert(batch(spark, ("a", t, "x")), name, "k", ["t"], 2, 4)
        assert taken_from_source(spark, name) == 3
    upsert(batch(spark, ("a", 9, "x")).limit(0), name, "k", ["t"], 2, 4, taken=7)
    assert taken_from_source(spark, name) == 7


# --- loads ------------------------------------------------------------------------------------


def test_loads_are_numbered_and_read_alone(spark, database):
    name = f"{database}.visits"
    days = ["2024-01-01", "2024-01-02", "2024-01-02"]
    assert [append_load(batch(spark, (d, i, "x")), name, d) for i, d in enumerate(days)] == [1, 2, 3]
    assert loads(spark, name) == [1, 2, 3]
    new, last = loads_since(spark, name, 1)
    assert last == 3 and rows(new) == [("2024-01-02", 1, "x"), ("2024-01-02", 2, "x")]
    assert new.columns == ["k", "t", "v"]
    plan = plan_of(new)
    assert "PartitionFilters: [isnotnull(_load" in plan and "(_load#" in plan
    files = new.select(F.input_file_name().alias("f")).distinct().collect()
    assert all("_load_day=2024-01-02" in r["f"] for r in files)
    assert plan_of(spark.table(name).where("_load_day = DATE '2024-01-02'")).count("_load_day") > 0
    assert loads_since(spark, name, 3)[0].isEmpty()


def test_a_load_that_died_is_replaced(spark, database, tmp_path):
    name = f"{database}.visits"
    append_load(batch(spark, ("a", 1, "x")), name, "2024-01-01")
    # Files of a second load that was never entered in the catalog.
    left = f"{tmp_path}/db/visits/_load_day=2024-01-02/_load=2"
    batch(spark, ("dead", 1, "x")).write.parquet(left)
    assert append_load(batch(spark, ("b", 2, "y")), name, "2024-01-02") == 2
    assert rows(spark.table(name), "k") == [("a",), ("b",)]


def test_loads_of_other_columns_are_refused(spark, database):
    name = f"{database}.visits"
    append_load(batch(spark, ("a", 1, "x")), name, "2024-01-01")
    with pytest.raises(ValueError, match="columns"):
        append_load(batch(spark, ("a", 1, "x")).drop("v"), name, "2024-01-01")
    assert append_load(batch(spark, ("a", 1, "x")).limit(0), name, "2024-01-01") == 2


def test_ties_are_settled_by_values(spark):
    found = spark.createDataFrame([("a", 1, "x", None), ("a", 1, "y", 1), ("a", 1, "y", 2), ("a", 0, "z", 9)], "k string, t int, v string, n int")
    for partitions in (1, 3):
        kept = latest_by(found.repartition(partitions), ["k"], ["t"])
        assert rows(kept) == [("a", 1, "y", 2)]
    maps = found.withColumn("m", F.create_map(F.lit("x"), F.col("n")))
    assert latest_by(maps, ["k"], ["t"]).first()["n"] == 2
