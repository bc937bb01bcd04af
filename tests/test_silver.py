"""Silver models against brute force, and against the shapes that break naive plans."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from caretiers.functions import match_key
from caretiers.operators.enrich import (
    clean_encounters,
    enrich_encounters,
    fill_defaults,
    normalize_codes,
    typed_costs,
    with_duration,
)
from caretiers.operators.golden import golden_patients, standardize_csv_patients
from caretiers.operators.latest import latest_by
from caretiers.operators.recent import recent
from caretiers.plans.silver import silver_encounters, silver_patients
from caretiers.schemas import SILVER_ENCOUNTER_COLUMNS, SILVER_PATIENT_COLUMNS

from conftest import plan_of, rows

START = datetime(2024, 1, 1)
API_PATIENT = (
    "patient_id string, first_name string, last_name string, phone string, city string, "
    "daly string, _ingestion_timestamp timestamp"
)
CSV_PATIENT = (
    "id string, first string, last string, phone string, city string, income string, "
    "birthplace string, _ingestion_timestamp timestamp"
)
API_ENCOUNTER = (
    "encounter_id string, status string, patient_id string, patient_name string, "
    "start_time string, end_time string, encounter_class string, encounter_type string, "
    "encounter_type_code string, provider_name string, organization_name string, "
    "reason_code string, reason_description string, _ingestion_timestamp timestamp"
)
CSV_ENCOUNTER = (
    "id string, payer string, provider string, encounterclass string, "
    "base_encounter_cost string, total_claim_cost string, payer_coverage string, "
    "_ingestion_timestamp timestamp"
)


def at(minutes):
    return START + timedelta(minutes=minutes)


def encounter(id, time, start="2020-01-01T10:00:00Z", end="2020-01-01T10:30:00Z", **more):
    values = dict(
        encounter_id=id, status="finished", patient_id="p", patient_name="P", start_time=start,
        end_time=end, encounter_class=" amb ", encounter_type="t", encounter_type_code="tc",
        provider_name="d", organization_name="o", reason_code=None, reason_description=None,
        _ingestion_timestamp=at(time),
    )
    values.update(more)
    return tuple(values.values())


def bill(id, time, total="10", coverage="5", base="1", payer="Pay"):
    return (id, payer, "prov", "amb", base, total, coverage, at(time))


def encounters(spark, *found):
    return spark.createDataFrame(list(found), API_ENCOUNTER)


def bills(spark, *found):
    return spark.createDataFrame(list(found), CSV_ENCOUNTER)


# --- latest -----------------------------------------------------------------------------------


def test_latest_keeps_one_row_per_key_and_one_for_no_key(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), (None, 1, "n1"), (None, 3, "n2"), ("b", None, "z")],
        "k string, t int, v string",
    )
    assert rows(latest_by(df, ["k"], ["t"])) == [(None, 3, "n2"), ("a", 2, "y"), ("b", None, "z")]


def test_ties_do_not_depend_on_partitioning(spark):
    df = spark.createDataFrame([("a", 1, str(i)) for i in range(200)], "k string, t int, v string")
    found = {latest_by(df.repartition(n), ["k"], ["t"]).first()["v"] for n in (1, 3, 7)}
    assert len(found) == 1
    assert latest_by(df, ["k"], ["t"], ["v"]).first()["v"] == "99"


def test_rank_limit_comes_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 1)], "k string, t int")
    plan = plan_of(latest_by(df, ["k"], ["t"]))
    final, exchange, partial = (plan.index(t) for t in (", Final", "Exchange", ", Partial"))
    assert final < exchange < partial and plan.count("Exchange") == 1


# --- window -----------------------------------------------------------------------------------


def test_recent_reaches_back_to_yesterday_midnight(spark):
    df = spark.createDataFrame(
        [(1, datetime(2023, 12, 31, 23, 59, 59)), (2, datetime(2024, 1, 1)), (3, None),
         (4, datetime(2024, 1, 5))],
        "id int, _ingestion_timestamp timestamp",
    )
    assert rows(recent(df, "2024-01-02"), "id") == [(2,), (4,)]
    assert recent(df.withColumn("_ingestion_timestamp", F.current_timestamp())).count() == 4


# --- patients ---------------------------------------------------------------------------------


def test_birthplace_and_names(spark):
    df = spark.createDataFrame(
        [("1", "Boston  Massachusetts  US"), ("2", "Boston  Massachusetts"), ("3", "Boston"),
         ("4", None), ("5", "New York  NY   US")],
        "Id string, birthplace string",
    )
    got = rows(
        standardize_csv_patients(df), "patient_id", "birth_city", "birth_state", "birth_country"
    )
    assert got == [
        ("1", "Boston", "Massachusetts", "US"), ("2", "Boston", "Massachusetts", None),
        ("3", "Boston", None, None), ("4", None, None, None), ("5", "New York", "NY", "US"),
    ]


def test_match_key_skips_missing_parts_and_case(spark):
    df = spark.createDataFrame(
        [("A", None, "x"), ("a", "x", None), ("b", "x", None)], "f string, l string, d string"
    )
    keys = [r[0] for r in df.select(match_key(["f", "l", "d"], lower=["f"])).collect()]
    assert keys[0] == keys[1] != keys[2] and len(keys[0]) == 64


def brute_force_golden(api, csv):
    """All pairs of versions, newest pair per id; rows without id pair with nothing."""
    pairs = []
    for a in api:
        partners = [c for c in csv if a[0] is not None and c[0] == a[0]] or [None]
        pairs += [(a, c) for c in partners]
    pairs += [(None, c) for c in csv if c[0] is None or all(a[0] != c[0] for a in api)]
    best = {}
    for a, c in pairs:
        key = a[0] if a else c[0]
        order = ((a or c)[-1], c[-1] if c else datetime.min)
        if key not in best or order > best[key][0]:
            best[key] = (order, a, c)

    def first(*values):
        return next((v for v in values if v is not None), None)

    return sorted(
        (
            (
                key,
                first(a and a[1], c and c[1]),
                first(a and a[2], c and c[2]),
                a and a[3],
                first(a and a[4], c and c[4]),
                c and c[5],
                a and a[5],
                (a or c)[-1],
            )
            for key, (_, a, c) in best.items()
        ),
        key=lambda r: [(v is not None, v) for v in r],
    )


@pytest.mark.parametrize("seed", range(4))
def test_golden_records_equal_brute_force(spark, seed):
    rnd = random.Random(seed)
    times = rnd.sample(range(10_000), 80)
    ids = [None, "", "a", "b", "c", "d", "e", "f"]

    def value(*some):
        return rnd.choice([None, *some])

    api = [
        (rnd.choice(ids), value("A", "B"), value("C"), value("555"), value("X", "Y"), value("1.5"),
         at(times[i]))
        for i in range(40)
    ]
    csv = [
        (rnd.choice([*ids, "g"]), value("a", "b"), value("c"), "never", value("x"), value("100"),
         None, at(times[40 + i]))
        for i in range(rnd.choice([0, 40]))
    ]
    got = golden_patients(
        spark.createDataFrame(api, API_PATIENT),
        standardize_csv_patients(spark.createDataFrame(csv, CSV_PATIENT)),
    )
    assert rows(
        got, "patient_id", "first_name", "last_name", "phone", "city", "income", "daly",
        "ingestion_time",
    ) == brute_force_golden(api, csv)


def test_golden_plan_shuffles_each_side_once(spark):
    api = spark.createDataFrame([], API_PATIENT)
    csv = standardize_csv_patients(spark.createDataFrame([], CSV_PATIENT))
    plan = plan_of(golden_patients(api, csv))
    assert plan.count("Exchange") == 2 and "FullOuter" in plan


def test_a_patient_with_very_many_versions(spark):
    """A third of either side is one patient; joined versions would be a hundred million pairs."""
    hot = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
    when = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id"))
    api = spark.range(30_000).select(
        hot.alias("patient_id"), F.lit("A").alias("first_name"),
        F.col("id").cast("string").alias("last_name"), when.alias("_ingestion_timestamp"),
    )
    csv = api.withColumnsRenamed({"patient_id": "id", "first_name": "first", "last_name": "last"})
    got = golden_patients(api, standardize_csv_patients(csv))
    assert got.count() == 20_001
    assert got.where("patient_id = 'hot'").first()["last_name"] == "29997"


def test_silver_patients_columns(spark):
    api = spark.createDataFrame([("a", "A", "B", "1", "X", "2.5", at(5))], API_PATIENT)
    csv = spark.createDataFrame([("a", "a", "b", "9", "x", "7", "P  Q  R", at(1))], CSV_PATIENT)
    got = silver_patients(api, csv, "2024-01-02", at(99))
    assert tuple(got.columns) == SILVER_PATIENT_COLUMNS
    row = got.first()
    assert (row["birth_city"], row["record_type"], row["silver_load_time"]) == (
        "P", "golden_record", at(99),
    )
    assert silver_patients(api, csv, "2024-01-03", at(99)).count() == 0


# --- encounters -------------------------------------------------------------------------------


def test_types_codes_and_defaults(spark):
    got = clean_encounters(
        encounters(spark, encounter("e", 1, reason_code=" r1 ", start="2020-01-01T10:00:00-05:00",
                                    end="2020-01-01T15:00:59.9Z")),
        bills(spark),
    ).first()
    assert got["start_time"] == datetime(2020, 1, 1, 15)
    assert got["encounter_duration_minutes"] == 59 / 60
    assert (got["encounter_class_code"], got["reason_code"]) == ("AMB", "R1")
    assert got["reason_description"] == "UNKNOWN"
    assert (got["base_encounter_cost"], got["total_claim_cost"], got["payer_coverage"]) == (0, 0, 0)
    assert got["payer"] is None


@pytest.mark.parametrize(
    "end, kept",
    [("2020-01-01T10:00:00Z", True), ("2020-01-01T09:59:59Z", False), (None, False),
     ("nonsense", False)],
)
def test_durations_that_count(spark, end, kept):
    got = clean_encounters(encounters(spark, encounter("e", 1, end=end)), bills(spark))
    assert (got.count() == 1) is kept


@pytest.mark.parametrize(
    "total, coverage, kept",
    [("10", "10", True), ("10", "10.01", False), ("-1", "-2", False), ("text", "0", True),
     ("text", "1", False), ("NaN", "0", True), (None, None, True), ("5", "NaN", True)],
)
def test_costs_that_count(spark, total, coverage, kept):
    got = clean_encounters(
        encounters(spark, encounter("e", 1)), bills(spark, bill("e", 1, total, coverage))
    )
    assert (got.count() == 1) is kept


def test_older_valid_version_survives_a_bad_newer_one(spark):
    api = encounters(
        spark, encounter("e", 1, status="old"), encounter("e", 2, status="new", end=None)
    )
    csv = bills(spark, bill("e", 1, payer="good"), bill("e", 2, coverage="99", payer="bad"))
    got = clean_encounters(api, csv).collect()
    assert [(r["status"], r["payer"]) for r in got] == [("old", "good")]


def test_only_bad_bills_are_not_the_same_as_no_bill(spark):
    api = encounters(spark, encounter("e", 1), encounter("f", 1), encounter(None, 1))
    got = clean_encounters(api, bills(spark, bill("e", 1, coverage="99"), bill(None, 1)))
    assert rows(got, "encounter_id") == [("f",)]


def brute_force_encounters(api, csv):
    def number(text):
        return 0.0 if text is None else float(text)

    best = {}
    for a in api:
        partners = [c for c in csv if a[0] is not None and c[0] == a[0]] or [None]
        for c in partners:
            total, coverage = (number(c[5]), number(c[6])) if c else (0.0, 0.0)
            if a[0] is None or a[5] is None or a[5] < a[4] or total < 0 or coverage > total:
                continue
            order = (a[-1], c[-1] if c else datetime.min)
            if a[0] not in best or order > best[a[0]][0]:
                best[a[0]] = (order, (a[0], a[1], c[1] if c else None, total, coverage))
    return sorted(v for _, v in best.values())


@pytest.mark.parametrize("seed", range(4))
def test_encounters_equal_brute_force(spark, seed):
    rnd = random.Random(seed)
    ids = [None, *"abcdefghij"]
    times = rnd.sample(range(10_000), 120)
    api = [
        encounter(rnd.choice(ids), times[i], status=str(i),
                  end=rnd.choice([None, "2020-01-01T09:00:00Z", "2020-01-01T11:00:00Z"]))
        for i in range(60)
    ]
    csv = [
        bill(rnd.choice([*ids[:6], "z"]), times[60 + i], total=rnd.choice([None, "-1", "5", "10"]),
             coverage=rnd.choice([None, "0", "4", "7"]), payer=str(i))
        for i in range(60)
    ]
    got = clean_encounters(encounters(spark, *api), bills(spark, *csv))
    expected = brute_force_encounters(api, csv)
    assert rows(
        got, "encounter_id", "status", "payer", "total_claim_cost", "payer_coverage"
    ) == sorted(expected, key=lambda r: [(v is not None, v) for v in r])


def test_encounter_plan_shuffles_each_side_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(clean_encounters(encounters(spark, encounter("e", 1)),
                                        bills(spark, bill("e", 1))))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 2 and "SortMergeJoin" in plan
    assert "Python" not in plan


def test_an_encounter_with_very_many_versions(spark):
    hot = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
    when = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id"))
    base = encounters(spark, encounter("x", 1)).drop("encounter_id", "_ingestion_timestamp")
    ids = spark.range(30_000).select(hot.alias("encounter_id"), when.alias("_ingestion_timestamp"))
    api = ids.join(F.broadcast(base.withColumn("one", F.lit(1))), F.lit(1) == F.col("one"))
    csv = ids.select(
        F.col("encounter_id").alias("id"), F.lit("p").alias("payer"), F.lit("q").alias("provider"),
        F.lit("c").alias("encounterclass"), F.lit("1").alias("base_encounter_cost"),
        F.lit("3").alias("total_claim_cost"), F.lit("2").alias("payer_coverage"),
        "_ingestion_timestamp",
    )
    got = clean_encounters(api, csv)
    assert got.count() == 20_001


def test_silver_encounters_columns(spark):
    got = silver_encounters(
        encounters(spark, encounter("e", 1)), bills(spark, bill("e", 2)), "2024-01-02", at(9)
    )
    assert tuple(got.columns) == SILVER_ENCOUNTER_COLUMNS
    assert dict(got.dtypes)["total_claim_cost"] == "double"
    assert got.first()["ingestion_time"] == at(1)


def test_single_steps(spark):
    api, csv = encounters(spark, encounter("e", 1)), bills(spark, bill("e", 1, total="x"))
    upper = csv.toDF(*[c.upper() for c in csv.columns])
    costs = typed_costs(upper)
    assert costs.columns[0] == "id" and costs.first()["total_claim_cost"] is None
    joined = enrich_encounters(with_duration(normalize_codes(api)), costs)
    assert joined.first()["encounter_duration_minutes"] == 30
    assert fill_defaults(joined).first()["total_claim_cost"] == 0
    assert fill_defaults(api).first()["reason_description"] == "UNKNOWN"
