"""One query per operator. Every query reads whole tables of the given scale factor."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from caretiers.config import DatasetConfig, Layers, PipelineConfig, remove_dir, scratch_dir, tune_session
from caretiers.operators import enrich
from caretiers.operators.flatten import (
    blank_missing,
    extension_columns,
    flatten_encounters,
    flatten_patients,
    identifier_columns,
)
from caretiers.operators.golden import (
    golden_patients,
    standardize_csv_patients,
    with_person_key,
)
from caretiers.operators.latest import latest_by
from caretiers.operators.quality import (
    check_accepted,
    check_freshness,
    check_not_null,
    check_range,
    check_unique,
    quality_filters,
)
from caretiers.operators.recent import recent
from caretiers.operators.upsert import data_table, upsert
from caretiers.plans import gold, silver
from caretiers.plans.pipeline import build_gold, build_silver, run_checks, run_pipeline
from caretiers.schemas import INGESTED_AT
from caretiers.sources.bundles import corrupt_entries, kept_entries, read_bundles, resources
from caretiers.sources.delimited import (
    REQUIRED_PATIENT_COLUMNS,
    csv_reader,
    malformed_records,
    read_csv_source,
    require_columns,
    require_non_empty,
    stamp,
)
from caretiers.sources.landing import CSV_WRITE_OPTIONS, land
from caretiers.sources.tables import append_load, append_table, loads_since, materialize_table
from caretiers.streaming.bronze import await_all, bronze_stream, run_all, run_bronze
from workload.frames import (
    DAY_1,
    DAY_2,
    DAY_3,
    encounter_bundles,
    frame,
    patient_bundles,
)

NOW_1 = datetime(2024, 1, 1, 23)
NOW_2 = datetime(2024, 1, 2, 23)
NOW_5 = datetime(2024, 1, 5, 23)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(tune_session(spark), sf_dir)

        QUERIES[name] = run
        return function

    return register


def first_load(df: DataFrame) -> DataFrame:
    """What had arrived at the end of day 1."""
    return df.where(F.col(INGESTED_AT) < F.lit(DAY_2).cast("timestamp"))


def second_load(df: DataFrame) -> DataFrame:
    return df.where(F.col(INGESTED_AT) >= F.lit(DAY_2).cast("timestamp"))


def new_database(spark: SparkSession) -> str:
    name = f"care_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_dir(spark, name)}'")
    return name


def store_of(spark: SparkSession, path: str):
    """The file system that a path lives on."""
    return spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())


def zone(spark: SparkSession, database: str, root: str, name: str, **more) -> DatasetConfig:
    return DatasetConfig(
        name=name,
        source_path=f"{root}/landing/{name}",
        checkpoint_path=f"{root}/checkpoints/{name}",
        target_table=f"{database}.raw_{name}",
        **more,
    )


# --- sources ----------------------------------------------------------------------------------


def patient_resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "fhir-patients")
    patient_bundles(frame(spark, sf_dir, "pat_api")).write.json(path)
    return resources(read_bundles(spark, path, "Patient", multiline=False), "Patient")


@query("fhir_patients")
def fhir_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = blank_missing(flatten_patients(patient_resources(spark, sf_dir)))
    # File names differ from run to run; that every row has one is shown instead.
    flat = flat.withColumn("has_file", F.col("source_file").endswith(".json")).drop("source_file")
    return stamp(flat, "api_fhir_patients", NOW_1)


@query("fhir_identifiers")
def fhir_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = identifier_columns("r.identifier")
    return patient_resources(spark, sf_dir).select(
        F.col("r.id").alias("patient_id"), *[c.alias(n) for n, c in columns.items()]
    )


@query("fhir_extensions")
def fhir_extensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = extension_columns("r.extension")
    return patient_resources(spark, sf_dir).select(
        F.col("r.id").alias("patient_id"), *[c.alias(n) for n, c in columns.items()]
    )


@query("fhir_encounters")
def fhir_encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "fhir-encounters")
    encounter_bundles(frame(spark, sf_dir, "enc_api")).write.json(path)
    found = resources(read_bundles(spark, path, "Encounter", multiline=False), "Encounter")
    return blank_missing(flatten_encounters(found, DAY_2))


@query("csv_source_patients")
def csv_source_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "csv-patients")
    rows = frame(spark, sf_dir, "pat_csv").drop(INGESTED_AT)
    upper = rows.toDF(*[c.upper() for c in rows.columns])
    upper.write.options(**CSV_WRITE_OPTIONS).csv(path)
    return read_csv_source(spark, path)


@query("landing_roundtrip")
def landing_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "landing")
    rows = frame(spark, sf_dir, "enc_api")
    land(first_load(rows).drop(INGESTED_AT), root, DAY_1)
    land(first_load(rows).drop(INGESTED_AT), root, DAY_2)
    land(second_load(rows).drop(INGESTED_AT), root, DAY_2)
    landed = csv_reader(spark).csv(root)
    return landed.withColumn("load_date", F.col("load_date").cast("string"))


# --- bronze -----------------------------------------------------------------------------------


def without_paths(bronze: DataFrame) -> DataFrame:
    """Bronze rows with the file path, which differs from run to run, reduced to a fact about it."""
    in_day = F.col("_source_file").contains(F.concat(F.lit("load_date="), "load_date"))
    return bronze.withColumn("from_day", in_day).drop("_source_file", "_batch", "_malformed_record")


@query("bronze_incremental")
def bronze_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = zone(spark, new_database(spark), scratch_dir(spark, "bronze"), "encounters")
    rows = frame(spark, sf_dir, "enc_api")
    land(first_load(rows).drop(INGESTED_AT), config.source_path, DAY_1)
    run_all(spark, [config], NOW_1)
    land(second_load(rows).drop(INGESTED_AT), config.source_path, DAY_2)
    run_all(spark, [config], NOW_2)
    run_all(spark, [config], NOW_2)
    return without_paths(spark.table(config.target_table))


@query("bronze_archive")
def bronze_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files leave the zone when later ones are taken in; bronze has the rows of all of them."""
    root = scratch_dir(spark, "bronze")
    config = zone(spark, new_database(spark), root, "encounters", archive_path=f"{root}/archive")
    rows = frame(spark, sf_dir, "enc_api")
    land(first_load(rows).drop(INGESTED_AT), config.source_path, DAY_1)
    run_all(spark, [config], NOW_1)
    land(second_load(rows).drop(INGESTED_AT), config.source_path, DAY_2)
    run_all(spark, [config], NOW_2)
    run_all(spark, [config], NOW_2)
    left = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(config.source_path)
    days = [r[0] for r in left.select(F.col("load_date").cast("string")).distinct().collect()]
    return without_paths(spark.table(config.target_table)).withColumn("days_in_zone", F.lit(",".join(days)))


@query("bronze_run_metrics")
def bronze_run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per zone and run as the runs counted them; that files are counted is shown as a fact."""
    database, root = new_database(spark), scratch_dir(spark, "bronze")
    configs = {name: zone(spark, database, root, name) for name in ("pat_api", "enc_api")}
    for day, now, load in ((DAY_1, NOW_1, first_load), (DAY_2, NOW_2, second_load)):
        for name, config in configs.items():
            land(load(frame(spark, sf_dir, name)).drop(INGESTED_AT), config.source_path, day)
        run_all(spark, configs.values(), now, f"{database}.run_metrics")
    found = spark.table(f"{database}.run_metrics")
    return found.groupBy("zone", "ingested_at").agg(
        F.sum("n_rows").alias("n_rows"), (F.sum("files") > 0).alias("has_files")
    )


@query("bronze_fixed_layout")
def bronze_fixed_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frame(spark, sf_dir, "enc_api").drop(INGESTED_AT)
    config = zone(
        spark, new_database(spark), scratch_dir(spark, "bronze"), "encounters",
        columns=tuple(rows.columns),
    )
    land(rows, config.source_path, DAY_1)
    for _ in range(2):
        stream = bronze_stream(spark, config, NOW_1)
        await_all([run_bronze(stream, config.target_table, config.checkpoint_path)])
    return without_paths(spark.table(config.target_table))


@query("bronze_all_zones")
def bronze_all_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    database, root = new_database(spark), scratch_dir(spark, "bronze")
    keys = {"pat_api": "patient_id", "pat_csv": "id", "enc_api": "encounter_id", "enc_csv": "id"}
    configs = {name: zone(spark, database, root, name) for name in keys}
    for name, config in configs.items():
        land(frame(spark, sf_dir, name).drop(INGESTED_AT), config.source_path, DAY_1)
    run_all(spark, configs.values(), NOW_1)
    found = None
    for name, config in configs.items():
        columns = frame(spark, sf_dir, name).drop(INGESTED_AT).columns
        rows = spark.table(config.target_table).select(
            F.lit(name).alias("zone"), F.col(keys[name]).alias("key"), "load_date",
            F.concat_ws("|", *columns).alias("content"),
        )
        found = rows if found is None else found.unionAll(rows)
    return found


@query("bronze_old_files")
def bronze_old_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files dated 1970 beside new ones, before and after a first run: all of them are taken in."""
    config = zone(spark, new_database(spark), scratch_dir(spark, "bronze"), "encounters")
    rows = frame(spark, sf_dir, "enc_api")
    for day, load, now in ((DAY_1, first_load, NOW_1), (DAY_2, second_load, NOW_2)):
        found = load(rows).drop(INGESTED_AT).withColumn("old", F.col("patient_id") < "P5")
        land(found.where("old").drop("old"), f"{config.source_path}/old", day)
        land(found.where("not coalesce(old, false)").drop("old"), f"{config.source_path}/new", day)
        store = store_of(spark, config.source_path)
        files = spark._jvm.org.apache.hadoop.fs.Path(f"{config.source_path}/old/load_date={day}")
        for status in store.listStatus(files):
            store.setTimes(status.getPath(), 0, -1)
        run_all(spark, [config], now)
    return spark.table(config.target_table).drop("_source_file", "_batch", "_malformed_record")


@query("landing_line_breaks")
def landing_line_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values with line breaks, quotes and commas from landing files to bronze."""
    config = zone(spark, new_database(spark), scratch_dir(spark, "bronze"), "encounters")
    rows = frame(spark, sf_dir, "enc_api").drop(INGESTED_AT)
    text = F.concat_ws("\n", "reason_description", F.lit('said "a, b"'), "status")
    land(rows.withColumn("reason_description", text), config.source_path, DAY_1)
    run_all(spark, [config], NOW_1)
    return without_paths(spark.table(config.target_table))


@query("csv_malformed_rows")
def csv_malformed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extract in which some records have surplus or missing fields: none of them gets lost."""
    path = scratch_dir(spark, "csv-malformed")
    rows = frame(spark, sf_dir, "enc_csv")
    line = F.concat_ws(",", F.coalesce("id", F.lit("")), F.coalesce("payer", F.lit("")))
    line = F.when(F.col("id").endswith("7"), F.concat(line, F.lit(",EXTRA,MORE"))).when(
        F.col("id").endswith("3"), F.coalesce("id", F.lit(""))
    ).otherwise(line)
    # Every file needs its header, so a line of it stands in front of each partition's rows.
    rows.select(line.alias("id,payer")).write.option("header", True).options(
        quote="", sep="\t"
    ).csv(path)
    good = read_csv_source(spark, path).select("id", "payer", F.lit(None).cast("string").alias("content"))
    bad = malformed_records(spark, path)
    none = F.lit(None).cast("string")
    return good.unionByName(bad.select(none.alias("id"), none.alias("payer"), "content"))


@query("fhir_layouts")
def fhir_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bundle per line: all of them are read, and reading files as one document each is refused."""
    lines = scratch_dir(spark, "fhir-lines")
    patient_bundles(frame(spark, sf_dir, "pat_api")).coalesce(1).write.json(lines)
    try:
        read_bundles(spark, lines, "Patient")
        refused = False
    except ValueError:
        refused = True
    found = resources(read_bundles(spark, lines, "Patient", multiline=False), "Patient")
    return found.select(F.col("r.id").alias("patient_id"), F.lit(refused).alias("refused"))


@query("fhir_quarantine")
def fhir_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every patient a cut-off bundle among the good ones, and a bad entry inside the good one.

    Good entries come out whole, bad ones with what can be read of them and their own text.
    """
    path = scratch_dir(spark, "fhir-corrupt")
    api = frame(spark, sf_dir, "pat_api")
    bundles = patient_bundles(api)
    # An entry is taken out of the array's beginning to stand behind a bad one.
    mrn = F.get(F.get("entry", F.lit(1))["resource"]["identifier"], F.lit(1))["value"]
    bad = F.format_string('{"resource":{"resourceType":"Patient","id":"bad-%s","telecom":"%s"}}', mrn, mrn)
    good = bundles.select(F.concat(F.lit('{"entry":['), bad, F.lit(","), F.substring(F.to_json("entry"), 2, 1 << 30), F.lit("}")).alias("value"))
    cut = F.concat(F.lit('{"resourceType": "Bundle", "entry": [{"id": "'), F.col("mrn"))
    lines = good.unionByName(api.select(cut.alias("value")))
    lines.write.text(path)
    for status in store_of(spark, path).listStatus(spark._jvm.org.apache.hadoop.fs.Path(path)):
        if status.getPath().getName().endswith(".txt"):
            named = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{status.getPath().getName()}.json")
            store_of(spark, path).rename(status.getPath(), named)
    read = kept_entries(read_bundles(spark, path, "Patient", multiline=False), scratch_dir(spark, "fhir-entries"))
    none = F.lit(None).cast("string")
    found = resources(read, "Patient").select(F.col("r.id").alias("patient_id"), none.alias("content"))
    return found.unionByName(corrupt_entries(read).select(none.alias("patient_id"), "content"))


@query("source_checks")
def source_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per check of a source with its outcome, for good and for bad input."""
    rows = frame(spark, sf_dir, "pat_csv").drop(INGESTED_AT)
    path = scratch_dir(spark, "csv-checks")
    rows.write.options(**CSV_WRITE_OPTIONS).csv(path)
    extract = read_csv_source(spark, path)
    folder = scratch_dir(spark, "fhir-names")
    patient_bundles(frame(spark, sf_dir, "pat_api")).write.json(folder)
    extract.select("id").write.mode("append").csv(folder)

    def outcome(check: Callable[[], DataFrame]) -> str:
        try:
            return str(check().count())
        except ValueError:
            return "refused"

    outcomes = {
        "rows": outcome(lambda: require_non_empty(extract, path)),
        "no_rows": outcome(lambda: require_non_empty(extract.limit(0), path)),
        "columns": outcome(lambda: require_columns(extract, REQUIRED_PATIENT_COLUMNS, path)),
        "column_missing": outcome(lambda: require_columns(extract.drop("first"), REQUIRED_PATIENT_COLUMNS, path)),
        "only_bundles": outcome(lambda: resources(read_bundles(spark, folder, "Patient", multiline=False), "Patient")),
    }
    return spark.createDataFrame(list(outcomes.items()), "check string, outcome string")


@query("gold_refresh_new_schema")
def gold_refresh_new_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A refresh whose second run has another column and a wider type."""
    table = f"{new_database(spark)}.costs"
    rows = frame(spark, sf_dir, "enc_csv")
    cost = F.expr("try_cast(total_claim_cost AS double)")
    materialize_table(rows.select("id", cost.cast("int").alias("cost")), table)
    materialize_table(rows.select("id", cost.alias("cost"), "payer"), table)
    return spark.table(table)


@query("upsert_after_failed_write")
def upsert_after_failed_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first upsert that writes its rows and dies before they are shown leaves nothing behind."""
    table = f"{new_database(spark)}.people"
    people = frame(spark, sf_dir, "pat_api").select("patient_id", "city", INGESTED_AT)
    crashed = people.withColumn("city", F.lit("crashed"))
    spark.sql(f"CREATE TABLE {data_table(table)} (patient_id STRING, city STRING, {INGESTED_AT} TIMESTAMP, _version INT) USING parquet PARTITIONED BY (_version)")
    crashed.withColumn("_version", F.lit(1)).write.insertInto(data_table(table))
    upsert(first_load(people), table, "patient_id", [INGESTED_AT])
    return spark.table(table)


@query("bronze_schema_evolution")
def bronze_schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = zone(spark, new_database(spark), scratch_dir(spark, "bronze"), "patients")
    rows = frame(spark, sf_dir, "pat_csv")
    land(rows.select("id", "first", "last"), config.source_path, DAY_1)
    run_all(spark, [config], NOW_1)
    land(rows.select("last", "zip", "id", "first"), config.source_path, DAY_2)
    run_all(spark, [config], NOW_2)
    return without_paths(spark.table(config.target_table))


@query("recent_window")
def recent_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recent(frame(spark, sf_dir, "enc_api"), DAY_3)


# --- silver -----------------------------------------------------------------------------------


@query("standardize_csv_patients")
def standardize_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardize_csv_patients(frame(spark, sf_dir, "pat_csv"))


@query("match_key")
def person_match_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    api = frame(spark, sf_dir, "pat_api")
    csv = standardize_csv_patients(frame(spark, sf_dir, "pat_csv"))
    keyed = [
        with_person_key(df).select(F.lit(name).alias("source"), "patient_id", "person_key")
        for name, df in (("api", api), ("csv", csv))
    ]
    return keyed[0].unionAll(keyed[1])


@query("golden_patients")
def golden_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return golden_patients(
        frame(spark, sf_dir, "pat_api"), standardize_csv_patients(frame(spark, sf_dir, "pat_csv"))
    )


def silver_patient_rows(
    spark: SparkSession, sf_dir: str, day: str = DAY_2, now: datetime = NOW_2
) -> DataFrame:
    api, csv = frame(spark, sf_dir, "pat_api"), frame(spark, sf_dir, "pat_csv")
    if day == DAY_1:
        api, csv = first_load(api), first_load(csv)
    return silver.silver_patients(api, csv, day, now)


def silver_encounter_rows(
    spark: SparkSession, sf_dir: str, day: str = DAY_2, now: datetime = NOW_2
) -> DataFrame:
    api, csv = frame(spark, sf_dir, "enc_api"), frame(spark, sf_dir, "enc_csv")
    if day == DAY_1:
        api, csv = first_load(api), first_load(csv)
    return silver.silver_encounters(api, csv, day, now)


@query("silver_patients")
def silver_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_patient_rows(spark, sf_dir)


def newest_billing(spark: SparkSession, sf_dir: str) -> DataFrame:
    billing = frame(spark, sf_dir, "enc_csv")
    return latest_by(enrich.typed_costs(billing), ["id"], [INGESTED_AT])


@query("enrich_encounters")
def enrich_encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = enrich.enrich_encounters(
        frame(spark, sf_dir, "enc_api"), newest_billing(spark, sf_dir)
    )
    return joined.select(
        "encounter_id", "patient_id", "start_time", INGESTED_AT, "payer", "provider",
        "base_encounter_cost", "total_claim_cost", "payer_coverage",
    )


@query("typed_costs")
def typed_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    billing = frame(spark, sf_dir, "enc_csv")
    upper = billing.toDF(*[c if c == INGESTED_AT else c.upper() for c in billing.columns])
    return enrich.typed_costs(upper)


@query("normalize_codes")
def normalize_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.normalize_codes(frame(spark, sf_dir, "enc_api"))


@query("fill_defaults")
def fill_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = enrich.enrich_encounters(
        frame(spark, sf_dir, "enc_api"), newest_billing(spark, sf_dir)
    )
    return enrich.fill_defaults(joined).select(
        "encounter_id", INGESTED_AT, "reason_code", "reason_description", "payer",
        "base_encounter_cost", "total_claim_cost", "payer_coverage",
    )


@query("encounter_duration")
def encounter_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = enrich.with_duration(enrich.normalize_codes(frame(spark, sf_dir, "enc_api")))
    return timed.select("encounter_id", INGESTED_AT, "start_time", "encounter_duration_minutes")


@query("dq_filters")
def dq_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = enrich.with_duration(enrich.normalize_codes(frame(spark, sf_dir, "enc_api")))
    joined = enrich.enrich_encounters(timed, newest_billing(spark, sf_dir))
    return quality_filters(enrich.fill_defaults(joined)).select(
        "encounter_id", INGESTED_AT, "encounter_duration_minutes", "total_claim_cost",
        "payer_coverage",
    )


@query("dedup_latest")
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frame(spark, sf_dir, "enc_csv")
    return latest_by(rows, ["id"], [INGESTED_AT])


@query("silver_encounters")
def silver_encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_encounter_rows(spark, sf_dir)


@query("silver_append_two_runs")
def silver_append_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = f"{new_database(spark)}.silver_encounters"
    append_table(silver_encounter_rows(spark, sf_dir, DAY_1, NOW_1), table)
    append_table(silver_encounter_rows(spark, sf_dir, DAY_2, NOW_2), table)
    return spark.table(table)


@query("silver_new_loads")
def silver_new_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is new in silver since its first load."""
    table = f"{new_database(spark)}.silver_encounters"
    append_load(silver_encounter_rows(spark, sf_dir, DAY_1, NOW_1), table, DAY_1)
    append_load(silver_encounter_rows(spark, sf_dir, DAY_2, NOW_2), table, DAY_2)
    found, last = loads_since(spark, table, 1)
    return found.withColumn("last_load", F.lit(last))


@query("silver_upsert_two_runs")
def silver_upsert_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = f"{new_database(spark)}.silver_encounters"
    order = ["ingestion_time"]
    upsert(silver_encounter_rows(spark, sf_dir, DAY_1, NOW_1), table, "encounter_id", order, 8, 8)
    upsert(silver_encounter_rows(spark, sf_dir, DAY_2, NOW_2), table, "encounter_id", order, 8, 8)
    return spark.table(table)


# --- gold -------------------------------------------------------------------------------------


@query("gold_dim_patient")
def gold_dim_patient(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = silver_patient_rows(spark, sf_dir, DAY_1, NOW_1).unionByName(
        silver_patient_rows(spark, sf_dir, DAY_2, NOW_2)
    )
    return gold.dim_patient(runs)


@query("upsert_dim_patient")
def upsert_dim_patient(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = f"{new_database(spark)}.dim_patient"
    for day, now in ((DAY_1, NOW_1), (DAY_2, NOW_2)):
        dim = gold.dim_patient(silver_patient_rows(spark, sf_dir, day, now))
        upsert(dim, table, "patient_id", ["ingestion_time"], 8, 8)
    return spark.table(table)


@query("dim_after_failed_run")
def dim_after_failed_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run of day 1 that dies after silver, and the next one only when its rows are not recent any
    more: the dimension has the people of both."""
    layers = Layers(*[new_database(spark)] * 3)
    feeds = {"raw_patients_api": "pat_api", "raw_patients_csv": "pat_csv", "raw_encounters_api": "enc_api", "raw_encounters_csv": "enc_csv"}
    for (day, now), load in ((DAY_1, NOW_1), first_load), ((DAY_3, NOW_5), second_load):
        for table, name in feeds.items():
            append_table(load(frame(spark, sf_dir, name)), f"{layers.bronze}.{table}")
        config = PipelineConfig(landing_root="", checkpoint_root="", layers=layers, buckets=8, now=now)
        build_silver(spark, config, day)
    build_gold(spark, config)
    return spark.table(f"{layers.gold}.dim_patient")


@query("gold_fact_encounter")
def gold_fact_encounter(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = f"{new_database(spark)}.fact_encounter"
    for day, now in ((DAY_1, NOW_1), (DAY_2, NOW_2)):
        materialize_table(
            gold.fact_encounter(silver_encounter_rows(spark, sf_dir, day, now)), table
        )
    return spark.table(table)


def rounded(mart: DataFrame) -> DataFrame:
    """Sums of doubles depend on their order in the last digits.

    Averages of cents often lie exactly between two roundings; a small shift settles those.
    """
    sums = {c: F.round(c, 2) for c in ("total_claim_cost", "total_payer_coverage")}
    averages = {
        c: F.round(F.col(c) + 0.000001, 4) for c in ("avg_claim_cost", "avg_encounter_duration")
    }
    return mart.withColumns({**sums, **averages})


@query("mart_patient_summary")
def mart_patient_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = gold.dim_patient(silver_patient_rows(spark, sf_dir))
    fact = gold.fact_encounter(silver_encounter_rows(spark, sf_dir))
    return rounded(gold.mart_patient_summary(dim, fact))


@query("mart_incremental")
def mart_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days with silver appended; each run adds its loads to the fact and to the patients that they,
    or the dimension, changed. A third run has nothing new and changes nothing."""
    layers = Layers(*[new_database(spark) for _ in range(3)])
    feeds = {"raw_patients_api": "pat_api", "raw_patients_csv": "pat_csv", "raw_encounters_api": "enc_api", "raw_encounters_csv": "enc_csv"}
    for (day, now), load in ((DAY_1, NOW_1), first_load), ((DAY_2, NOW_2), second_load):
        for table, name in feeds.items():
            append_table(load(frame(spark, sf_dir, name)), f"{layers.bronze}.{table}")
        config = PipelineConfig(
            landing_root="", checkpoint_root="", layers=layers, buckets=8, gold_mode="incremental", now=now
        )
        build_silver(spark, config, day)
        build_gold(spark, config)
    build_gold(spark, config)
    return rounded(spark.table(f"{layers.gold}.mart_patient_summary"))


# Records of a compressed file that stands for a feed: some 120 MB of bundles.
BUNDLES_PER_FILE = 100_000


@query("landing_to_mart")
def landing_to_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two daily runs from bundles and extracts to the mart, with silver appended as usual."""
    root = scratch_dir(spark, "pipeline")
    suffix = uuid.uuid4().hex
    layers = Layers(*[f"{layer}_{suffix}" for layer in ("bronze", "silver", "gold")])
    patients = frame(spark, sf_dir, "pat_api")
    visits = frame(spark, sf_dir, "enc_api")
    extracts = {
        "patients": frame(spark, sf_dir, "pat_csv").drop(INGESTED_AT),
        "encounters": frame(spark, sf_dir, "enc_bill"),
    }
    # Nothing but the run of their day reads the bundles. Files that cannot be split are kept small.
    compressed = {"compression": "gzip", "maxRecordsPerFile": BUNDLES_PER_FILE}
    for name, rows in extracts.items():
        rows.write.options(**CSV_WRITE_OPTIONS, **compressed).csv(f"{root}/{name}")
    mart = None
    for day, now, load in ((DAY_1, NOW_1, first_load), (DAY_2, NOW_2, second_load)):
        bundles = f"{root}/fhir-{day}"
        patient_bundles(load(patients)).write.options(**compressed).json(bundles)
        encounter_bundles(load(visits)).write.options(**compressed).mode("append").json(bundles)
        config = PipelineConfig(
            landing_root=f"{root}/landing",
            checkpoint_root=f"{root}/checkpoints",
            warehouse_root=f"{root}/warehouse",
            fhir_path=bundles,
            fhir_multiline=False,
            patients_csv=f"{root}/patients",
            encounters_csv=f"{root}/encounters",
            layers=layers,
            compact_after=8,
            buckets=8,
            now=now,
        )
        mart = run_pipeline(spark, config)
        remove_dir(spark, bundles)
    return rounded(mart)


# --- checks -----------------------------------------------------------------------------------


@query("pipeline_checks")
def pipeline_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks as a run makes them, over gold tables with the faults of the feeds."""
    layers = Layers(*[new_database(spark)] * 3)
    config = PipelineConfig(landing_root="", checkpoint_root="", layers=layers)
    dim = gold.dim_patient(silver_patient_rows(spark, sf_dir))
    upsert(dim, f"{layers.gold}.dim_patient", "patient_id", ["ingestion_time"], buckets=8)
    days = [silver_encounter_rows(spark, sf_dir, *day) for day in ((DAY_1, NOW_1), (DAY_2, NOW_2))]
    materialize_table(gold.fact_encounter(days[0].unionByName(days[1])), f"{layers.gold}.fact_encounter")
    run_checks(spark, config)
    return spark.table(f"{layers.gold}.failed_checks")


@query("check_not_null")
def check_missing_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = gold.dim_patient(silver_patient_rows(spark, sf_dir))
    return check_not_null(dim, ["patient_id", "full_name"])


@query("check_unique")
def check_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_unique(frame(spark, sf_dir, "enc_csv"), ["id"])


@query("check_range")
def check_value_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    costs = enrich.typed_costs(frame(spark, sf_dir, "enc_csv"))
    return check_range(costs, "total_claim_cost", low=0, high=300000)


@query("check_accepted")
def check_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_accepted(frame(spark, sf_dir, "pat_csv"), "birthplace", ["ONLINE", "ONLINE  WEB"])


@query("check_freshness")
def check_load_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = silver_encounter_rows(spark, sf_dir)
    return check_freshness(rows, "ingestion_time", max_age_hours=12, now=NOW_2)
