"""One run from source files to the mart."""

from __future__ import annotations

import logging
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from caretiers.config import PipelineConfig, free_shuffles, remove_dir, scratch_dir
from caretiers.operators.flatten import blank_missing, flatten_encounters, flatten_patients
from caretiers.operators.quality import gold_checks
from caretiers.operators.upsert import upsert, versions_since
from caretiers.plans.gold import (
    add_sums,
    dim_patient,
    fact_encounter,
    mart_of_sums,
    mart_patient_summary,
    patient_sums,
)
from caretiers.plans.silver import silver_encounters, silver_patients
from caretiers.sources.bundles import stage_resources
from caretiers.sources.delimited import (
    REQUIRED_ENCOUNTER_COLUMNS,
    REQUIRED_PATIENT_COLUMNS,
    malformed_records,
    read_csv_source,
    require_columns,
    require_non_empty,
    stamp,
)
from caretiers.sources.landing import land
from caretiers.sources.tables import (
    append_load,
    load_days,
    loads,
    loads_since,
    materialize_table,
    rows_of_load,
    scan,
    taken_from_source,
    taken_from_sources,
)
from caretiers.streaming.bronze import run_all

log = logging.getLogger(__name__)

# Name of each feed in the landing files.
FEEDS = {
    "api/patients": "api_fhir_patients",
    "api/encounters": "api_fhir_encounters",
    "csv/patients": "csv_patients",
    "csv/encounters": "csv_encounters",
}


def side_by_side(*jobs: Callable[[], None]) -> None:
    """Run independent jobs at the same time; the first failure is raised after all have ended."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        for outcome in [pool.submit(job) for job in jobs]:
            outcome.result()


def set_aside(
    rows: DataFrame, config: PipelineConfig, feed: str, load_date: date | str | None
) -> None:
    """Keep records that could not be read, by feed and day; a repeated day replaces itself."""
    day = str(load_date or datetime.now(timezone.utc).date())
    quarantine = f"{config.landing_root}/quarantine/feed={feed}/load_date={day}"
    rows.write.mode("overwrite").json(quarantine)
    if not rows.sparkSession.read.schema("content string").json(quarantine).isEmpty():
        log.warning("some records of %s could not be read and were set aside in %s", feed, quarantine)


def read_fhir(
    spark: SparkSession, config: PipelineConfig, staging: str, load_date: date | str | None
) -> dict[str, DataFrame]:
    """Flat records of both resource types; bundles and entries that cannot be read are set aside."""
    staged = stage_resources(spark, config.fhir_path, staging, config.fhir_multiline)
    corrupt = staged.where("content IS NOT NULL").select("source_file", "at", "content")
    set_aside(corrupt, config, "bundles", load_date)
    patients = flatten_patients(staged.where("kind = 'Patient'"))
    encounters = flatten_encounters(staged.where("kind = 'Encounter'"), load_date)
    return {"api/patients": blank_missing(patients), "api/encounters": blank_missing(encounters)}


def land_sources(spark: SparkSession, config: PipelineConfig, load_date: date | str | None) -> None:
    """Flatten, check and stamp the sources, and land each as files of the day."""
    frames: dict[str, DataFrame] = {}
    for zone, path, required in (
        ("csv/patients", config.patients_csv, REQUIRED_PATIENT_COLUMNS),
        ("csv/encounters", config.encounters_csv, REQUIRED_ENCOUNTER_COLUMNS),
    ):
        if path:
            rows = require_non_empty(read_csv_source(spark, path, config.multi_line), path)
            frames[zone] = require_columns(rows, required, path)
            bad = malformed_records(spark, path, config.multi_line)
            set_aside(bad, config, zone.replace("/", "_"), load_date)

    def landing(zone: str) -> Callable[[], None]:
        rows = stamp(frames[zone], FEEDS[zone], config.now)
        # Landed files stay, and one task reads each as a whole anyway.
        return lambda: land(rows, f"{config.landing_root}/{zone}", load_date, compression="gzip")

    staging = scratch_dir(spark, "resources")
    try:
        if config.fhir_path:
            frames.update(read_fhir(spark, config, staging, load_date))
        side_by_side(*[landing(zone) for zone in frames])
    finally:
        remove_dir(spark, staging)


def build_silver(spark: SparkSession, config: PipelineConfig, as_of: date | str | None) -> None:
    """Add the recent bronze loads to the silver tables."""
    bronze, silver = config.layers.bronze, config.layers.silver
    patients = silver_patients(
        scan(spark, f"{bronze}.raw_patients_api"),
        scan(spark, f"{bronze}.raw_patients_csv"),
        as_of,
        config.now,
    )
    encounters = silver_encounters(
        scan(spark, f"{bronze}.raw_encounters_api"),
        scan(spark, f"{bronze}.raw_encounters_csv"),
        as_of,
        config.now,
    )
    if config.silver_mode == "upsert":
        order, how = ["ingestion_time"], (config.compact_after, config.buckets)
        side_by_side(
            lambda: upsert(patients, f"{silver}.silver_patients", "patient_id", order, *how),
            lambda: upsert(encounters, f"{silver}.silver_encounters", "encounter_id", order, *how),
        )
    else:
        day = as_of or (config.now.date() if config.now else None)
        side_by_side(
            lambda: append_load(patients, f"{silver}.silver_patients", day),
            lambda: append_load(encounters, f"{silver}.silver_encounters", day),
        )


def new_silver_patients(spark: SparkSession, config: PipelineConfig) -> tuple[DataFrame, int]:
    """Silver patients that the dimension has not taken in yet, and the last load among them.

    The dimension says which load it holds. Loads of runs that died before gold are among the new ones,
    however long ago that was.
    """
    people = f"{config.layers.silver}.silver_patients"
    taken = taken_from_source(spark, f"{config.layers.gold}.dim_patient")
    if config.silver_mode == "upsert":
        return versions_since(spark, people, "patient_id", taken)
    return loads_since(spark, people, taken)


def add_to_fact_and_mart(spark: SparkSession, config: PipelineConfig) -> None:
    """Add the new silver loads to the fact, and bring the patients that they, or the dimension, changed
    up to date in the mart.

    Loads of the fact have the numbers of the silver loads they come from. Every table says, in the
    step that shows its rows, what it holds of the tables it comes from; so each step can be repeated,
    and a run takes in what earlier ones that died have left.
    """
    gold, how = config.layers.gold, (config.compact_after, config.buckets)
    visits, fact = f"{config.layers.silver}.silver_encounters", f"{gold}.fact_encounter"
    held = max(loads(spark, fact), default=0) if spark.catalog.tableExists(fact) else 0
    for number, day in load_days(spark, visits, held).items():
        append_load(fact_encounter(rows_of_load(spark, visits, number)), fact, day, number)

    totals = f"{gold}.patient_sums"
    new, last = loads_since(spark, fact, taken_from_source(spark, totals))
    sums = patient_sums(new)
    if spark.catalog.tableExists(totals):
        sums = add_sums(sums, scan(spark, totals))
    upsert(sums, totals, "patient_id", [], *how, last)

    mart, dim = f"{gold}.mart_patient_summary", f"{gold}.dim_patient"
    taken = taken_from_sources(spark, mart, 2)
    people, last_people = versions_since(spark, dim, "patient_id", taken[0])
    counted, last_counted = versions_since(spark, totals, "patient_id", taken[1])
    touched = people.select("patient_id").union(counted.select("patient_id")).distinct()
    touched = touched.withColumnRenamed("patient_id", "_touched")
    shown = scan(spark, dim).join(touched, F.col("patient_id").eqNullSafe(F.col("_touched")), "left_semi")
    upsert(
        mart_of_sums(shown, scan(spark, totals)), mart, "patient_id", [], *how,
        [last_people, last_counted],
    )


def refresh_fact_and_mart(spark: SparkSession, config: PipelineConfig) -> None:
    silver, gold = config.layers.silver, config.layers.gold
    fact = fact_encounter(scan(spark, f"{silver}.silver_encounters"))
    materialize_table(fact, f"{gold}.fact_encounter")
    mart = mart_patient_summary(
        scan(spark, f"{gold}.dim_patient"), scan(spark, f"{gold}.fact_encounter")
    )
    materialize_table(mart, f"{gold}.mart_patient_summary")


def build_gold(spark: SparkSession, config: PipelineConfig) -> None:
    """Upsert the dimension, rebuild the fact and the mart or add to them."""
    gold = config.layers.gold
    people, last = new_silver_patients(spark, config)
    upsert(
        dim_patient(people), f"{gold}.dim_patient", "patient_id", ["ingestion_time"],
        config.compact_after, config.buckets, last,
    )
    if config.gold_mode == "incremental":
        add_to_fact_and_mart(spark, config)
    else:
        refresh_fact_and_mart(spark, config)
    if config.checks:
        run_checks(spark, config)


def run_checks(spark: SparkSession, config: PipelineConfig) -> None:
    """Replace the table of failing gold rows and report whether there are any."""
    gold = config.layers.gold
    failed = gold_checks(scan(spark, f"{gold}.dim_patient"), scan(spark, f"{gold}.fact_encounter"))
    materialize_table(failed, f"{gold}.failed_checks")
    if not scan(spark, f"{gold}.failed_checks").isEmpty():
        log.warning("some rows of %s fail its checks, see failed_checks", gold)


def run_pipeline(
    spark: SparkSession, config: PipelineConfig, as_of: date | str | None = None
) -> DataFrame:
    """Land, ingest, and rebuild silver and gold; returns the summary mart.

    ``as_of`` is the day the run counts as (default: today, or the day of ``config.now``).
    """
    day = as_of or (config.now.date() if config.now else None)
    config.layers.create(spark, config.warehouse_root)
    land_sources(spark, config, day)
    run_all(spark, config.datasets(), config.now, f"{config.layers.bronze}.run_metrics")
    free_shuffles(spark)
    build_silver(spark, config, day)
    free_shuffles(spark)
    build_gold(spark, config)
    free_shuffles(spark)
    return scan(spark, f"{config.layers.gold}.mart_patient_summary")
