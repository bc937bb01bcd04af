"""Gold models: patient dimension, encounter fact and the summary per patient."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from caretiers.operators.latest import latest_by
from caretiers.schemas import (
    DIM_PATIENT_COLUMNS,
    FACT_ENCOUNTER_COLUMNS,
    MART_COLUMNS,
)


def dim_patient(silver: DataFrame) -> DataFrame:
    """Newest silver record of every patient; the full name is NULL when a part is.

    Of records taken in at the same time that of the later silver load is the newer one.
    """
    stored = [c for c in DIM_PATIENT_COLUMNS if c != "full_name"]
    ties = [c for c in ("silver_load_time",) if c in silver.columns]
    newest = latest_by(silver.select(*stored, *ties), ["patient_id"], ["ingestion_time"], ties)
    named = newest.withColumn("full_name", F.concat("first_name", F.lit(" "), "last_name"))
    return named.select(*DIM_PATIENT_COLUMNS)


def fact_encounter(silver: DataFrame) -> DataFrame:
    """Every silver encounter row; repeated loads stay repeated."""
    return silver.select(*FACT_ENCOUNTER_COLUMNS)


# Sums and counts that make up the mart; those of two sets of encounters add up to those of both.
SUMMED = {"claim": "total_claim_cost", "coverage": "payer_coverage", "duration": "encounter_duration_minutes"}


def patient_sums(fact: DataFrame) -> DataFrame:
    """Number of encounters, and sums and counts of costs and durations, per patient."""
    return (
        fact.where(F.col("patient_id").isNotNull())
        .groupBy("patient_id")
        .agg(
            F.count("encounter_id").alias("encounters"),
            *[F.sum(c).alias(f"{name}_sum") for name, c in SUMMED.items()],
            *[F.count(c).alias(f"{name}_n") for name, c in SUMMED.items()],
        )
    )


def add_sums(new: DataFrame, held: DataFrame) -> DataFrame:
    """Sums of the patients of ``new`` with what is held of them; others are not among the result."""
    parts = [c for c in new.columns if c != "patient_id"]

    def total(name: str) -> Column:
        # A sum of nothing but missing values stays missing.
        a, b = F.col(f"new.{name}"), F.col(f"held.{name}")
        return F.coalesce(a + b, a, b).alias(name)

    both = new.alias("new").join(held.alias("held"), "patient_id", "left")
    return both.select("patient_id", *[total(c) for c in parts])


def mart_of_sums(dim: DataFrame, sums: DataFrame) -> DataFrame:
    """The summary of every patient in the dimension from sums with a row per patient."""

    def average(name: str) -> Column:
        return F.try_divide(F.sum(f"{name}_sum"), F.sum(f"{name}_n"))

    per_patient = sums.withColumnRenamed("patient_id", "_patient")
    return (
        dim.join(per_patient, F.col("patient_id") == F.col("_patient"), "left")
        .groupBy("patient_id", "full_name", "gender", "city", "state")
        .agg(
            F.coalesce(F.sum("encounters"), F.lit(0)).alias("total_encounters"),
            F.sum("claim_sum").alias("total_claim_cost"),
            F.sum("coverage_sum").alias("total_payer_coverage"),
            average("claim").alias("avg_claim_cost"),
            average("duration").alias("avg_encounter_duration"),
        )
        .select(*MART_COLUMNS)
    )


def mart_patient_summary(dim: DataFrame, fact: DataFrame) -> DataFrame:
    """Encounter count, costs and average duration of every patient in the dimension.

    The fact is summed per patient before the join, so a patient with very many encounters is
    already reduced to one row per task when it is shuffled. The grouping after the join keeps the
    meaning for a dimension with repeated rows and needs no shuffle of its own.
    """
    return mart_of_sums(dim, patient_sums(fact))
