"""Clinical encounters enriched with billing data."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from caretiers.functions import as_number, as_timestamp, code, column_or_null, minutes_between
from caretiers.operators.latest import latest_by
from caretiers.operators.quality import valid_costs, valid_encounter
from caretiers.schemas import INGESTED_AT, LANDING_DAY

COST_COLUMNS = ("base_encounter_cost", "total_claim_cost", "payer_coverage")

# What stands in for a missing value.
DEFAULTS = {
    "reason_description": "UNKNOWN",
    "base_encounter_cost": 0.0,
    "total_claim_cost": 0.0,
    "payer_coverage": 0.0,
}

# Columns that pass from the clinical source unchanged.
CLINICAL_COLUMNS = (
    "encounter_id", "status", "patient_id", "patient_name", "encounter_type_code",
    "encounter_type", "provider_name", "organization_name", "reason_description",
)


def typed_costs(billing: DataFrame) -> DataFrame:
    """Billing rows under lower-case names; costs as numbers, NULL where the text is none."""
    return billing.select(
        "id",
        column_or_null(billing, "payer").alias("payer"),
        column_or_null(billing, "provider").alias("provider"),
        column_or_null(billing, "encounterclass").alias("encounter_class"),
        *[as_number(c).alias(c) for c in COST_COLUMNS],
        INGESTED_AT,
        *([LANDING_DAY] if LANDING_DAY in billing.columns else []),
    )


def normalize_codes(encounters: DataFrame) -> DataFrame:
    """Class and reason codes without stray blanks or case, times as timestamps."""
    return encounters.select(
        *CLINICAL_COLUMNS,
        as_timestamp("start_time").alias("start_time"),
        as_timestamp("end_time").alias("end_time"),
        code("encounter_class").alias("encounter_class_code"),
        code("reason_code").alias("reason_code"),
        INGESTED_AT,
        *([LANDING_DAY] if LANDING_DAY in encounters.columns else []),
    )


def with_duration(df: DataFrame) -> DataFrame:
    return df.withColumn("encounter_duration_minutes", minutes_between("start_time", "end_time"))


def fill_defaults(df: DataFrame) -> DataFrame:
    """Defaults for the columns that have one; all others keep their NULLs."""
    return df.fillna({c: v for c, v in DEFAULTS.items() if c in df.columns})


def enrich_encounters(encounters: DataFrame, billing: DataFrame) -> DataFrame:
    """Left join of encounters with billing rows on ``encounter_id = id``.

    Meant for billing that has one row per id; every encounter then stays exactly one row.
    """
    right = billing.select(*[F.col(c).alias(f"csv_{c}" if c in encounters.columns else c)
                             for c in billing.columns])
    return encounters.join(right, F.col("encounter_id") == F.col("id"), "left")


def clean_encounters(api: DataFrame, csv: DataFrame) -> DataFrame:
    """Newest valid version of every encounter, with its newest valid billing.

    The result is that of joining every version of an encounter with every version of its billing,
    dropping the bad pairs and keeping the newest. No rule looks at both sides at once, so each
    side is reduced to one row per key first: one shuffle per side, which the join reuses, and no
    multiplied versions. Billing that has only bad versions keeps one of them, marked, so that its
    encounter is dropped rather than taken for one without billing.
    """
    clinical = with_duration(normalize_codes(api)).where(valid_encounter())
    clinical_ties = [c for c in (LANDING_DAY,) if c in clinical.columns]
    costs = fill_defaults(typed_costs(csv).where(F.col("id").isNotNull()))
    costs = costs.withColumn("_valid", valid_costs())
    cost_ties = [c for c in (LANDING_DAY,) if c in costs.columns]

    clinical = latest_by(clinical, ["encounter_id"], [INGESTED_AT], clinical_ties)
    costs = latest_by(costs, ["id"], ["_valid", INGESTED_AT], cost_ties)

    joined = enrich_encounters(clinical, costs).where(F.coalesce("_valid", F.lit(True)))
    return fill_defaults(joined).withColumn(
        "ingestion_time", F.coalesce(INGESTED_AT, f"csv_{INGESTED_AT}")
    )
