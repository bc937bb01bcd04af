"""Silver models."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, functions as F

from caretiers.functions import instant
from caretiers.operators.enrich import clean_encounters
from caretiers.operators.golden import golden_patients, standardize_csv_patients
from caretiers.operators.recent import recent
from caretiers.schemas import SILVER_ENCOUNTER_COLUMNS, SILVER_PATIENT_COLUMNS


def silver_patients(
    api: DataFrame, csv: DataFrame, as_of: date | str | None = None, now: datetime | None = None
) -> DataFrame:
    """One golden record per patient seen in the recent loads of either bronze table."""
    golden = golden_patients(recent(api, as_of), standardize_csv_patients(recent(csv, as_of)))
    stamped = golden.withColumns(
        {"silver_load_time": instant(now), "record_type": F.lit("golden_record")}
    )
    return stamped.select(*SILVER_PATIENT_COLUMNS)


def silver_encounters(
    api: DataFrame, csv: DataFrame, as_of: date | str | None = None, now: datetime | None = None
) -> DataFrame:
    """Newest valid version of every encounter in the recent loads, with its costs."""
    clean = clean_encounters(recent(api, as_of), recent(csv, as_of))
    return clean.withColumn("silver_load_time", instant(now)).select(*SILVER_ENCOUNTER_COLUMNS)
