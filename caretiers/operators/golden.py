"""Patient master record from two sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from caretiers.functions import column_or_null, match_key, split_part
from caretiers.operators.latest import latest_by
from caretiers.schemas import INGESTED_AT, LANDING_DAY

# CSV header names and what they are called from silver on.
CSV_RENAMES = {
    "id": "patient_id",
    "first": "first_name",
    "middle": "middle_name",
    "last": "last_name",
    "birthdate": "birth_date",
    "drivers": "driver_license",
    "zip": "postal_code",
    "marital": "marital_status",
}

# Sources of each golden field, the preferred one first.
BOTH = ("api", "csv")
FIELD_SOURCES = {
    "first_name": BOTH,
    "middle_name": BOTH,
    "last_name": BOTH,
    "gender": BOTH,
    "birth_date": BOTH,
    "birth_city": BOTH,
    "birth_state": BOTH,
    "birth_country": BOTH,
    "phone": ("api",),
    "ssn": BOTH,
    "driver_license": BOTH,
    "passport": BOTH,
    "race": BOTH,
    "ethnicity": BOTH,
    "marital_status": BOTH,
    "city": BOTH,
    "state": BOTH,
    "postal_code": BOTH,
    "healthcare_expenses": ("csv",),
    "healthcare_coverage": ("csv",),
    "income": ("csv",),
    "daly": ("api",),
    "qaly": ("api",),
}

PERSON_COLUMNS = ("first_name", "last_name", "birth_date")


def standardize_csv_patients(df: DataFrame) -> DataFrame:
    """CSV patients under the common names, with the birthplace split into its three parts."""
    renamed = df.withColumnsRenamed(CSV_RENAMES)
    birthplace = column_or_null(renamed, "birthplace")
    return renamed.withColumns(
        {
            "birth_city": split_part(birthplace, "  ", 0),
            "birth_state": split_part(birthplace, "  ", 1),
            "birth_country": split_part(birthplace, "  ", 2),
        }
    )


def with_person_key(df: DataFrame) -> DataFrame:
    """Source-independent key of a person: name without case, and birth date."""
    return df.withColumn("person_key", match_key(PERSON_COLUMNS, lower=PERSON_COLUMNS[:2]))


def _latest_side(df: DataFrame, source: str) -> DataFrame:
    """Newest row per patient of one source, columns prefixed with the source name.

    The key is a pair (text, is missing), so rows without an id meet in the join as one key. Of rows
    taken in at the same time the one landed on the later day is the newer.
    """
    fields = [c for c, sources in FIELD_SOURCES.items() if source in sources]
    ties = [LANDING_DAY] if LANDING_DAY in df.columns else []
    side = df.select(
        F.coalesce("patient_id", F.lit("")).alias("_id"),
        F.col("patient_id").isNull().alias("_no_id"),
        F.col(INGESTED_AT).alias(f"{source}_at"),
        *[F.col(c).alias(f"{source}_{c}") for c in ties],
        *[column_or_null(df, c).alias(f"{source}_{c}") for c in fields],
    )
    return latest_by(
        side, ["_id", "_no_id"], [f"{source}_at"], [f"{source}_{c}" for c in ties]
    )


def golden_patients(api: DataFrame, csv: DataFrame) -> DataFrame:
    """Full outer join on ``patient_id``; each field from its first source that has a value.

    Joining the newest row of either side gives the same rows as joining all versions and keeping
    the newest pair, because the order is first by API time and then by CSV time; it needs one
    shuffle per side and cannot multiply the versions of a patient. Rows without an id do not
    describe one person: of the API row and the CSV row left for them only the newer is kept.
    """
    joined = _latest_side(api, "api").join(
        _latest_side(csv, "csv"), ["_id", "_no_id"], "full_outer"
    )
    unrelated = F.col("_no_id")
    csv_newer = F.coalesce(F.col("csv_at") > F.col("api_at"), F.lit(False))
    csv_older = F.coalesce(F.col("csv_at") <= F.col("api_at"), F.lit(False))
    usable = {"api": ~(unrelated & csv_newer), "csv": ~(unrelated & csv_older)}

    def pick(field: str, sources: tuple[str, ...]) -> Column:
        return F.coalesce(*[F.when(usable[s], F.col(f"{s}_{field}")) for s in sources])

    return joined.select(
        F.when(~unrelated, F.col("_id")).alias("patient_id"),
        *[pick(c, sources).alias(c) for c, sources in FIELD_SOURCES.items()],
        pick("at", BOTH).alias("ingestion_time"),
    )
