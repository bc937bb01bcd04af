"""Schemas: the FHIR fields that are read, and the columns of each layer."""

from __future__ import annotations

CODINGS = "array<struct<code: string, display: string>>"

# Only the fields the flattening reads: the JSON parser skips everything else.
PATIENT_FIELDS = """
    gender: string, birthDate: string,
    name: array<struct<given: array<string>, family: string>>,
    telecom: array<struct<value: string>>,
    identifier: array<struct<type: struct<coding: array<struct<code: string>>>, value: string>>,
    address: array<struct<city: string, state: string, postalCode: string, country: string>>,
    extension: array<struct<url: string, valueString: string, valueCode: string,
        valueDecimal: double,
        valueAddress: struct<city: string, state: string, country: string>,
        extension: array<struct<url: string, valueString: string>>>>,
    maritalStatus: struct<text: string>
"""
ENCOUNTER_FIELDS = f"""
    status: string,
    subject: struct<reference: string, display: string>,
    period: struct<start: string, end: string>,
    class: struct<code: string>,
    type: array<struct<coding: {CODINGS}>>,
    participant: array<struct<individual: struct<display: string>>>,
    reasonCode: array<struct<coding: {CODINGS}>>,
    serviceProvider: struct<display: string>
"""

CORRUPT = "_corrupt_record"


def bundle_schema(*resource_fields: str) -> str:
    """DDL of a bundle whose resources carry the given fields."""
    fields = ", ".join(("resourceType: string", "id: string", *resource_fields))
    return f"entry array<struct<resource: struct<{fields}>>>, {CORRUPT} string"


# Columns of the tables, in output order. Flattened API records first.
PATIENT_COLUMNS = (
    "patient_id", "first_name", "middle_name", "last_name", "gender", "birth_date", "phone",
    "mrn", "ssn", "driver_license", "passport", "city", "state", "postal_code", "country",
    "race", "ethnicity", "birth_city", "birth_state", "birth_country", "birth_sex",
    "mother_maiden_name", "marital_status", "daly", "qaly", "source_file",
)
ENCOUNTER_COLUMNS = (
    "encounter_id", "status", "patient_id", "patient_name", "start_time", "end_time",
    "encounter_class", "encounter_type", "encounter_type_code", "provider_name",
    "organization_name", "reason_code", "reason_description", "load_date",
)

SILVER_PATIENT_COLUMNS = (
    "patient_id", "first_name", "middle_name", "last_name", "gender", "birth_date",
    "birth_city", "birth_state", "birth_country", "phone", "ssn", "driver_license", "passport",
    "race", "ethnicity", "marital_status", "city", "state", "postal_code",
    "healthcare_expenses", "healthcare_coverage", "income", "daly", "qaly",
    "ingestion_time", "silver_load_time", "record_type",
)
SILVER_ENCOUNTER_COLUMNS = (
    "encounter_id", "status", "patient_id", "patient_name", "start_time", "end_time",
    "encounter_class_code", "encounter_type_code", "encounter_type", "provider_name",
    "organization_name", "reason_code", "reason_description", "payer", "provider",
    "encounter_class", "base_encounter_cost", "total_claim_cost", "payer_coverage",
    "ingestion_time", "silver_load_time", "encounter_duration_minutes",
)
DIM_PATIENT_COLUMNS = (
    "patient_id", "first_name", "middle_name", "last_name", "full_name", "gender", "birth_date",
    "race", "ethnicity", "marital_status", "city", "state", "postal_code",
    "birth_city", "birth_state", "birth_country", "ingestion_time",
)
FACT_ENCOUNTER_COLUMNS = (
    "encounter_id", "patient_id", "start_time", "end_time", "encounter_duration_minutes",
    "encounter_class_code", "encounter_type_code", "encounter_type", "reason_code",
    "reason_description", "provider_name", "organization_name", "payer", "provider",
    "encounter_class", "base_encounter_cost", "total_claim_cost", "payer_coverage",
    "ingestion_time",
)
MART_COLUMNS = (
    "patient_id", "full_name", "gender", "city", "state", "total_encounters",
    "total_claim_cost", "total_payer_coverage", "avg_claim_cost", "avg_encounter_duration",
)

# Lineage columns every bronze row carries.
INGESTED_AT = "_ingestion_timestamp"
SOURCE_FILE = "_source_file"
LOAD_DATE = "_load_date"
# The day a file was landed on, by the folder it lies in.
LANDING_DAY = "load_date"
