"""FHIR resources to flat records, one projection per resource type."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from caretiers.functions import first_item, last_where
from caretiers.schemas import ENCOUNTER_COLUMNS, PATIENT_COLUMNS

# Identifier type code of each identifier column.
IDENTIFIER_CODES = {
    "mrn": "MR",
    "ssn": "SS",
    "driver_license": "DL",
    "passport": "PPN",
}

# Url fragment of each extension kind. An extension belongs to the first
# kind, in this order, whose fragment its url contains.
EXTENSION_KINDS = (
    "race",
    "ethnicity",
    "mothersMaidenName",
    "birthsex",
    "birthPlace",
    "disability-adjusted-life-years",
    "quality-adjusted-life-years",
)

# Fixed value: what precedes the id in a reference to another resource.
REFERENCE_PREFIX = "urn:uuid:"


def identifier_of(identifiers: str, type_code: str) -> Column:
    """Value of the last identifier of a type."""
    return last_where(
        identifiers, lambda i: first_item(i["type"]["coding"])["code"] == type_code
    )["value"]


def identifier_columns(identifiers: str) -> dict[str, Column]:
    """Pivot typed identifiers into columns."""
    return {name: identifier_of(identifiers, c) for name, c in IDENTIFIER_CODES.items()}


def extension_of(extensions: str, kind: str) -> Column:
    """Last extension of a kind, skipping those an earlier kind claims."""
    earlier = EXTENSION_KINDS[: EXTENSION_KINDS.index(kind)]

    def belongs(extension: Column) -> Column:
        test = extension["url"].contains(kind)
        for other in earlier:
            test = test & ~extension["url"].contains(other)
        return test

    return last_where(extensions, belongs)


def extension_columns(extensions: str) -> dict[str, Column]:
    """Columns taken from extensions. Race and ethnicity are named by their second part."""
    address = extension_of(extensions, "birthPlace")["valueAddress"]
    return {
        "race": first_item(extension_of(extensions, "race")["extension"], 1)["valueString"],
        "ethnicity": first_item(extension_of(extensions, "ethnicity")["extension"], 1)[
            "valueString"
        ],
        "mother_maiden_name": extension_of(extensions, "mothersMaidenName")["valueString"],
        "birth_sex": extension_of(extensions, "birthsex")["valueCode"],
        "birth_city": address["city"],
        "birth_state": address["state"],
        "birth_country": address["country"],
        "daly": extension_of(extensions, "disability-adjusted-life-years")["valueDecimal"],
        "qaly": extension_of(extensions, "quality-adjusted-life-years")["valueDecimal"],
    }


def blank_missing(df: DataFrame) -> DataFrame:
    """Landing form: missing text is an empty string. Numbers stay NULL."""
    return df.fillna("")


def flatten_patients(resources: DataFrame) -> DataFrame:
    """Patient resources (``r``, ``source_file``) as flat records; missing values are NULL.

    A resource with missing or short parts gives NULLs and never costs its neighbours.
    """
    name = first_item("r.name")
    address = first_item("r.address")
    columns = {
        "patient_id": F.col("r.id"),
        "first_name": first_item(name["given"]),
        "middle_name": first_item(name["given"], 1),
        "last_name": name["family"],
        "gender": F.col("r.gender"),
        "birth_date": F.col("r.birthDate"),
        "phone": first_item("r.telecom")["value"],
        **identifier_columns("r.identifier"),
        "city": address["city"],
        "state": address["state"],
        "postal_code": address["postalCode"],
        "country": address["country"],
        **extension_columns("r.extension"),
        "marital_status": F.col("r.maritalStatus.text"),
        "source_file": F.col("source_file"),
    }
    return resources.select(*[columns[c].alias(c) for c in PATIENT_COLUMNS])


def flatten_encounters(resources: DataFrame, load_date: date | str | None = None) -> DataFrame:
    """Encounter resources (``r``) as flat records; missing values are NULL."""
    kind = first_item(first_item("r.type")["coding"])
    reason = first_item(first_item("r.reasonCode")["coding"])
    day = F.current_date() if load_date is None else F.lit(str(load_date))
    columns = {
        "encounter_id": F.col("r.id"),
        "status": F.col("r.status"),
        "patient_id": F.replace(F.col("r.subject.reference"), F.lit(REFERENCE_PREFIX), F.lit("")),
        "patient_name": F.col("r.subject.display"),
        "start_time": F.col("r.period.start"),
        "end_time": F.col("r.period.end"),
        "encounter_class": F.col("r.class.code"),
        "encounter_type": kind["display"],
        "encounter_type_code": kind["code"],
        "provider_name": first_item("r.participant")["individual"]["display"],
        "organization_name": F.col("r.serviceProvider.display"),
        "reason_code": reason["code"],
        "reason_description": reason["display"],
        "load_date": day.cast("string"),
    }
    return resources.select(*[columns[c].alias(c) for c in ENCOUNTER_COLUMNS])


def without_id(flat: DataFrame, key: str) -> DataFrame:
    """Records whose resource carried no usable id."""
    return flat.where(F.coalesce(F.col(key), F.lit("")) == "")
