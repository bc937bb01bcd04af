"""Patient and encounter feeds derived from the test tables.

Each frame is one portable SQL text over whole tables, run by Spark here and embedded in the oracle
queries. Table names stand in braces. Two loads exist, on 2024-01-01 and on 2024-01-02.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

DAY_1 = "2024-01-01"
DAY_2 = "2024-01-02"
DAY_3 = "2024-01-03"

TABLES = ("region", "nation", "customer", "supplier", "orders", "lineitem", "events")

# API patients: all customers on day 1, all customers again with changed values on day 2, and all
# suppliers. Some rows have no id, no last name or no gender.
PAT_API = """
SELECT patient_id, first_name, middle_name, last_name, gender, birth_date, phone, mrn, ssn,
       driver_license, passport, city, state, postal_code, country, race, ethnicity, birth_city,
       birth_state, birth_country, birth_sex, mother_maiden_name, marital_status, daly, qaly,
       _ingestion_timestamp
FROM (
    SELECT CASE WHEN k % 100 <> 0 THEN prefix || cast(k AS string) END AS patient_id,
           first_name,
           CASE WHEN k % 4 = 0 THEN 'M' || cast(k % 9 AS string) END AS middle_name,
           CASE WHEN k % 5 <> 0 THEN substr(full_name, 10) END AS last_name,
           CASE WHEN k % 3 = 0 THEN NULL WHEN k % 2 = 0 THEN 'male' ELSE 'female' END AS gender,
           '19' || cast(50 + k % 50 AS string) || '-01-15' AS birth_date,
           CASE WHEN k % 7 <> 0 THEN '555-' || cast(k AS string) END AS phone,
           'MRN' || cast(k AS string) AS mrn,
           CASE WHEN k % 6 <> 0 THEN '999-' || cast(k AS string) END AS ssn,
           CASE WHEN k % 8 <> 0 THEN 'S' || cast(k AS string) END AS driver_license,
           CASE WHEN k % 10 = 3 THEN 'X' || cast(k AS string) || 'X' END AS passport,
           n_name || version AS city,
           CASE WHEN k % 11 = 0 THEN r_name END AS state,
           '0' || cast(1000 + k % 9000 AS string) AS postal_code,
           'US' AS country,
           CASE WHEN k % 13 <> 0 THEN segment END AS race,
           CASE WHEN k % 12 <> 0 THEN r_name END AS ethnicity,
           CASE WHEN k % 9 <> 0 THEN n_name END AS birth_city,
           CASE WHEN k % 9 > 4 THEN r_name END AS birth_state,
           CASE WHEN k % 9 <> 0 THEN 'US' END AS birth_country,
           CASE WHEN k % 2 = 0 THEN 'M' ELSE 'F' END AS birth_sex,
           CASE WHEN k % 14 <> 0 THEN 'Maiden ' || cast(k AS string) END AS mother_maiden_name,
           CASE WHEN k % 15 <> 0 THEN 'Married' END AS marital_status,
           CASE WHEN k % 4 <> 1 THEN cast(k % 40 AS double) / 4 END AS daly,
           CASE WHEN k % 4 <> 2 THEN cast(k % 80 AS double) / 4 END AS qaly,
           load + cast(k AS int) * INTERVAL '1' SECOND AS _ingestion_timestamp
    FROM (
        SELECT c_custkey AS k, 'P' AS prefix, 'Customer' AS first_name, c_name AS full_name,
               c_nationkey AS nationkey, c_mktsegment AS segment, '' AS version,
               TIMESTAMP '2024-01-01 00:00:00' AS load
        FROM {customer}
        UNION ALL
        SELECT c_custkey, 'P', 'Customer', c_name, c_nationkey, c_mktsegment, ' (moved)',
               TIMESTAMP '2024-01-02 00:00:00'
        FROM {customer}
        UNION ALL
        SELECT s_suppkey, 'S', 'Supplier', s_name, s_nationkey, 'STAFF', '',
               TIMESTAMP '2024-01-01 06:00:00'
        FROM {supplier}
    ) people
    JOIN {nation} ON nationkey = n_nationkey
    JOIN {region} ON n_regionkey = r_regionkey
) filled
"""

# CSV patients: all customers, and the users of all events, whom the API does not know.
PAT_CSV = """
SELECT CASE WHEN k % 90 <> 0 THEN prefix || cast(k AS string) END AS id,
       first, CASE WHEN k % 3 = 0 THEN 'Q' END AS middle, last,
       '19' || cast(50 + k % 50 AS string) || '-01-15' AS birthdate,
       CASE WHEN k % 2 = 0 THEN 'S' || cast(k AS string) END AS drivers,
       '0' || cast(1000 + k % 9000 AS string) AS zip,
       CASE WHEN k % 2 = 0 THEN 'M' ELSE 'S' END AS marital,
       CASE WHEN k % 5 = 0 THEN place
            WHEN k % 5 = 1 THEN place || '  ' || area
            ELSE place || '  ' || area || '  US' END AS birthplace,
       CASE WHEN k % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
       '999-' || cast(k AS string) AS ssn,
       CASE WHEN k % 4 = 0 THEN 'X' || cast(k AS string) END AS passport,
       'other' AS race, 'unknown' AS ethnicity, place AS city, area AS state,
       cast(cast(money AS decimal(12, 2)) AS string) AS healthcare_expenses,
       '0.00' AS healthcare_coverage,
       CASE WHEN k % 21 <> 0 THEN cast(k * 10 AS string) END AS income,
       TIMESTAMP '2024-01-01 12:00:00' + cast(k AS int) * INTERVAL '1' SECOND
           AS _ingestion_timestamp
FROM (
    SELECT c_custkey AS k, 'P' AS prefix, 'CUSTOMER' AS first, substr(c_name, 10) AS last,
           n_name AS place, r_name AS area, c_acctbal AS money
    FROM {customer}
    JOIN {nation} ON c_nationkey = n_nationkey
    JOIN {region} ON n_regionkey = r_regionkey
    UNION ALL
    SELECT user_id + 1, 'U', 'User', 'No. ' || cast(user_id AS string), 'ONLINE', 'WEB',
           max(value)
    FROM {events} GROUP BY user_id
) people
"""

# API encounters: all orders on day 1. On day 2 all orders come again: open ones as a new version,
# the others as a follow-up visit without billing. Some times are missing, malformed or reversed.
ENC_API = """
SELECT encounter_id, status, patient_id, patient_name,
       start_text AS start_time,
       CASE WHEN k % 50 = 0 THEN NULL
            WHEN k % 53 = 0 THEN 'not a time'
            ELSE replace(cast(o_orderdate + minutes * INTERVAL '1' MINUTE AS string), ' ', 'T')
                 || '-05:00' END AS end_time,
       encounter_class, encounter_type, encounter_type_code, provider_name, organization_name,
       reason_code, reason_description, _ingestion_timestamp
FROM (
    SELECT k, o_orderdate, encounter_id,
           'finished' AS status,
           'P' || cast(o_custkey AS string) AS patient_id,
           'Customer ' || cast(o_custkey AS string) AS patient_name,
           replace(cast(o_orderdate AS string), ' ', 'T') || '-05:00' AS start_text,
           cast(CASE WHEN version = 1 THEN k % 300 - 5 ELSE k % 290 - 30 END AS int) AS minutes,
           CASE WHEN k % 2 = 0 THEN ' amb ' ELSE 'EMER' END AS encounter_class,
           'Visit ' || o_orderstatus AS encounter_type,
           'T' || o_orderstatus AS encounter_type_code,
           'Dr. ' || cast(k % 100 AS string) AS provider_name,
           'Clinic ' || cast(k % 10 AS string) AS organization_name,
           CASE WHEN k % 4 <> 0 THEN ' r' || substr(o_orderpriority, 1, 1) END AS reason_code,
           CASE WHEN k % 4 <> 0 THEN o_orderpriority END AS reason_description,
           load AS _ingestion_timestamp
    FROM (
        SELECT o_orderkey AS k, o_custkey, o_orderstatus, o_orderdate, o_orderpriority,
               1 AS version, 'E' || cast(o_orderkey AS string) AS encounter_id,
               TIMESTAMP '2024-01-01 00:00:00' AS load
        FROM {orders}
        UNION ALL
        SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority,
               2, CASE WHEN o_orderkey % 97 = 0 THEN NULL
                       WHEN o_orderstatus = 'O' THEN 'E' || cast(o_orderkey AS string)
                       ELSE 'F' || cast(o_orderkey AS string) END,
               TIMESTAMP '2024-01-02 00:00:00'
        FROM {orders}
    ) visits
) rendered
"""

# CSV encounters: all line items. Closed lines bill an encounter, one billing version per return
# flag; open lines bill under a provisional id that no encounter has.
ENC_CSV = """
SELECT CASE WHEN l_linestatus = 'F' THEN 'E' ELSE 'X' END || cast(k AS string) AS id,
       'P' || cast(k AS string) AS patient,
       CASE WHEN k % 3 <> 0 THEN 'Payer ' || l_returnflag END AS payer,
       'Provider ' || cast(k % 20 AS string) AS provider,
       CASE WHEN k % 2 = 0 THEN 'ambulatory' ELSE 'emergency' END AS encounterclass,
       cast(base AS string) AS base_encounter_cost,
       CASE WHEN k % 31 = 0 THEN 'n/a'
            WHEN k % 23 = 0 THEN '-' || cast(total AS string)
            ELSE cast(total AS string) END AS total_claim_cost,
       CASE WHEN k % 37 = 0 THEN NULL
            WHEN l_returnflag = 'A' AND k % 2 = 0 THEN cast(total + total AS string)
            WHEN l_returnflag = 'R' AND k % 5 = 0 THEN cast(total + 1 AS string)
            ELSE cast(base AS string) END AS payer_coverage,
       CASE WHEN l_returnflag = 'N' THEN TIMESTAMP '2024-01-01 12:00:00'
            WHEN l_returnflag = 'R' THEN TIMESTAMP '2024-01-01 13:00:00'
            ELSE TIMESTAMP '2024-01-02 06:00:00' END AS _ingestion_timestamp
FROM (
    SELECT l_orderkey AS k, l_linestatus, l_returnflag,
           cast(min(cast(l_extendedprice AS decimal(12, 2))) AS decimal(18, 2)) AS base,
           cast(sum(cast(l_extendedprice AS decimal(12, 2))) AS decimal(18, 2)) AS total
    FROM {lineitem}
    GROUP BY l_orderkey, l_linestatus, l_returnflag
) bills
"""

# One bill per encounter: the extract the end-to-end run delivers unchanged every day.
ENC_BILL = """
SELECT CASE WHEN l_linestatus = 'F' THEN 'E' ELSE 'X' END || cast(k AS string) AS id,
       'P' || cast(k AS string) AS patient,
       CASE WHEN k % 3 <> 0 THEN 'Payer, "Inc"' END AS payer,
       'Provider ' || cast(k % 20 AS string) AS provider,
       CASE WHEN k % 2 = 0 THEN 'ambulatory' ELSE 'emergency' END AS encounterclass,
       cast(base AS string) AS base_encounter_cost,
       CASE WHEN k % 31 = 0 THEN 'n/a' ELSE cast(total AS string) END AS total_claim_cost,
       CASE WHEN k % 7 = 0 THEN cast(total + total AS string)
            ELSE cast(base AS string) END AS payer_coverage
FROM (
    SELECT l_orderkey AS k, l_linestatus,
           cast(min(cast(l_extendedprice AS decimal(12, 2))) AS decimal(18, 2)) AS base,
           cast(sum(cast(l_extendedprice AS decimal(12, 2))) AS decimal(18, 2)) AS total
    FROM {lineitem}
    GROUP BY l_orderkey, l_linestatus
) bills
"""

FRAMES = {
    "pat_api": PAT_API,
    "pat_csv": PAT_CSV,
    "enc_api": ENC_API,
    "enc_csv": ENC_CSV,
    "enc_bill": ENC_BILL,
}


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture frame over the parquet tables of a scale factor."""
    text = FRAMES[name]
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)


def frame_sql(name: str) -> str:
    """The same frame over plainly named tables."""
    return FRAMES[name].format(**{t: t for t in TABLES})


# --- FHIR bundles built from the API frames ---------------------------------------------------

RESOURCE_TYPE = "resourceType"


def _resource(resource_type: str, fields: dict[str, Column]) -> Column:
    return F.struct(
        F.lit(resource_type).alias(RESOURCE_TYPE), *[c.alias(n) for n, c in fields.items()]
    )


def _bundle(df: DataFrame, resource_type: str, fields: dict[str, Column]) -> DataFrame:
    """One bundle per row: an unrelated resource of another type, then the record."""
    unrelated = {n: F.lit(None) if n != "id" else F.lit("other") for n in fields}
    return df.select(
        F.array(
            F.struct(_resource("Observation", unrelated).alias("resource")),
            F.struct(_resource(resource_type, fields).alias("resource")),
        ).alias("entry")
    )


def _extension(url: str, **values: Column) -> Column:
    kinds = {
        "valueString": "string",
        "valueCode": "string",
        "valueDecimal": "double",
        "valueAddress": "struct<city: string, state: string, country: string>",
        "extension": "array<struct<url: string, valueString: string>>",
    }
    return F.struct(
        F.lit(url).alias("url"),
        *[values.get(n, F.lit(None)).cast(t).alias(n) for n, t in kinds.items()],
    )


def _two_parts(text: str) -> Column:
    return F.array(
        F.struct(F.lit("ombCategory").alias("url"), F.lit("code").alias("valueString")),
        F.struct(F.lit("text").alias("url"), F.col(text).alias("valueString")),
    )


def patient_bundles(df: DataFrame) -> DataFrame:
    """Patient bundles in which identifiers and extensions repeat, older values first."""
    core = "http://hl7.org/fhir/us/core/StructureDefinition/us-core-"
    base = "http://hl7.org/fhir/StructureDefinition/"
    life = "http://synthetichealth.github.io/synthea/"

    def identifier(code: str, value: Column) -> Column:
        coding = F.array(F.struct(F.lit(code).alias("code")))
        return F.struct(F.struct(coding.alias("coding")).alias("type"), value.alias("value"))

    identifiers = F.array(
        identifier("MR", F.lit("older")),
        identifier("MR", F.col("mrn")),
        identifier("SS", F.col("ssn")),
        identifier("DL", F.col("driver_license")),
        identifier("PPN", F.col("passport")),
    )
    address = F.struct("city", "state", F.col("postal_code").alias("postalCode"), "country")
    birth_address = F.struct(
        F.col("birth_city").alias("city"),
        F.col("birth_state").alias("state"),
        F.col("birth_country").alias("country"),
    )
    fields = {
        "id": F.col("patient_id"),
        "gender": F.col("gender"),
        "birthDate": F.col("birth_date"),
        "name": F.array(
            F.struct(
                F.array_compact(F.array("first_name", "middle_name")).alias("given"),
                F.col("last_name").alias("family"),
            )
        ),
        "telecom": F.array(F.struct(F.col("phone").alias("value"))),
        "identifier": F.filter(identifiers, lambda i: i["value"].isNotNull()),
        "address": F.array(address),
        "extension": F.array(
            _extension(f"{core}ethnicity", extension=_two_parts("ethnicity")),
            _extension(f"{core}race", extension=_two_parts("first_name")),
            _extension(f"{core}race", extension=_two_parts("race")),
            _extension(f"{base}patient-mothersMaidenName", valueString=F.col("mother_maiden_name")),
            _extension(f"{core}birthsex", valueCode=F.col("birth_sex")),
            _extension(f"{base}patient-birthPlace", valueAddress=birth_address),
            _extension(f"{life}disability-adjusted-life-years", valueDecimal=F.col("daly")),
            _extension(f"{life}quality-adjusted-life-years", valueDecimal=F.col("qaly")),
        ),
        "maritalStatus": F.struct(F.col("marital_status").alias("text")),
    }
    return _bundle(df, "Patient", fields)


def encounter_bundles(df: DataFrame) -> DataFrame:
    """Encounter bundles in which type and reason codings repeat, the wanted one first."""

    def codings(code: str, display: str) -> Column:
        wanted = F.struct(F.col(code).alias("code"), F.col(display).alias("display"))
        other = F.struct(F.lit("other").alias("code"), F.lit("other").alias("display"))
        return F.array(F.struct(F.array(wanted, other).alias("coding")))

    fields = {
        "id": F.col("encounter_id"),
        "status": F.col("status"),
        "subject": F.struct(
            F.concat(F.lit("urn:uuid:"), "patient_id").alias("reference"),
            F.col("patient_name").alias("display"),
        ),
        "period": F.struct(F.col("start_time").alias("start"), F.col("end_time").alias("end")),
        "class": F.struct(F.col("encounter_class").alias("code")),
        "type": codings("encounter_type_code", "encounter_type"),
        "participant": F.array(
            F.struct(F.struct(F.col("provider_name").alias("display")).alias("individual"))
        ),
        "reasonCode": codings("reason_code", "reason_description"),
        "serviceProvider": F.struct(F.col("organization_name").alias("display")),
    }
    return _bundle(df, "Encounter", fields)
