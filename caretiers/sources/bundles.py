"""FHIR bundle files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from caretiers.schemas import CORRUPT, ENCOUNTER_FIELDS, PATIENT_FIELDS, bundle_schema

RESOURCE_FIELDS = {"Patient": PATIENT_FIELDS, "Encounter": ENCOUNTER_FIELDS}

# Bundle files, as they are or compressed; a task reads a compressed one as a whole.
BUNDLE_FILES = "*.{json,json.gz}"


def read_bundles(
    spark: SparkSession, path: str, *resource_types: str, multiline: bool = True
) -> DataFrame:
    """Bundles of the ``*.json`` and ``*.json.gz`` files directly inside a folder, with the fields of given types.

    With ``multiline`` every file holds one document, which one task parses; files of one bundle per
    line, of which only the first would be seen, are refused. Large exports should be
    newline-delimited (``multiline=False``): such files split across tasks, and what is no bundle by
    itself is kept as unparsable text.
    Columns: ``entry``, the text of bundles that are not wholly of the schema (NULL for good ones) and
    ``source_file``.
    """
    if multiline:
        found = files_of_lines(spark, path).first()
        if found:
            raise ValueError(f"{found['source_file']} has a bundle per line: read it with multiline=False")
    return (
        spark.read.schema(bundle_schema(*[RESOURCE_FIELDS[t] for t in resource_types]))
        .option("multiLine", multiline)
        .option("pathGlobFilter", BUNDLE_FILES)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
        .select("entry", CORRUPT, F.col("_metadata.file_name").alias("source_file"))
    )


def files_of_lines(spark: SparkSession, path: str) -> DataFrame:
    """Names of the bundle files of a folder in which more than one line is a bundle by itself."""
    lines = spark.read.option("pathGlobFilter", BUNDLE_FILES).text(path)
    whole = F.col("value").contains('"entry"') & F.get_json_object("value", "$.entry").isNotNull()
    return (
        lines.where(whole)
        .groupBy(F.col("_metadata.file_name").alias("source_file"))
        .count()
        .where("count > 1")
        .select("source_file")
    )


def entries(bundles: DataFrame) -> DataFrame:
    """One row per entry of a bundle: ``source_file``, its position ``at``, its resource ``r``, ``content``.

    The entries of a bundle that is not wholly of the schema are parsed one by one, from their text:
    good ones are not touched by the others, and a bad one gives what could be read of it (NULL if
    nothing could) and has its own text in ``content``. A bundle in which no entries can be told apart
    is one row without a position that has the whole text.
    """
    element = bundles.schema["entry"].dataType.elementType
    resource = element["resource"].dataType
    texts = F.from_json(CORRUPT, "entry array<string>")["entry"]

    def item(resource_of: Column, text: Column) -> Column:
        return F.struct(resource_of.alias("resource"), text.alias("text"))

    good = F.transform("entry", lambda e: item(e["resource"], F.lit(None).cast("string")))
    mixed = F.transform(texts, lambda t: item(F.lit(None).cast(resource), t))
    items = F.when(F.col(CORRUPT).isNull(), good).otherwise(mixed)
    found = bundles.select("source_file", CORRUPT, F.posexplode_outer(items).alias("at", "e"))
    alone = StructType([*element.fields, StructField(CORRUPT, StringType())])
    parsed = found.withColumn(
        "alone", F.from_json("e.text", alone, {"columnNameOfCorruptRecord": CORRUPT})
    )
    own_text = F.when(F.col(f"alone.{CORRUPT}").isNotNull(), F.col("e.text"))
    return parsed.select(
        "source_file",
        "at",
        F.coalesce("e.resource", "alone.resource").alias("r"),
        F.when(F.col("at").isNull(), F.col(CORRUPT)).otherwise(own_text).alias("content"),
    )


def kept_entries(bundles: DataFrame, path: str) -> DataFrame:
    """The entries of bundles, parsed once and kept as parquet in a new folder.

    ``resources`` and ``corrupt_entries`` take them in place of the bundles. Whoever needs both, or several
    types, would otherwise read and parse every bundle again for each.
    """
    found = entries(bundles)
    found.write.parquet(path)
    return bundles.sparkSession.read.schema(found.schema).parquet(path)


def _entries_of(bundles: DataFrame) -> DataFrame:
    return bundles if "at" in bundles.columns else entries(bundles)


def resources(bundles: DataFrame, resource_type: str) -> DataFrame:
    """One row per resource of the given type: ``r`` and ``source_file``. Takes bundles or their entries."""
    found = _entries_of(bundles).where(F.col("r.resourceType") == resource_type)
    return found.select("source_file", "r")


def stage_resources(
    spark: SparkSession, path: str, staging: str, multiline: bool = True
) -> DataFrame:
    """Parse bundles once and keep the resources of all known types as parquet.

    Parsing dominates the cost of reading bundles, and every type would parse them again. The
    result has the type in ``kind``, by which it is partitioned; ``content`` holds the text of
    a bundle or an entry that is not of the schema, on a row of its own where nothing else was read.
    """
    known = list(RESOURCE_FIELDS)
    found = entries(read_bundles(spark, path, *known, multiline=multiline))
    kind = F.col("r.resourceType")
    staged = found.select(
        "source_file", "at", "r", "content", F.when(kind.isin(known), kind).otherwise("other").alias("kind")
    ).where((F.col("kind") != "other") | F.col("content").isNotNull())
    schema = staged.schema
    staged.write.partitionBy("kind").parquet(staging)
    return spark.read.schema(schema).parquet(staging)


def corrupt_entries(bundles: DataFrame) -> DataFrame:
    """Quarantine: each text that is not of the schema, its position in its bundle (NULL for a whole
    bundle) and the file it came from. Takes bundles or their entries."""
    return _entries_of(bundles).where(F.col("content").isNotNull()).select("source_file", "at", "content")
