"""CSV extracts with a header line."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame, DataFrameReader, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from caretiers.functions import instant

# Columns an extract cannot do without.
REQUIRED_PATIENT_COLUMNS = ("id", "first")
REQUIRED_ENCOUNTER_COLUMNS = ("id", "patient")
MALFORMED = "_malformed_record"


def csv_reader(
    spark: SparkSession, strict: bool = True, multi_line: bool = True
) -> DataFrameReader:
    """Reader for comma-separated files with a header and doubled quotes.

    A strict reader fails when a file's header differs from the schema. A lax one binds columns
    by position, so it is only for files whose header is known to match.
    """
    return (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("enforceSchema", not strict)
        .option("multiLine", multi_line)
    )


def read_csv_source(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Extract with every column as text (codes keep leading zeros), header in lower case.

    Values may hold line breaks; huge extracts without any can be split with ``multi_line=False``.
    Records that do not fit the header are left to ``malformed_records``.
    """
    read = _with_rescue(spark, path, multi_line)
    # Spark refuses to look at the text of bad records alone, so the condition names a value too.
    fits = F.col(MALFORMED).isNull() & (F.length(F.concat_ws("", F.col(f"`{read.columns[0]}`"))) >= 0)
    return lower_columns(read.where(fits).drop(MALFORMED))


def malformed_records(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Whole text and file of each record with more or fewer fields than the header names."""
    read = _with_rescue(spark, path, multi_line)
    bad = F.col(MALFORMED).isNotNull() & (F.length(F.concat_ws("", F.col(f"`{read.columns[0]}`"))) >= 0)
    named = read.select("*", F.col("_metadata.file_name").alias("source_file"))
    # The text ends with the line break that ended the record.
    text = F.regexp_replace(MALFORMED, "\\r?\\n\\z", "")
    return named.where(bad).select("source_file", text.alias("content"))


def _with_rescue(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    header = csv_reader(spark, multi_line=multi_line).csv(path).columns
    fields = [StructField(c, StringType()) for c in (*header, MALFORMED)]
    reader = csv_reader(spark, multi_line=multi_line).schema(StructType(fields))
    # Columns are pruned only after parsing, or surplus fields would go unnoticed.
    return reader.option("columnNameOfCorruptRecord", MALFORMED).option("columnPruning", False).csv(path)


def lower_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def require_non_empty(df: DataFrame, name: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{name} has no rows")
    return df


def require_columns(df: DataFrame, columns: Iterable[str], name: str) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{name} lacks the columns {missing}")
    return df


def stamp(df: DataFrame, source: str, now: datetime | None = None) -> DataFrame:
    """Add when (UTC) and from which feed the rows were taken in."""
    return df.withColumns({"ingestion_time": instant(now), "source": F.lit(source)})
