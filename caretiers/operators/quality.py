"""Encounter quality rules and reusable checks."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from caretiers.functions import instant


def valid_encounter() -> Column:
    """Has an id and does not end before it starts; a missing duration is not valid."""
    return F.col("encounter_id").isNotNull() & (F.col("encounter_duration_minutes") >= 0)


def valid_costs() -> Column:
    """Cost not negative, and no more covered than was charged."""
    return (F.col("total_claim_cost") >= 0) & (
        F.col("payer_coverage") <= F.col("total_claim_cost")
    )


def quality_filters(df: DataFrame) -> DataFrame:
    return df.where(valid_encounter() & valid_costs())


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which any of the columns is NULL."""
    return df.where(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns]))


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def check_accepted(df: DataFrame, column: str, values: Sequence[Any]) -> DataFrame:
    """Rows whose value is not among the accepted ones (NULL passes)."""
    return df.where(~F.col(column).isin(*values))


def check_range(
    df: DataFrame, column: str, low: float | None = None, high: float | None = None
) -> DataFrame:
    """Rows whose value lies outside the bounds (NULL passes)."""
    outside = F.lit(False)
    if low is not None:
        outside = outside | (F.col(column) < low)
    if high is not None:
        outside = outside | (F.col(column) > high)
    return df.where(outside)


def check_freshness(
    df: DataFrame, column: str, max_age_hours: float, now: datetime | None = None
) -> DataFrame:
    """One row: newest load, its age in hours, and whether that is within the limit."""
    newest = F.max(column)
    age = (F.unix_timestamp(instant(now)) - F.unix_timestamp(F.col("newest_load"))) / F.lit(3600)
    return (
        df.agg(newest.alias("newest_load"))
        .withColumn("age_hours", age)
        .withColumn("is_fresh", F.coalesce(F.col("age_hours") <= max_age_hours, F.lit(False)))
    )


def gold_checks(dim: DataFrame, fact: DataFrame) -> DataFrame:
    """Failing rows of the dimension and the fact: table, check, and the key of the row as text."""

    def failing(table: str, check: str, rows: DataFrame, key: str) -> DataFrame:
        return rows.select(
            F.lit(table).alias("table_name"), F.lit(check).alias("check_name"), F.col(key).cast("string").alias("row_key")
        )

    found = [
        failing("dim_patient", "not_null", check_not_null(dim, ["patient_id"]), "patient_id"),
        failing("dim_patient", "unique", check_unique(dim, ["patient_id"]), "patient_id"),
        failing("fact_encounter", "not_null", check_not_null(fact, ["encounter_id", "patient_id"]), "encounter_id"),
        failing("fact_encounter", "unique", check_unique(fact, ["encounter_id"]), "encounter_id"),
        failing("fact_encounter", "duration", check_range(fact, "encounter_duration_minutes", low=0), "encounter_id"),
        failing("fact_encounter", "cost", check_range(fact, "total_claim_cost", low=0), "encounter_id"),
    ]
    return reduce(DataFrame.unionByName, found)
