"""Incremental window over bronze tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from caretiers.functions import day_start
from caretiers.schemas import INGESTED_AT, LOAD_DATE


def recent(df: DataFrame, as_of: date | str | None = None, days_back: int = 1) -> DataFrame:
    """Rows taken in since midnight ``days_back`` days before ``as_of`` (default: today).

    Bronze is partitioned by the UTC day of the same clock, so a table that has that column is
    also cut by partition; the timestamp condition reaches the parquet scan.
    """
    since = day_start(as_of, days_back)
    kept = df.where(F.col(INGESTED_AT) >= since.cast("timestamp"))
    if LOAD_DATE in df.columns:
        kept = kept.where(F.col(LOAD_DATE) >= since)
    return kept
