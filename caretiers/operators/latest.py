"""Newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import MapType, VariantType


def newest_first(columns: Sequence[str | Column]) -> list[Column]:
    return [
        c.desc_nulls_last() if isinstance(c, Column) else F.col(c).desc_nulls_last()
        for c in columns
    ]


def latest_by(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    tie_breakers: Sequence[str | Column] = (),
) -> DataFrame:
    """One row per key: the greatest by ``order``, then by ``tie_breakers``, then by its values.

    Of rows that tie in all that was asked for, the one with the greater first column stays, or the
    greater second one where those are equal, and so on (NULL is less than any value); so the result
    is the same in every run and every engine. Rows with a NULL key form one group. Spark turns
    the rank filter into a group limit before the shuffle, so a task sends at most one row per key,
    however often a key repeats.
    """
    values = [f"`{f.name}`" for f in df.schema if not isinstance(f.dataType, (MapType, VariantType))]
    ordering = newest_first([*order, *tie_breakers, *values])
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*ordering))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")
