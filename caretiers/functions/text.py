"""Text and number expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F


def code(column: str) -> Column:
    """Normalised code: surrounding blanks removed, upper case."""
    return F.upper(F.trim(F.col(column)))


def as_number(column: str) -> Column:
    """Text as double, NULL when it is not a number."""
    return F.col(column).try_cast("double")


def split_part(column: Column, separator: str, position: int) -> Column:
    """Trimmed part of a separated text, NULL when there are fewer parts."""
    return F.trim(F.get(F.split(column, separator), F.lit(position)))


def match_key(columns: Iterable[str], lower: Iterable[str] = ()) -> Column:
    """SHA-256 over the ``|``-joined columns, the ones in ``lower`` compared without case.

    NULL parts are skipped, so two rows that differ only in where a NULL stands share a key.
    """
    folded = set(lower)
    parts = [F.lower(F.col(c)) if c in folded else F.col(c) for c in columns]
    return F.sha2(F.concat_ws("|", *parts), 256)


def column_or_null(df: DataFrame, name: str) -> Column:
    """The column, or a NULL string where a source does not deliver it (yet)."""
    present = name.lower() in {c.lower() for c in df.columns}
    return F.col(name) if present else F.lit(None).cast("string")
