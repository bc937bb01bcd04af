"""Array access that yields NULL instead of failing under ANSI mode."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def first_item(array: Column | str, position: int = 0) -> Column:
    """Element at a zero-based position, NULL when the array is shorter or missing."""
    return F.get(F.col(array) if isinstance(array, str) else array, F.lit(position))


def last_where(array: Column | str, predicate: Callable[[Column], Column]) -> Column:
    """Last element that satisfies the predicate, NULL when there is none."""
    return F.try_element_at(F.filter(array, predicate), F.lit(-1))
