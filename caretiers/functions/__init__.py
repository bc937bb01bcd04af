"""Column expressions shared by the operators. All of them stay inside the JVM."""

from caretiers.functions.arrays import first_item, last_where
from caretiers.functions.text import as_number, code, column_or_null, match_key, split_part
from caretiers.functions.times import as_timestamp, day_start, instant, minutes_between

__all__ = [
    "as_number", "as_timestamp", "code", "column_or_null", "day_start", "first_item", "instant",
    "last_where", "match_key", "minutes_between", "split_part",
]
