"""0/1 flag columns. A comparison that is unknown because of a NULL gives 0."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierloom.functions.dates import as_of_date, days_between


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def flag_range(start: Column, end: Column) -> Column:
    """1 where a range ends before it starts."""
    return flag(end < start)


def flag_below(value: Column, level: Column) -> Column:
    """1 where a value is under its level."""
    return flag(value < level)


def flag_overdue(status: Column, opened: Column, as_of, days: int, done: str = "Closed") -> Column:
    """1 where an item is not ``done`` and was opened more than ``days`` before ``as_of``."""
    return flag((status != done) & (days_between(opened, as_of_date(as_of)) > days))
