"""Column functions for dates.

Nothing here reads the clock unless asked to: functions that depend on "today" take ``as_of``.
Text is matched against its exact shape first and then cast, which keeps unreadable rows off the
slow exception path of formatter-based parsing and keeps the cast from accepting shorter forms.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two text shapes dates arrive in.
SLASH_DATE = "^[0-9]{2}/[0-9]{2}/[0-9]{4}$"  # month/day/year
ISO_DATE = "^ *[0-9]{4}-[0-9]{2}-[0-9]{2} *$"  # year-month-day


def as_of_date(as_of: datetime.date | str | Column | None) -> Column:
    """``as_of`` as a date column; ``None`` is today."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of.cast("date")
    return F.lit(str(as_of)).cast("date")


def parse_date_multi(c: Column) -> Column:
    """Date from ``MM/DD/YYYY`` or ``YYYY-MM-DD`` text; any other shape or impossible day is NULL."""
    month_day_year = F.concat(
        F.substring(c, 7, 4), F.lit("-"), F.substring(c, 1, 2), F.lit("-"), F.substring(c, 4, 2)
    )
    text = F.when(c.rlike(SLASH_DATE), month_day_year).when(c.rlike(ISO_DATE), c)
    return text.try_cast("date")


def parse_yyyymmdd(c: Column, strict: bool = False) -> Column:
    """Date from a whole number such as 20121228; 0, other lengths and impossible days are NULL.

    ``strict`` fails the query at an impossible day of the right length instead.

    Parts are taken by arithmetic, and only real days are made into dates: text of each number, and an exception for each
    impossible day, cost several times as much.
    """
    if strict:
        return _strict_yyyymmdd(c)
    year, month, day = F.call_function("div", c, F.lit(10000)), F.call_function("div", c, F.lit(100)) % 100, c % 100
    leap = (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))
    # months with 31 days are the odd ones to July and the even ones from August on
    last = F.when(month != 2, 30 + (month + F.call_function("div", month, F.lit(8))) % 2).when(leap, 29).otherwise(28)
    real = c.between(10000101, 99991231) & month.between(1, 12) & (day >= 1) & ((day <= 28) | (day <= last))
    return F.when(real, F.make_date(year.cast("int"), month.cast("int"), day.cast("int")))


def _strict_yyyymmdd(c: Column) -> Column:
    digits = c.cast("string")
    text = F.concat(
        F.substring(digits, 1, 4),
        F.lit("-"),
        F.substring(digits, 5, 2),
        F.lit("-"),
        F.substring(digits, 7, 2),
    )
    return F.when(F.length(digits) == 8, text.cast("date"))


def null_if_after(c: Column, as_of) -> Column:
    """The date, or NULL if it lies after ``as_of``."""
    return F.when(~(c > as_of_date(as_of)), c)


def days_between(start: Column, end: Column) -> Column:
    """Days from ``start`` to ``end``, negative if ``end`` is earlier."""
    return F.datediff(end, start)


def days_open(start: Column, end: Column, as_of) -> Column:
    """Days from ``start`` to ``end``; what has not ended yet is measured to ``as_of``."""
    return days_between(start, F.coalesce(end, as_of_date(as_of)))


def years_crossed(start: Column, end: Column) -> Column:
    """Turns of the year between two dates: 2020-12-31 to 2021-01-01 is 1."""
    return F.year(end) - F.year(start)
