"""Keys compared as the source dialect does: letters by lower case, blanks at the end ignored."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Collation of the source dialect. ``None`` as a collation means that keys are compared as they are.
SOURCE = "UTF8_LCASE_RTRIM"


def key(c: Column, collation: str | None) -> Column:
    """``c`` as a key; with a collation it must be text. Comparing, grouping and joining then follow the collation."""
    return c if collation is None else F.collate(c, collation)


def plain(c: Column) -> Column:
    """A collated column compared as it is again."""
    return F.collate(c, "UTF8_BINARY")


def folded(c: Column) -> Column:
    """Text of its own for all texts that :data:`SOURCE` takes for one."""
    return F.lower(F.rtrim(c))
