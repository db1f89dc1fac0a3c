"""Column functions for text: trimming, defaults, key repair and names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierloom.functions.numbers import INTEGER_PATTERN


def clean_text(c: Column) -> Column:
    """Text without leading and trailing blanks."""
    return F.trim(c)


def upper_code(c: Column) -> Column:
    """A code in trimmed upper case, so that casing variants of one place become one value."""
    return F.upper(F.trim(c))


def blank_to_null(c: Column) -> Column:
    """Trimmed text; text of blanks only becomes NULL."""
    return F.nullif(F.trim(c), F.lit(""))


def default_text(c: Column, default: str) -> Column:
    """Trimmed text; NULL and blank text become ``default``."""
    return F.coalesce(blank_to_null(c), F.lit(default))


def strip_prefix(c: Column, prefix: str) -> Column:
    """Text without ``prefix`` where it starts with it, unchanged otherwise."""
    return F.when(c.startswith(prefix), c.substr(F.lit(len(prefix) + 1), F.length(c))).otherwise(c)


def swap_delimiter(c: Column, old: str, new: str) -> Column:
    """Every ``old`` replaced by ``new`` (an empty ``new`` removes the delimiter)."""
    return F.replace(c, F.lit(old), F.lit(new))


def category_part(c: Column) -> Column:
    """Category id of a composite product key: its first five characters, ``_`` for ``-``."""
    return swap_delimiter(F.substring(c, 1, 5), "-", "_")


def product_part(c: Column) -> Column:
    """Product key of a composite product key: everything after ``CC-CC-``."""
    return c.substr(F.lit(7), F.length(c))


def repair_key(c: Column, prefix: str) -> Column:
    """Product key as tickets cite it, repaired by the first rule that applies.

    Blank is NULL; a known prefix is cut off and the rest kept as it is; otherwise underscores become
    hyphens. The prefix is looked for in the untrimmed text.
    """
    text = blank_to_null(c)
    return F.when(
        c.startswith(prefix), text.substr(F.lit(len(prefix) + 1), F.length(c))
    ).otherwise(swap_delimiter(text, "_", "-"))


def null_if_suffix_above(c: Column, start: int, bound: int) -> Column:
    """Trimmed id, or NULL if blank or if the number from position ``start`` on is above ``bound``."""
    text = blank_to_null(c)
    suffix = text.substr(F.lit(start), F.length(text))
    number = F.when(suffix.rlike(INTEGER_PATTERN), suffix.try_cast("double"))  # of any number of digits
    return F.when(~F.coalesce(number > bound, F.lit(False)), text)


def full_name(first: Column, last: Column) -> Column:
    """``first last``; a missing part counts as empty text, the blank between them stays."""
    return F.concat(F.coalesce(first, F.lit("")), F.lit(" "), F.coalesce(last, F.lit("")))
