"""Column functions that put values into a fixed vocabulary.

Vocabularies are small and fixed, so each becomes one literal map inside the expression: no join, no
broadcast, and the whole lookup stays in the projection of the scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def _lookup(key: Column, labels: Mapping[str, Sequence[str]]) -> Column:
    pairs = ((spelling, label) for label, spellings in labels.items() for spelling in spellings)
    return F.try_element_at(F.create_map(*(F.lit(v) for v in chain.from_iterable(pairs))), key)


def canonicalize(c: Column, labels: Mapping[str, Sequence[str]], default: str | None) -> Column:
    """Label whose spellings contain the folded text, else ``default``, or the trimmed text if that
    is ``None``. ``labels`` maps each label to its spellings in trimmed upper case."""
    label = _lookup(F.upper(F.trim(c)), labels)
    return F.coalesce(label, F.trim(c) if default is None else F.lit(default))


def map_codes(c: Column, codes: Mapping[str, Sequence[str]], default: str) -> Column:
    """Label of a one-letter code; the same lookup as :func:`canonicalize`, always with a default."""
    return canonicalize(c, codes, default)


def group_label(c: Column, groups: Mapping[str, Sequence[str]], default: str) -> Column:
    """Group that lists the value exactly as written, else ``default``."""
    return F.coalesce(_lookup(c, groups), F.lit(default))


def band(c: Column, cuts: Sequence[int], labels: Sequence[str]) -> Column:
    """Label of the first cut the number lies under; the last label takes the rest, NULL included."""
    if len(labels) != len(cuts) + 1:
        raise ValueError("one more label than cuts is needed")
    choice = F
    for cut, label in zip(cuts, labels):
        choice = choice.when(c < cut, F.lit(label))
    return choice.otherwise(F.lit(labels[-1]))


def prefer(primary: Column, fallback: Column, missing: str) -> Column:
    """``primary`` unless NULL or ``missing``, then ``fallback``, then ``missing`` itself."""
    return F.coalesce(F.nullif(primary, F.lit(missing)), fallback, F.lit(missing))
