"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierloom.functions.collation import key

_RANK = "_rank_in_key"


def _rest(df: DataFrame, taken: Sequence[str]) -> list[str]:
    return [name for name in df.columns if name not in taken]


def _first_row(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], collation: str | None = None
) -> DataFrame:
    """First row of every key. The rank filter is pushed below the shuffle (``WindowGroupLimit``), so
    each map task sends at most one row per key, however many rows a hot key has."""
    by_key = Window.partitionBy(*(key(F.col(k), collation) for k in keys))
    ranked = df.withColumn(_RANK, F.row_number().over(by_key.orderBy(*order)))
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK)


def latest_per_key(
    df: DataFrame, keys: Sequence[str], latest: str, tiebreak: Sequence[str] | None = None,
    collation: str | None = None,
) -> DataFrame:
    """Row with the greatest ``latest`` per key; a NULL there loses against any value.

    Rows that tie are ordered by ``tiebreak`` ascending, by default by all other columns, so the
    result does not depend on how the input was split. A NULL key is a key like any other. With a
    ``collation``, keys must be text; they are one key if it takes them for equal, and their spelling
    is the last tiebreak.
    """
    ties = _rest(df, [*keys, latest]) if tiebreak is None else tiebreak
    spelling = keys if collation else ()
    order = [F.col(latest).desc_nulls_last(), *(F.col(c).asc_nulls_first() for c in [*ties, *spelling])]
    return _first_row(df, keys, order, collation)


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None, collation: str | None = None
) -> DataFrame:
    """First row per key in ``order``, by default in ascending order of all other columns. ``collation``
    is as in :func:`latest_per_key`.

    For "first in the file", pass the position column the landing reader adds on request.
    """
    columns = [*(_rest(df, keys) if order is None else order), *(keys if collation else ())]
    return _first_row(df, keys, [F.col(c).asc_nulls_first() for c in columns], collation)
