"""Rows and the keys they refer to.

No join here carries a broadcast hint: the referenced side may be of any size. Spark broadcasts it
when its size is under the session's threshold and otherwise joins by shuffle, where adaptive
execution splits the partition of a hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierloom.functions.collation import key as collated
from tierloom.functions.flags import flag


def _keys(reference: DataFrame, key: str, collation: str | None) -> DataFrame:
    known = reference.select(collated(F.col(key), collation).alias("_known_key"))
    return known.filter(F.col("_known_key").isNotNull())


def exclude_orphans(
    df: DataFrame, foreign_key: str, reference: DataFrame, key: str, collation: str | None = None
) -> DataFrame:
    """Rows whose foreign key is there and exists in ``reference``. With a ``collation``, keys are texts
    and compared by it, here as below."""
    same = collated(F.col(foreign_key), collation) == F.col("_known_key")
    return df.join(_keys(reference, key, collation), same, "left_semi")


def flag_missing_ref(
    df: DataFrame, foreign_key: str, reference: DataFrame, key: str, name: str, collation: str | None = None
) -> DataFrame:
    """Add ``name``: 1 where the foreign key is NULL or not in ``reference``, else 0.

    A left join to the distinct keys rather than ``NOT IN``, which Spark can only run by comparing
    every row with every key. NULLs in ``reference`` do not count as keys.
    """
    known = _keys(reference, key, collation).distinct()
    joined = df.join(known, collated(F.col(foreign_key), collation) == F.col("_known_key"), "left")
    return joined.withColumn(name, flag(F.col("_known_key").isNull())).drop("_known_key")


def resolve(
    df: DataFrame, foreign_key: str, dimension: DataFrame, key: str, collation: str | None = None
) -> DataFrame:
    """Left join of a fact to a dimension: every row stays, unresolved ones get NULLs. Under a ``collation``, dimension keys
    that it takes for equal each match."""
    same = collated(df[foreign_key], collation) == collated(dimension[key], collation)
    return df.join(dimension, same, "left")
