"""Column profiles from mergeable sketches.

One aggregate over a table gives a sketch of every column: a HyperLogLog of its distinct values and the items that occur most.
What is shuffled is one row for each task, however many values there are. Sketches of parts, such as daily loads, can be
stored and merged later without the parts.
"""

from __future__ import annotations

import math
from collections.abc import Collection, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierloom.operators.quality import column_profile

#: Registers of a HyperLogLog, as a power of two; items a sketch of frequent values tracks.
BITS, TRACKED = 14, 512
#: Columns of fewer distinct values are counted exactly.
SMALL = 10_000


def relative_error(bits: int = BITS) -> float:
    """Standard error of the number of distinct values, relative to it."""
    return 1.04 / math.sqrt(2**bits)


def column_sketches(df: DataFrame, columns: Sequence[str], bits: int = BITS, tracked: int = TRACKED) -> DataFrame:
    """``column_name, row_count, null_count, blank_count, distinct_sketch, items_sketch``, a row for each column.

    Values are taken as text. Rows, NULLs and blanks are exact. An empty table has columns of no rows.
    """
    aggregates = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(columns):
        text = F.col(f"v{i}")
        aggregates += [
            F.count(text).alias(f"n{i}"), F.count_if(F.trim(text) == "").alias(f"b{i}"), F.hll_sketch_agg(F.concat(F.lit("."), text), bits).alias(f"d{i}"),  # an empty text would not be counted
            F.expr(f"approx_top_k_accumulate(v{i}, {tracked})").alias(f"t{i}"),
        ]
    counted = df.select(*(F.col(c).cast("string").alias(f"v{i}") for i, c in enumerate(columns))).agg(*aggregates)
    lines = [
        F.struct(
            F.lit(c).alias("column_name"), F.col("rows").alias("row_count"), (F.col("rows") - F.col(f"n{i}")).alias("null_count"),
            F.col(f"b{i}").alias("blank_count"), F.col(f"d{i}").alias("distinct_sketch"), F.col(f"t{i}").alias("items_sketch"),
        )
        for i, c in enumerate(columns)
    ]
    return counted.select(F.inline(F.array(*lines)))


def merged_sketches(parts: Sequence[DataFrame], tracked: int = TRACKED) -> DataFrame:
    """The sketches of a table from those of its parts."""
    return reduce(DataFrame.unionByName, parts).groupBy("column_name").agg(
        *(F.sum(c).alias(c) for c in ("row_count", "null_count", "blank_count")),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.expr(f"approx_top_k_combine(items_sketch, {tracked})").alias("items_sketch"),
    )


def sketched_profile(sketches: DataFrame, top: int = 10) -> DataFrame:
    """``column_name, row_count, null_count, blank_count, distinct_estimate, frequent``: the ``top`` values that occur most, with
    their counts. The estimate's standard error is :func:`relative_error`; counts are exact for columns of fewer than three
    quarters of the tracked items, and for others short of the truth by a share of the rows at most."""
    return sketches.select(
        "column_name", "row_count", "null_count", "blank_count", F.hll_sketch_estimate("distinct_sketch").alias("distinct_estimate"),
        F.expr(f"slice(filter(approx_top_k_estimate(items_sketch, {top + 1}), x -> x.item is not null), 1, {top})").alias("frequent"),
    )


def adaptive_profile(df: DataFrame, columns: Sequence[str], small: int = SMALL, exact: Collection[str] = ()) -> DataFrame:
    """The columns of :func:`tierloom.operators.quality.column_profile` and ``is_exact``.

    Sketches come first; columns that they take to have ``small`` distinct values at most, and those named in ``exact``, are then
    counted exactly. The values of the others are never shuffled.
    """
    estimates = sketched_profile(column_sketches(df, columns), 1).drop("frequent").collect()  # a row for each column
    chosen = [r["column_name"] for r in estimates if r["distinct_estimate"] <= small or r["column_name"] in exact]
    rest = [r for r in estimates if r["column_name"] not in chosen]
    lines = [
        (r["column_name"], r["row_count"], r["null_count"], r["blank_count"], d, r["row_count"] - r["null_count"] - d, False)
        for r in rest for d in [min(r["distinct_estimate"], r["row_count"] - r["null_count"])]
    ]
    schema = "column_name string, row_count bigint, null_count bigint, blank_count bigint, distinct_count bigint, repeated_count bigint, is_exact boolean"
    estimated = df.sparkSession.createDataFrame(lines, schema)
    if not chosen:
        return estimated
    return estimated.unionByName(column_profile(df, chosen).withColumn("is_exact", F.lit(True)))
