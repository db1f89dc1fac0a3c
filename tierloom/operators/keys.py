"""Dense surrogate keys without a single-partition sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierloom.session import new_table_path

_POSITION = "_sorted_position"
_PARTITION = "_sorted_partition"
_PARTITION_SHIFT = 33  # monotonically_increasing_id keeps the partition above this bit


def surrogate_key(
    df: DataFrame, order_by: Sequence[str], name: str, path: str | None = None
) -> DataFrame:
    """Put a key 1..n in front of the columns, in the order of ``order_by`` (NULLs first).

    ``row_number()`` over everything would pull all rows into one task. Instead the rows are sorted
    by range across the cluster and stored once with partition and place, so that nothing which is
    recomputed later can renumber them. The rows per partition, summed up, give every partition's offset, a
    table of one small row for each; a key is then offset plus place. Nothing comes to the driver.

    ``order_by`` should tell rows apart, which also keeps ranges even when one leading value is very
    common. ``path`` is where the table goes, by default a new folder under the shared one.
    """
    spark = df.sparkSession
    path = path or new_table_path(spark, "surrogate-key")
    (
        df.orderBy(*(F.col(c).asc_nulls_first() for c in order_by))
        .withColumn(_POSITION, F.monotonically_increasing_id())
        .write.mode("overwrite")
        .parquet(path)
    )
    stored = spark.read.parquet(path)

    numbered = stored.withColumn(_PARTITION, F.shiftright(_POSITION, _PARTITION_SHIFT))
    sizes = numbered.groupBy(_PARTITION).agg(F.count("*").alias("_rows"))
    before = Window.orderBy(_PARTITION).rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition
    offsets = sizes.select(_PARTITION, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    place = F.col(_POSITION).bitwiseAND(F.lit((1 << _PARTITION_SHIFT) - 1))
    return numbered.join(offsets, _PARTITION).select(
        (F.col("_offset") + place + 1).alias(name), *(c for c in stored.columns if c != _POSITION)
    )
