"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tierloom.session import new_table_path

#: A word of the contracts: a run of characters that are no ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and no lineage to repeat."""
    spark = df.sparkSession
    path = new_table_path(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold_of(id_column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; NULL for a NULL id."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % folds


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal ``keys``, from batches sorted by them. One group is in memory at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        columns = [batch.column(k).to_pylist() for k in keys]
        rows = list(zip(*columns))
        start = 0
        for i, row in enumerate(rows):
            if row != last:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, start, last = [], i, row
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def slices_by_bytes(texts: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold about ``most`` bytes together; a longer text has a range of its own."""
    ends = np.cumsum(np.frombuffer(_lengths(texts), dtype=np.int64))
    start, n = 0, len(texts)
    while start < n:
        base = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield start, min(stop, n)
        start = stop


def _lengths(texts: pa.Array) -> bytes:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64()).to_numpy(zero_copy_only=False).tobytes()


def utf8_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and the n + 1 offsets of the texts in them. NULL is empty."""
    import pyarrow.compute as pc

    return binary_bytes(pc.fill_null(texts.cast(pa.large_string()), ""))


def binary_bytes(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values in a row, none of them NULL, and the n + 1 offsets of the values in them."""
    wide = values if pa.types.is_large_string(values.type) else values.cast(pa.large_binary())
    offsets = np.frombuffer(wide.buffers()[1], dtype=np.int64)[wide.offset : wide.offset + len(wide) + 1]
    if len(wide) == 0 or wide.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(wide) + 1, np.int64)
    data = np.frombuffer(wide.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def carried(docs: DataFrame, id_column: str, whole: bool) -> tuple[Column, StructField]:
    """What an operator hands on of each row beside its results: the id as a number, or the ``whole`` row as the struct ``row``."""
    if whole:
        return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), StructField("row", StructType(docs.schema.fields))
    return F.col(id_column).cast("long").alias(id_column), StructField(id_column, LongType())
