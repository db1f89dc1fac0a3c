"""Validity intervals of versioned rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, FloatType, IntegerType, StructField, StructType

from tierloom.session import new_table_path


def validity_intervals(
    df: DataFrame,
    keys: Sequence[str],
    start: str,
    tiebreak: Sequence[str],
    end: str = "valid_to",
) -> DataFrame:
    """Add ``end``: the day before the next version of the same key starts, NULL for the last one.

    Versions of a key follow each other by ``start`` and then by ``tiebreak``, which together must
    tell them apart. Versions that start on the same day end the day before it, all but the last.

    A window over whole keys would sort a hot key in one task. Here rows are first reduced to one per
    key and start day, with partial aggregation before the shuffle, so that what the window sees of
    one key is limited by the calendar. The rows themselves meet their successor's day in a join on
    key and day, which adaptive execution broadcasts or splits where it is skewed.
    """
    day = F.col(start).cast("date")
    position = F.struct(*(F.col(c) for c in [start, *tiebreak]))
    by_key = Window.partitionBy(*keys).orderBy(F.col("_day").asc_nulls_first())
    days = (
        df.groupBy(*keys, day.alias("_day"))
        .agg(F.max(position).alias("_last_of_day"))
        .withColumn("_next_day", F.lead("_day").over(by_key))
    )

    versions, successors = df.alias("v"), days.alias("s")
    same_day = F.col("v." + start).cast("date").eqNullSafe(F.col("s._day"))
    for key in keys:
        same_day &= F.col("v." + key).eqNullSafe(F.col("s." + key))
    is_last = F.struct(*(F.col("v." + c) for c in [start, *tiebreak])) == F.col("s._last_of_day")
    following = F.when(is_last, F.col("s._next_day")).otherwise(F.col("s._day"))
    return versions.join(successors, same_day, "left").select(
        "v.*", F.date_sub(following, 1).alias(end)
    )


def validity_intervals_by_range(
    df: DataFrame,
    keys: Sequence[str],
    start: str,
    tiebreak: Sequence[str],
    end: str = "valid_to",
    path: str | None = None,
) -> DataFrame:
    """As :func:`validity_intervals`, reading the rows once and shuffling them once.

    Rows are sorted by range on key, start and ``tiebreak``, so that a hot key fills as many ranges as
    its size asks for. Inside a range the next row is the successor; the last row of a range meets
    the first one of the next in a join of one row for each range. For rows that are dear to read
    or to derive; the rows pass through Arrow batches and are stored in between, under ``path`` or in a new
    folder under the shared one.

    NULL is a key like others; NULL starts come first. Keys are numbers, texts, dates or booleans, not
    floating-point numbers, whose NaN is equal to itself in Spark only. ``end`` must be a new column.
    """
    path = path or new_table_path(df.sparkSession, "validity-intervals")
    _ended_in_ranges(df, keys, start, tiebreak, end).write.mode("overwrite").parquet(path)
    rows = df.sparkSession.read.parquet(path)

    in_order = Window.orderBy(_RANGE)  # one row for each range
    firsts = rows.filter(F.col(_EDGE).isin(_FIRST, _ONLY))
    following = firsts.select(
        F.col(_RANGE).alias("_of"),
        F.lead(F.struct(*(_quoted(k).alias(f"k{i}") for i, k in enumerate(keys)))).over(in_order).alias("_next_key"),
        F.lead(_quoted(start).cast("date")).over(in_order).alias("_next_day"),
    )
    same_key = F.col("_next_key").isNotNull()
    for i, key in enumerate(keys):
        same_key &= _quoted(key).eqNullSafe(F.col(f"_next_key.k{i}"))
    lasts = rows.filter(F.col(_EDGE).isin(_LAST, _ONLY)).join(following, F.col(_RANGE) == F.col("_of"))
    ended = F.when(same_key, F.date_sub("_next_day", 1))

    inside = rows.filter(F.col(_EDGE).isin(_INSIDE, _FIRST)).drop(_RANGE, _EDGE)
    return inside.unionByName(lasts.select(*(_quoted(c) for c in df.columns), ended.alias(end)))


_RANGE, _EDGE, _DAY = "_vi_range", "_vi_edge", "_vi_day"
_INSIDE, _FIRST, _LAST, _ONLY = 0, 1, 2, 3


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def _ended_in_ranges(df: DataFrame, keys: Sequence[str], start: str, tiebreak: Sequence[str], end: str) -> DataFrame:
    """Rows sorted by range with ``end`` as far as the range shows it, its number, and which rows are at its edges."""
    if end in df.columns:
        raise ValueError(f"{end} is there already")
    floating = [k for k in keys if isinstance(df.schema[k].dataType, (FloatType, DoubleType))]
    if floating:
        raise TypeError(f"floating-point keys: {floating}")
    places = [df.columns.index(k) for k in keys]
    order = [_quoted(c).asc_nulls_first() for c in [*keys, start, *tiebreak]]
    added = [StructField(end, DateType()), StructField(_RANGE, IntegerType()), StructField(_EDGE, IntegerType())]
    names = [*df.columns, *(field.name for field in added)]

    def with_ends(rows: pa.RecordBatch, count: int, range_: int, is_first: bool, is_last: bool) -> pa.RecordBatch:
        """The first ``count`` rows; their successors are the rows after them, none after the last of a range."""
        days = rows.column(rows.num_columns - 1)
        if is_last:
            ends = pa.nulls(count, pa.date32())
        else:
            same = pa.array(np.ones(count, bool))
            for place in places:
                a, b = rows.column(place).slice(0, count), rows.column(place).slice(1, count)
                equal = pc.fill_null(pc.equal(a, b), False)
                same = pc.and_(same, pc.or_(equal, pc.and_(pc.is_null(a), pc.is_null(b))))
            before = pc.subtract(days.slice(1, count).cast(pa.int32()), pa.scalar(1, pa.int32()))
            ends = pc.if_else(same, before.cast(pa.date32()), pa.scalar(None, pa.date32()))
        edges = np.full(count, _INSIDE, np.int32)
        edges[0] += _FIRST * is_first
        edges[-1] += _LAST * is_last
        own = [column.slice(0, count) for column in rows.columns[:-1]]
        return pa.RecordBatch.from_arrays([*own, ends, pa.array(np.full(count, range_, np.int32)), pa.array(edges)], names)

    def of_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        range_ = TaskContext.get().partitionId()
        held, is_first = None, True
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            known = batch.num_rows - 1
            if known:
                yield with_ends(batch, known, range_, is_first, False)
                is_first = False
            held = batch.slice(known)
        if held is not None:
            yield with_ends(held, 1, range_, is_first, True)

    ranged = df.withColumn(_DAY, _quoted(start).cast("date")).repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = ranged.toDF(*(f"c{i}" for i in range(len(ranged.columns))))  # mapInArrow takes no names with dots
    return numbered.mapInArrow(of_range, StructType([*df.schema.fields, *added]))


def active_version(df: DataFrame, end: str = "valid_to") -> DataFrame:
    """Versions still valid: those without an end."""
    return df.filter(F.col(end).isNull())
