"""Two-pass external shuffle of rows into shards, in DataFrame operations only.

Pass 1 scatters rows uniformly into buckets that fit in memory, by a seeded hash. Pass 2 permutes every bucket by a
Fisher-Yates shuffle and writes it. The buckets one after the other are a uniform permutation of all rows; shards
cut it into even parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StringType, StructType

from tierloom.llm.common import stored
from tierloom.session import new_table_path

SEED = 7
#: Bytes of rows in a bucket. Buckets are dealt out by their number, one to a task; larger executors may take larger ones.
BUCKET_BYTES = 16 << 20
#: Rows that repeat id and text are dealt out one by one if together they hold more than this part of a bucket.
REPEATED = 16


def row_bytes(docs: DataFrame) -> Column:
    """About the bytes of a row in memory, all columns counted."""
    size = F.lit(64)
    for field in docs.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (ArrayType, MapType, StructType)):
            column = column.cast("string")
        elif not isinstance(field.dataType, (StringType, BinaryType)):
            size = size + F.lit(16)
            continue
        size = size + F.coalesce(F.octet_length(column), F.lit(0))
    return size.cast("long")


def _has_map(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return any(_has_map(field.dataType) for field in kind.fields)
    return isinstance(kind, MapType) or isinstance(kind, ArrayType) and _has_map(kind.elementType)


def _placed(dealt: DataFrame, offsets: DataFrame, seed: int) -> DataFrame:
    """``offset, at, entry``: the rows of each bucket, permuted. ``offsets`` has one row for each bucket and goes to the
    buckets, so that their rows are not shuffled again."""
    gathered = dealt.groupBy("bucket").agg(F.collect_list(F.struct("place", "row")).alias("rows"))
    shuffled = gathered.select("bucket", F.shuffle("rows", seed).alias("rows"))
    return shuffled.join(F.broadcast(offsets), "bucket").select("offset", F.posexplode("rows").alias("at", "entry"))


def sharded(docs: DataFrame, shards: int, id_column: str = "doc_id", text_column: str = "text", seed: int = SEED, bucket_bytes: int = BUCKET_BYTES, folder: str | None = None) -> DataFrame:
    """``shard, slot, row``: every row of ``docs`` (the struct ``row``) at its place in one of ``shards`` shards.

    The law is ``rows``: counts of shards differ by one at most, and ``slot`` counts from 0 within a shard. Shards are
    written to ``folder`` (a new one in the shared folder), a directory each, and returned as written.

    * Rows are scattered by id and text, so many NULL or repeated ids are dealt out like others. Rows that repeat both
      share a bucket while they are small together; else each is scattered by its place among the repeated rows of
      its input partition, which is stored first. A rerun over the same partitions draws the same.
    * NULL and empty texts are rows like others; a very long row makes its bucket larger by its length.
    * An empty table gives no rows. Columns of ``docs`` stay in ``row``, so their names cannot clash; they may be of any type, maps included.

    The driver holds three numbers. Bucket counts, one row for each ``bucket_bytes`` of rows, are summed up by a window.
    """
    spark = docs.sparkSession
    place = F.xxhash64(F.lit(seed), F.col(id_column), F.col(text_column)).alias("place")
    keys = docs.select(place, row_bytes(docs).alias("size")).groupBy("place").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    repeated = (F.col("n") > 1) & (F.col("bytes") > bucket_bytes // REPEATED)
    n_rows, n_bytes, n_repeated = keys.agg(F.coalesce(F.sum("n"), F.lit(0)), F.sum("bytes"), F.count_if(repeated)).first()
    buckets = max(1, -(-int(n_bytes or 0) // bucket_bytes))
    rows = docs.select(place, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    # maps have no order of their own; their text has
    order = F.col("row").cast("string") if _has_map(docs.schema) else F.col("row")
    if n_repeated:
        many = stored(keys.where(repeated).select("place"), "repeated")
        # in a fixed order, whatever order a partition's rows came in; stored, so that counting and gathering see one salt
        salted = rows.join(many, "place", "left_semi").sortWithinPartitions("place", order)
        salted = stored(salted.select(F.xxhash64("place", F.monotonically_increasing_id()).alias("place"), "row"), "salted")
        rows = rows.join(many, "place", "left_anti").unionByName(salted)
    rows = rows.select(F.pmod("place", F.lit(buckets)).cast("int").alias("bucket"), "place", "row")

    counts = rows.groupBy("bucket").agg(F.count("*").alias("n"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))

    # rows of a bucket are gathered in a fixed order: a task that runs again draws the same
    dealt = rows.repartitionById(buckets, F.col("bucket")).sortWithinPartitions("bucket", "place", order)
    placed = _placed(dealt, offsets, seed)
    position = F.col("offset") + F.col("at")
    total, parts = F.lit(max(1, n_rows)), F.lit(shards)
    shard = F.expr(f"(offset + at) * {int(shards)} div {max(1, n_rows)}").cast("int")
    begins = F.ceil(F.col("shard") * total / parts)
    out = placed.select(shard.alias("shard"), position.alias("position"), F.col("entry.row").alias("row"))
    out = out.select("shard", (F.col("position") - begins).cast("long").alias("slot"), "row")

    folder = folder or new_table_path(spark, "shards")
    out.write.partitionBy("shard").parquet(folder)
    return spark.read.schema(out.schema).parquet(folder).select("shard", "slot", "row")
