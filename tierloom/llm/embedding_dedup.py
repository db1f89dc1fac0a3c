"""Near-duplicate embeddings by Euclidean p-stable hashing and exact cosines.

Normalised vectors are projected on random Gaussian directions, shifted and cut into cells of one width; the cells of
``bits`` directions together are a bucket, in each of ``TABLES`` tables. Unit vectors with a cosine of at
least 0.98 are at most 0.2 apart and share one cell with a probability of at least 0.92.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tierloom.llm.common import grouped, shuffle_partitions, stored
from tierloom.llm.components import components
from tierloom.llm.ngram_join import forest_of, in_blocks
from tierloom.llm.words import mix

THRESHOLD = 0.98
WIDTH = 2.0
#: Chance that a pair just at the threshold shares no bucket, and that two unrelated (orthogonal) vectors share one.
MISS = 1e-4
BLOCK = 1024
SEED = 20


def same_cell(distance: float, width: float = WIDTH) -> float:
    """Probability that two vectors at ``distance`` fall into one cell of one random direction."""
    r = width / distance
    return math.erf(r / math.sqrt(2)) - math.sqrt(2 / math.pi) / r * (1 - math.exp(-r * r / 2))


def shape(n: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """Directions of a bucket, and tables, for ``n`` vectors.

    Directions grow with the logarithm of ``n``, so that a vector meets about as many unrelated ones at any size; tables
    are as many as the chance ``MISS`` of losing a pair at the threshold asks for.
    """
    near, far = same_cell(math.sqrt(2 - 2 * threshold)), same_cell(math.sqrt(2))
    bits = max(8, math.ceil(math.log(1 / (20 * max(n, 1))) / math.log(far)))
    return bits, math.ceil(math.log(MISS) / math.log(1 - near**bits))


def _unit(vectors: list) -> np.ndarray:
    x = np.array(vectors, dtype=np.float64)
    x = x / np.abs(x).max(axis=1)[:, None]  # so that squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def _hashed(bits: int, tables: int):
    """Buckets of each vector; none for a vector that links with nothing. Vectors of other lengths never meet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            vectors, labels = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            out: list = [None] * len(vectors)
            by_length: dict[int, list[int]] = {}
            for i, v in enumerate(vectors):
                by_length.setdefault(len(v), []).append(i)
            for length, rows in by_length.items():
                if length not in made:
                    rng = np.random.default_rng([SEED, length])
                    made[length] = rng.standard_normal((length, bits * tables)), rng.uniform(0, WIDTH, bits * tables)
                directions, shifts = made[length]
                for k in range(0, len(rows), 1024):
                    some = rows[k : k + 1024]
                    cells = np.floor((_unit([vectors[i] for i in some]) @ directions + shifts) / WIDTH).astype(np.int64).view(np.uint64)
                    cells = cells.reshape(len(some), tables, bits)
                    keys = np.arange(tables, dtype=np.uint64) + np.uint64(length) * np.uint64(1 << 20)
                    keys = mix(keys[None, :] ^ mix(np.array([labels[i] for i in some], np.int64).view(np.uint64))[:, None])
                    for b in range(bits):
                        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + cells[:, :, b])
                    for i, row in zip(some, keys.view(np.int64)):
                        out[i] = row
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.int64()))], ["node", "buckets"])

    return run


def _close(threshold: float, keys: list[str], count: bool):
    """Spanning edges, and with ``count`` the links, of the pairs of each group whose cosine reaches the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, keys):
            if group.num_rows < 2:
                continue
            nodes = group.column("node").to_pylist()
            vectors, labels = group.column("vector").to_pylist(), group.column("label").to_pylist()
            if len({len(v) for v in vectors}) > 1 or len(set(labels)) > 1:
                raise ValueError("vectors of different lengths or labels in one group")
            x = _unit(vectors)
            like = x @ x.T >= threshold
            if group.column("i")[0].as_py() != group.column("j")[0].as_py():
                own = np.array(group.column("own").to_pylist())
                like &= own[:, None] != own[None, :]
            np.fill_diagonal(like, False)
            some = np.flatnonzero(like.any(axis=1))
            if len(some) == 0:
                continue
            first = forest_of(len(nodes), lambda k, others: like[k, others])
            links = like @ np.array(group.column("copies").to_pylist(), np.int64) if count else np.zeros(len(nodes), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([nodes[k] for k in some], pa.binary()), pa.array(links[some].astype(np.int64)), pa.array([nodes[first[k]] for k in some], pa.binary())],
                ["node", "links", "to"],
            )

    return run


def _label(vectors: DataFrame, label_column: str) -> Column:
    """A label as a number: whole numbers as they are, other labels by 64 bits of their text."""
    label = F.col(label_column)
    whole = isinstance(vectors.schema[label_column].dataType, IntegralType)
    return label.cast("long") if whole else F.when(label.isNotNull(), F.xxhash64(label.cast("string")))


LINKS = "node binary, links long, to binary"


def similar_vectors(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label", threshold: float = THRESHOLD
) -> DataFrame:
    """``id, n_links, component_id, kept`` for every row of ``vectors``.

    Two vectors are linked if their labels are equal and not NULL and their cosine in double precision is at least
    ``threshold``. ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest id reachable by
    links, ``kept`` says whether that is the row's own id.

    * A vector that is NULL, empty, all zero or holds a NULL or non-finite component links with nothing, as does
      one without a label; such a row is its own component and kept.
    * Equal vectors are one with a number of copies, however many there are. Rows that repeat an id are copies too.
    * Labels may be of any type: 1.2 and 1.7 are two labels, and so are texts that differ. Ids may be too, if they have an order.
    * Vectors of different lengths never link. Other columns are ignored.

    Buckets are shuffled as ids first; vectors follow only into buckets of at least two. Components are
    exact in what they link: every pair of a component is computed once, in blocks.
    """
    width = shuffle_partitions(vectors.sparkSession)
    vector = F.col(vector_column)
    usable = (
        vector.isNotNull() & F.col(label_column).isNotNull() & ~F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
        & F.exists(vector, lambda c: c != 0)
    )
    rows = vectors.select(
        F.col(id_column).alias("id"), _label(vectors, label_column).alias("label"), vector.cast("array<double>").alias("vector"), F.coalesce(usable, F.lit(False)).alias("usable")
    )
    rows = rows.withColumn("node", F.when(F.col("usable"), F.unhex(F.sha2(F.concat_ws(",", F.col("label").cast("string"), F.col("vector").cast("array<string>")), 224))))
    rows = stored(rows.select("id", "node", "label", F.when(F.col("usable"), F.col("vector")).alias("vector")), "vectors")
    distinct = rows.where("node IS NOT NULL").groupBy("node").agg(
        F.count("*").alias("copies"), F.min("id").alias("least_id"), F.min("label").alias("label"), F.min("vector").alias("vector")
    )
    distinct = stored(distinct, "distinct")

    bits, tables = shape(distinct.count(), threshold)
    buckets = distinct.select("node", "vector", "label").mapInArrow(_hashed(bits, tables), "node binary, buckets array<long>")
    buckets = stored(buckets, "buckets").select("node", F.explode("buckets").alias("bucket"))
    met = buckets.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    blocks = in_blocks(buckets.join(met, "bucket"), "members", "node", BLOCK)
    blocks = blocks.join(distinct.select("node", "label", "vector", "copies"), "node").repartition(width, "bucket", "i", "j")
    close = blocks.sortWithinPartitions("bucket", "i", "j").mapInArrow(_close(threshold, ["bucket", "i", "j"], False), LINKS)
    found = stored(components(close.select(F.col("node").alias("a"), F.col("to").alias("b"))), "found")

    size = stored(found.groupBy("component").agg(F.count("*").alias("members")), "sizes")
    members = found.join(size, "component").join(distinct, "node")
    blocks = in_blocks(members, "members", "node", BLOCK).repartition(width, "component", "i", "j").sortWithinPartitions("component", "i", "j")
    links = blocks.mapInArrow(_close(threshold, ["component", "i", "j"], True), LINKS).groupBy("node").agg(F.sum("links").alias("links"))
    about = distinct.select("node", "copies", "least_id").join(links, "node", "left").join(found, "node", "left")

    about = stored(about.select("node", "least_id", F.coalesce("component", "node").alias("class"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links")), "about")
    leads = stored(about.groupBy("class").agg(F.min("least_id").alias("class_id")), "leads")
    about = stored(about.join(leads, "class").select("node", "links", "class_id"), "about")
    component = F.when(F.col("links").isNull(), F.col("id")).otherwise(F.col("class_id"))
    return rows.select("id", "node").join(about, "node", "left").select(
        F.col("id").alias(id_column), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
