"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

A source is cut into blocks of documents by a seeded hash. What the mix takes of it, whole passes over its blocks and a
part of one more, are its units. A binary tree over the output shards splits the counts of units of all sources at once,
by multivariate-hypergeometric draws, until each shard has its exact quota of each source. Shards then take disjoint
runs of a permutation of the source's units, and shuffle what they got.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierloom.llm.common import WORD, shuffle_partitions, stored

SEED = 11
WEIGHTS = (3, 1, 2)
#: Words of the mix against those of all documents, and of a source's target against the source's own.
SHARE, MOST = 1.5, 2.0
SHARDS = 8
#: Blocks of a source. Only the block in which the last pass ends is ordered document by document.
BLOCKS = 1024
_TOP = 1 << 40


def targets(sizes: list[int], weights: list[float], share: float = SHARE, most: float = MOST) -> list[float]:
    """Words to take of each source: by weight, stopped at ``most`` times its size, the excess dealt to the rest again."""
    out: list[float] = [0.0] * len(sizes)
    left, open_ = share * sum(sizes), [i for i in range(len(sizes)) if sizes[i] > 0]
    while open_:
        whole = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / whole > most * sizes[i]]
        if not over:
            for i in open_:
                out[i] = left * weights[i] / whole
            break
        for i in over:
            out[i] = most * sizes[i]
        left -= sum(out[i] for i in over)
        open_ = [i for i in open_ if i not in set(over)]
    return out


def split(units: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Units of each source (row) that each shard (column) gets; every shard has as many units, but for one."""
    quotas = np.zeros((len(units), shards), np.int64)

    def deal(have: np.ndarray, low: int, high: int) -> None:
        if high - low == 1:
            quotas[:, low] = have
            return
        middle = (low + high) // 2
        total = int(have.sum())
        rng = np.random.default_rng([seed, low, high])
        left = _drawn(rng, have, total * (middle - low) // (high - low))
        deal(left, low, middle)
        deal(have - left, middle, high)

    deal(units.astype(np.int64), 0, shards)
    return quotas


def _drawn(rng: np.random.Generator, have: np.ndarray, n: int) -> np.ndarray:
    """A multivariate-hypergeometric draw, one source after the other."""
    out, rest = np.zeros_like(have), int(have.sum())
    for i, own in enumerate(have.tolist()):
        rest -= own
        out[i] = rng.hypergeometric(own, rest, n) if own and n else 0
        n -= int(out[i])
    return out


@dataclass
class Mixture:
    """How often, and for which shards, each row is drawn. Rows are told by their source and place, as in ``_placed``."""

    sources: DataFrame

    def drawn(self, rows: DataFrame) -> DataFrame:
        """``rows`` (source, place, size, ...) with source_size, target, copies and the shards of the copies."""
        joined = rows.join(self.sources, rows["source"].eqNullSafe(self.sources["of"]), "left").drop("of")
        copies = F.col("passes") + F.when(F.col("place") <= F.col("cut"), 1).otherwise(0)
        joined = joined.withColumn("copies", F.coalesce(copies, F.lit(0)).cast("int"))
        shards = F.expr(
            f"transform(slice(sequence(0, greatest(copies, 1) - 1), 1, copies), c -> size(filter(bounds, b -> b <= (step * (c * {BLOCKS}L + place * {BLOCKS}L div {_TOP}L) + shift) % units)))"
        )
        return joined.withColumn("shards", shards).drop("passes", "cut", "bounds", "step", "shift", "units")


def located(docs: DataFrame, id_column: str, text_column: str, source_column: str, seed: int) -> list[Column]:
    """source, size in words, and the key of its place among its source's rows, a seeded hash; see ``_placed``."""
    words = F.regexp_count(F.col(text_column), F.lit(WORD))
    key = F.xxhash64(F.lit(seed), F.col(id_column), F.col(text_column))
    return [F.col(source_column).alias("source"), F.coalesce(words, F.lit(0)).cast("long").alias("size"), key.alias("key")]


def _placed(rows: DataFrame) -> DataFrame:
    """``rows`` (key, source, ...) with their place instead of the key.

    Rows that repeat an id and text have a place each, by their ordinal among such rows of their partition. They are stored,
    so that all who read them see one place.
    """
    place = F.pmod(F.col("key"), F.lit(_TOP)).alias("place")
    others = [c for c in rows.columns if c != "key"]
    repeated = stored(rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "repeated")
    if repeated.isEmpty():
        return rows.select(*others, place)
    again = rows.join(repeated, "key", "left_semi").sortWithinPartitions("key", "source", F.xxhash64(*[F.col(c).cast("string") for c in others]))
    again = again.withColumn("key", F.xxhash64("key", F.monotonically_increasing_id()))
    again = stored(again.select(*others, place), "again")
    return rows.join(repeated, "key", "left_anti").select(*others, place).unionByName(again)


def mixture(rows: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, shards: int = SHARDS, seed: int = SEED) -> Mixture:
    """The plan for ``rows`` (source, size, place; a stored table, as it is read three times).

    Sources in order of code points, NULL last, have ``weights`` in turn. Whole passes over a source are the whole multiple of
    its size in its target; the rest is taken in order of places up to the document nearest to it. The driver holds a few numbers for each source and
    shard: sources are named sets of data, not keys of rows.
    """
    spark = rows.sparkSession
    blocks = rows.groupBy("source", F.expr(f"place * {BLOCKS}L div {_TOP}L").alias("block")).agg(F.sum("size").alias("words"))
    blocks = stored(blocks, "blocks")
    sizes = {r["source"]: int(r["words"]) for r in blocks.groupBy("source").agg(F.sum("words").alias("words")).collect()}
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = [weights[i % len(weights)] for i in range(len(names))]
    target = targets([sizes[s] for s in names], weight, share, most)
    passes = [int(t // sizes[s]) if sizes[s] else 0 for s, t in zip(names, target)]
    rest = [t - p * sizes[s] for s, t, p in zip(names, target, passes)]

    wanted = spark.createDataFrame([*zip(names, rest)] or [(None, 0.0)], "of string, rest double")
    sums = blocks.withColumn("before", F.coalesce(F.sum("words").over(Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    last = sums.join(wanted, sums["source"].eqNullSafe(wanted["of"])).where("rest > 0 AND before < rest AND before + words >= rest")
    ends = last.select(F.col("source").alias("of"), F.col("block").alias("end_block"), (F.col("rest") - F.col("before")).alias("left"))
    inside = rows.join(ends, rows["source"].eqNullSafe(ends["of"]) & (F.expr(f"place * {BLOCKS}L div {_TOP}L") == F.col("end_block")))
    order = Window.partitionBy("source").orderBy("place")
    inside = inside.withColumn("upto", F.sum("size").over(order))  # rows of one place together
    near = inside.where("upto - size / 2 <= left").groupBy("source", "end_block").agg(F.max("place").alias("cut"))
    cuts = {r["source"]: r["cut"] for r in near.collect()}
    first = {r["of"]: -(-int(r["end_block"]) * _TOP // BLOCKS) - 1 for r in ends.collect()}

    # where even the first document of the last block is too large, the pass ends before it
    cut = [cuts.get(s, first.get(s, -1)) if r > 0 else -1 for s, r in zip(names, rest)]
    units = [p * BLOCKS + (c * BLOCKS // _TOP + 1 if c >= 0 else 0) for p, c in zip(passes, cut)]
    quotas = split(np.array(units, np.int64), shards, seed) if names else np.zeros((0, shards), np.int64)
    table = []
    for i, name in enumerate(names):
        n = max(1, units[i])
        rng = np.random.default_rng([seed, i])
        step = next(k for k in (int(x) for x in rng.integers(1, n + 1, 10_000)) if math.gcd(k, n) == 1)
        bounds = np.cumsum(quotas[i])[:-1].tolist()
        table.append((name, sizes[name], target[i], passes[i], cut[i], bounds, step, int(rng.integers(0, n)), n))
    schema = "of string, source_size long, target double, passes int, cut long, bounds array<long>, step long, shift long, units long"
    return Mixture(spark.createDataFrame(table, schema))


def planned(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", **parameters) -> DataFrame:
    """``id, source, size, source_size, target, copies, taken, shards`` for every row of ``docs``.

    ``size`` is the number of words (0 for NULL), ``taken`` the words the mix takes of the row, repeats counted, ``shards``
    the output shard of each copy. A NULL source is a source. Rows of no words are in the mix as often as their place says. Rows that repeat an id and
    text are drawn one by one, so a pass may end among them. Reruns over the same partitions draw the same. An empty table gives no rows. Other columns are ignored.
    """
    seed = parameters.get("seed", SEED)
    rows = docs.select(F.col(id_column).cast("long").alias("id"), *located(docs, id_column, text_column, source_column, seed))
    rows = stored(_placed(rows), "located")
    out = mixture(rows, **parameters).drawn(rows)
    return out.select(
        F.col("id").alias(id_column), "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"), "shards"
    )


def mixed(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", **parameters) -> DataFrame:
    """``shard, copy, row``: the rows of the mix (``row`` is the whole row of ``docs``), each shard's in shuffled order.

    A shard is many partitions, none larger than its share of the rows. Cases are as in ``planned``.
    """
    seed = parameters.get("seed", SEED)
    columns = located(docs, id_column, text_column, source_column, seed)
    whole = _placed(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *columns))
    drawn = mixture(stored(whole.select("source", "size", "place"), "located"), **parameters).drawn(whole)
    copies = drawn.select("row", "place", F.posexplode("shards").alias("copy", "shard"))
    copies = copies.withColumn("turn", F.xxhash64(F.lit(seed), "place", "copy"))
    width = shuffle_partitions(docs.sparkSession)
    copies = copies.repartition(width, "shard", F.pmod("turn", F.lit(max(1, width // 4)))).sortWithinPartitions("shard", "turn")
    return copies.select("shard", "copy", "row")
