"""Connected components of a graph of any size, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierloom.llm.common import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node of ``edges``: the component is the smallest node in reach.

    Alternates two steps until every node hangs on the smallest one: every node sends its larger neighbours to the
    smallest node it knows, then its smaller ones. Both are a minimum per node (pre-aggregated before the shuffle)
    and a join back to the edges, so a node with very many neighbours is no task of its own: the join is one
    that adaptive execution splits. Each round is a table in the shared folder. The driver sees one
    number a round. Edges with a NULL end are ignored; without edges the result is empty.
    """
    now = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    now = stored(now.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not _settled(now):
        large = _to_smallest(now.union(now.select("b", "a").toDF("a", "b")), "b > a")
        now = stored(_to_smallest(large, "true"), "edges")
    roots = now.select(F.col("b").alias("a"), "b").distinct()
    return now.union(roots).toDF("node", "component")


def _settled(pairs: DataFrame) -> bool:
    """Whether every node has one smaller neighbour at most, and that one none."""
    ends = pairs.select("a", F.lit(1).alias("up"), F.lit(0).alias("down")).union(pairs.select("b", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("a").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where("up > 1 OR up = 1 AND down = 1").isEmpty()


#: A node with very many neighbours is spread over so many keys of the join, and further where those are still large.
SPREAD = 16


def _to_smallest(pairs: DataFrame, which: str) -> DataFrame:
    """Link what ``which`` chooses of each node's neighbours, and the node, to the smallest of them all."""
    least = pairs.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    spread = least.select("a", "m", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("s"))
    linked = pairs.withColumn("s", F.pmod(F.hash("b"), F.lit(SPREAD))).join(spread, ["a", "s"])
    moved = linked.where(which).select(F.col("b").alias("a"), F.col("m").alias("b"))
    if which == "true":
        moved = moved.union(least.toDF("a", "b"))
    return moved.where("a <> b").distinct()
