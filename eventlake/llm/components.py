"""Connected components of links by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.tables import alone, written


def _least(edges: DataFrame, rows: int) -> DataFrame:
    """For each `u`, the least of its `v` and itself; written, so that joins with it can split a hot `u`."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return written(least.select("u", F.least("u", "m").alias("m")), "least", rows)


def _large_star(edges: DataFrame, rows: int) -> DataFrame:
    """Every neighbour above u is linked to the least of u and its neighbours."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    moved = both.where("v > u").join(_least(both, 2 * rows), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.where("u <> v")


def _small_star(edges: DataFrame, rows: int) -> DataFrame:
    """Every u and its neighbours below it are linked to the least of them; in `edges`, u is above v."""
    least = _least(edges, rows)
    below = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return below.unionAll(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every node has one edge down, to a node that has none."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionAll(edges.select(F.col("v").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    nodes = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return nodes.where("down > 1 or down = 1 and up = 1").isEmpty()


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of `links` (columns a, b; any orderable type), root the least reachable node.

    Each round groups with partial minima and joins on the node, so no list of
    neighbours is ever gathered; rounds grow with the logarithm of the number of
    links. Every round is a table in the shared folder. Links with a null end
    and links of a node to itself count nothing; without links the result is empty.
    """
    return alone(lambda: _components(links, name))


def _components(links: DataFrame, name: str) -> DataFrame:
    rows = links.count()
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name, rows)
    while not _settled(edges):
        rows = edges.count()
        moved = written(_large_star(edges, rows), name, rows)
        edges = written(_small_star(moved, rows), name, 2 * rows)
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return written(nodes.unionAll(roots), name, 2 * rows)
