"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.tables import written

#: Salts over which the edges of one node are spread in the star joins.
SALTS = 16


def _to_smallest(edges: DataFrame, smallest: DataFrame) -> DataFrame:
    """``(v, smallest of u)`` for each edge (u, v), a node's edges spread over salts."""
    salted = edges.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
    copies = smallest.withColumn("salt", F.explode(F.array([F.lit(i) for i in range(SALTS)])))
    return salted.join(copies, ["u", "salt"]).select("v", "m")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _to_smallest(both.filter("v > u"), smallest).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    smallest = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = _to_smallest(edges, smallest).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(smallest.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` of each node of the links (a, b); the component is its smallest node.

    Nodes without a link, and links of a node with itself, have no row.  Each
    round is written to the shared folder; the rounds end when one changes
    nothing, which takes about log2 of the longest path.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct()
    edges, before = written(edges, "star"), None
    while True:
        edges = written(_small_star(_large_star(edges)), "star")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        before = state
