"""Connected components of an edge table by alternating stars."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwire.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every vertex hands its smallest neighbour (or itself) to its larger neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (both.join(least, "u").where("v > u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Every vertex joins its smaller neighbours and itself to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(u long, v long) in any direction -> (vertex, root) for every vertex with an edge;
    the root is the smallest vertex of its component.

    Each round is a few equi-joins and pre-aggregated minima; the edges are written
    after each round, and only their number and a checksum reach the driver. The rounds
    grow with the logarithm of the components' diameter. Loops and repeated edges do
    no harm; no edges give an empty table."""
    edges = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"),
                                                F.least("u", "v").alias("v")).distinct(), "edges")
    seen = None
    while True:
        mark = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == seen or mark[0] == 0:
            break
        seen = mark
        edges = stored(_small_star(_large_star(edges)), "edges")
    return edges.select(F.col("u").alias("vertex"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("vertex"), F.col("v").alias("root")).distinct())
