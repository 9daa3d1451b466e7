"""Connected components of an edge table by alternating large and small stars.

Each round hangs every node's larger neighbours, then its smaller ones, on the
least node it sees, until the edges are stars around their components' least
nodes. A node's edges are dealt by a salt of their other end: minima are
aggregated by node and salt, then by node, and go back to the salts that the node has, so
the edges of a hub are never in one task. Each round is staged in
the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (the least node reachable) of every node that an edge names.

    Edges are undirected; loops and repeats are allowed. No edge, no row.
    """
    star = shared.staged(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "components")
    before = _print(star)
    while before[0]:
        both = star.unionByName(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).where("u <> v").distinct()
        large = shared.staged(large, "components")
        hung = _with_least(large).select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        star = shared.staged(hung.distinct(), "components")
        after = _print(star)
        if after == before:
            break
        before = after
    return star.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(star.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _with_least(edges: DataFrame) -> DataFrame:
    """u, v and m, the least v of u."""
    salted = edges.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(shared.partitions(edges.sparkSession))))
    least = salted.groupBy("u", "salt").agg(F.min("v").alias("m")).groupBy("u").agg(F.min("m").alias("m"), F.collect_list("salt").alias("salts"))
    return salted.join(least.select("u", "m", F.explode("salts").alias("salt")), ["u", "salt"]).select("u", "v", "m")


def _print(edges: DataFrame) -> tuple:
    """Number and order-free checksum of the edges."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


class Union:
    """Union-find over 0..n-1 inside one task."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        """True if they were apart."""
        i, j = self.find(i), self.find(j)
        if i == j:
            return False
        self.up[max(i, j)] = min(i, j)
        return True
