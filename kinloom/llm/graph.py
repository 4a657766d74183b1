"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinloom.llm.common import settle


def _lowest(pairs: DataFrame) -> DataFrame:
    """``u, v, m``: each pair with the least of u and all v of that u."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(least, "u")


def _contracted(edges: DataFrame) -> DataFrame:
    """Fewer edges of the same components: every node hangs on its least neighbour.

    An edge between nodes that hang on one node says nothing more and goes, so
    a clique becomes a star at once; other edges join what their ends hang on.
    """
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = settle(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    ends = edges.join(least.select("u", F.col("m").alias("mu")), "u").join(least.select(F.col("u").alias("v"), F.col("m").alias("mv")), "v")
    across = ends.where("mu <> mv").select(F.col("mu").alias("u"), F.col("mv").alias("v"))
    return least.where("u <> m").select("u", F.col("m").alias("v")).unionByName(across).distinct()


def _down(edges: DataFrame) -> DataFrame:
    """Distinct edges from the greater to the lesser node, without loops."""
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one root alone, and no root hangs on another."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).unionByName(edges.select(F.col("v").alias("n"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")))
    nodes = ends.groupBy("n").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return nodes.where("hangs > 1 or hangs = 1 and holds = 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges(u, v)``; root is the least node.

    ``edges`` is read more than once and should be a written table.
    Large-star and small-star rounds (Kiveris et al., 2014): each hangs the
    neighbours of a node onto the least among them, and the rounds grow with the
    logarithm of the component, not with its diameter. A minimum is
    taken by partial aggregation, so a hub costs one row per task. Every round ends
    in the shared folder. Loops and repeated edges are allowed; nulls are dropped.
    """
    now = settle(_down(_contracted(edges.select("u", "v").where("u <> v"))), "edges")
    while not _are_stars(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _down(_lowest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        low = _lowest(large)
        small = low.select("u", F.col("m").alias("v")).unionByName(low.select(F.col("v").alias("u"), F.col("m").alias("v")))
        now = settle(_down(small), "edges")
    roots = now.select("v").distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.select(F.col("v").alias("node"), F.col("v").alias("root")))
