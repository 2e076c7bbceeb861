"""Connected components of a graph given as rows, by alternating large and small stars.

Every round is a few joins and aggregates whose result is written to the shared folder. The
number of rounds grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from scrutiny.llm.common import stored


def components(edges: DataFrame, a: str = "a", b: str = "b", most: int = 60) -> DataFrame:
    """``node, component`` (the smallest node of its component) of every node with an edge."""
    found = stars(edges, a, b, most)
    return found.unionByName(found.select(F.col("component").alias("node"), "component").distinct())


def stars(edges: DataFrame, a: str = "a", b: str = "b", most: int = 60) -> DataFrame:
    """The same without the rows of the smallest nodes themselves.

    A round tells its rows and their hash as it is written; no job reads them again for that.
    """
    now = stored(_directed(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))), "graph")
    before = None
    for _ in range(most):
        seen = Observation()
        now = stored(_small_star(_large_star(now)).observe(
            seen, F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")), "graph")
        mark = seen.get
        if mark == before:
            break
        before = mark
    else:
        raise RuntimeError(f"no stable components after {most} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _directed(edges: DataFrame) -> DataFrame:
    """Each edge once, from its larger node to its smaller one."""
    return (edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
            .where("u <> v").distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    """Ties each larger neighbour of a node to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (edges.select(F.col("v").alias("u"), F.col("u").alias("v")).join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Ties the smaller neighbours of a node, and the node, to the smallest of them."""
    one = _directed(edges)
    least = one.groupBy("u").agg(F.min("v").alias("m"))
    moved = one.join(least, "u").where(F.col("v") != F.col("m")).select(
        F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
