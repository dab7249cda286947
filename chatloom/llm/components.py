"""Connected components of an edge table by alternating star contractions.

Every round replaces edges by edges to smaller neighbours. Nothing but a count and a checksum reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the smallest node it knows."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links itself and its smaller neighbours to the smallest of them. Edges come with u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, u: str, v: str) -> DataFrame:
    """(node, component) for every node of an edge: component is the smallest node reachable.

    Edges may repeat and point either way; self-links and edges with a null end are left out. An empty table gives an
    empty one.
    """
    now = (
        edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"), F.isnull(u).alias("a"), F.isnull(v).alias("b"))
        .filter("u > v and not a and not b")
        .select("u", "v")
        .distinct()
    )
    now = materialize(now, "edges")
    state = None
    while True:
        now = materialize(_small_star(_large_star(now)), "stars")
        found = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if (found.n, found.s) == state or not found.n:
            break
        state = (found.n, found.s)
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
