"""Connected components of an edge table by alternating star contractions.

Large star: every node hands the smallest node of its neighbourhood to its
larger neighbours.  Small star: every node hands its smallest neighbour to its
other smaller ones.  Both keep the components and flatten each to a star around
its smallest node.  A step is one aggregate (combined map-side) and one join;
hubs are split by AQE's skew join.  Every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import written


def _large_star(edges: DataFrame) -> DataFrame:
    sym = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = sym.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return sym.join(low, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(low, "a").where(F.col("b") > F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(low.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(a, b) links -> (node, component): the smallest node reachable, for every linked node."""
    cur = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .where(F.col("a") > F.col("b")).distinct(), "links")
    seen = None
    while True:
        state = cur.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == seen or not state[0]:
            break
        seen = state
        cur = written(_small_star(_large_star(cur)), "links")
    return cur.select(F.col("a").alias("node"), F.col("b").alias("component")) \
        .unionByName(cur.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
