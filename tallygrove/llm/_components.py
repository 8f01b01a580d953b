"""Connected components by alternating large-star and small-star steps, on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """From edges (u, v) of bigint, u <> v: (node, root) for each node but the roots, root its component's least node.

    Each round is a table in the shared folder, removed once the next one stands; rounds grow with the logarithm of the
    longest path. A node with many edges meets one row in each join, so adaptive
    execution can split it. Only two sums leave the executors.
    """
    now = materialise(edges.select("u", "v").where("u <> v").distinct(), "edges")
    seen = None
    while True:
        now = materialise(_small_star(_large_star(now)), "edges", instead_of=now)
        sums = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(sums) == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = tuple(sums)
