"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import Scratch


def connected(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, group) for every node of ``edges`` (a, b); the group is its smallest node.

    Each round links all larger neighbours of a node to its smallest one, then all smaller
    ones likewise; the number of rounds follows the logarithm of the nodes. Every round is
    written, no graph ever reaches the driver.
    """
    stars = scratch.write(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{name}-0"
    )
    before, turn = None, 0
    while True:
        both = stars.union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select("u", F.col("m").alias("v")).union(
            joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        turn += 1
        stars = scratch.write(small, f"{name}-{turn}")
        scratch.drop(f"{name}-{turn - 1}")
        now = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return stars.select(F.col("u").alias("node"), F.col("v").alias("group")).union(
        stars.select(F.col("v").alias("node"), F.col("v").alias("group")).distinct()
    )
