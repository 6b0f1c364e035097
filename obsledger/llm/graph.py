"""Connected components by alternating large-star and small-star steps on an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_staged, stage


def connected_components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` (the smallest node reachable) for every node of ``edges`` (u, v).

    Every step is a minimum per node, combined before it shuffles, and a join whose other side has one
    row per node, so that a star of any size splits. Each round is written to the shared folder; rounds
    grow with the logarithm of the longest chain. Loops, repeats and either direction are allowed.
    """
    e = stage(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = stage(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "cc-large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.u", "x.v").where("u <> v")
        after = stage(small.distinct(), "cc")
        now = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        drop_staged(e)
        drop_staged(large)
        e = after
        if now == before:
            break
        before = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
