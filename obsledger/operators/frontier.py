"""Bounded link frontiers (S21): pages reached from seeds over ranked links, within caps by depth."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def bounded_frontier(seeds: DataFrame, links: DataFrame, caps: tuple[int, ...] = (12, 4), total: int = 32) -> DataFrame:
    """(seed, page, depth, via): at most ``caps[d]`` links are followed from each page of depth d, strongest first,
    and at most ``total`` pages are kept for a seed, nearest and strongest first. A page counts at its least depth.

    ``seeds`` (page), ``links`` (page, target, rank; lower is stronger, ties by target). Links are cut to the largest
    cap once, before any join, so that a page of many links costs no more than that.
    """
    best = F.row_number().over(Window.partitionBy("page").orderBy("rank", "target"))
    links = links.withColumn("place", best).where(F.col("place") <= max(caps)).select(F.col("page").alias("via"), "target", "place")
    now = seeds.select(F.col("page").alias("seed"), F.col("page").alias("at"), F.lit(0).alias("order"))
    found = None
    for depth, cap in enumerate(caps, 1):
        step = now.join(links.where(F.col("place") <= cap), now["at"] == links["via"]).where("target <> seed")
        step = step.select("seed", F.col("target").alias("page"), F.lit(depth).alias("depth"), "via", (F.col("order") * 1000 + F.col("place")).alias("order"))
        step = step.groupBy("seed", "page").agg(F.min(F.struct("depth", "order", "via")).alias("b")).select("seed", "page", "b.*")
        if found is not None:
            step = step.join(found.select("seed", "page"), ["seed", "page"], "left_anti")
        found = step if found is None else found.unionByName(step)
        now = step.select("seed", F.col("page").alias("at"), "order")
    place = F.row_number().over(Window.partitionBy("seed").orderBy("depth", "order", "page"))
    return found.withColumn("place", place).where(F.col("place") <= total).select("seed", "page", "depth", "via")
