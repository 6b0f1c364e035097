"""Sinks: sitemap, robots text, a compressed archive of whole texts and what is derived from it again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def xml_text(s: Column) -> Column:
    """Text with the five characters escaped that XML reserves."""
    for raw, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        s = F.replace(s, F.lit(raw), F.lit(name))
    return s


def sitemap(pages: DataFrame, host: str, per_file: int = 50_000, daily: bool = False) -> DataFrame:
    """(file, body): sitemaps of ``pages`` (url), at most ``per_file`` entries each, the host's own among them; every address
    once, null ones left out; no dates, since none is known. ``daily`` says of the host that it changes every day."""
    n = max(1, -(-pages.count() * 5 // (per_file * 4)))  # slots, a quarter of room, since hashes do not fall evenly; a fuller one makes further files
    entry = F.concat(F.lit(f"<url><loc>{host}"), xml_text(F.col("url")), F.lit("</loc></url>"))
    own = pages.select("url").where("url IS NOT NULL").distinct().select(F.pmod(F.xxhash64("url"), F.lit(n)).alias("slot"), F.lit(1).alias("rank"), entry.alias("line"))
    first = F.lit(f"<url><loc>{host}</loc>{'<changefreq>daily</changefreq>' if daily else ''}</url>")
    rows = own.unionByName(pages.sparkSession.range(1).select(F.col("id").alias("slot"), F.lit(0).alias("rank"), first.alias("line")))
    place = F.row_number().over(Window.partitionBy("slot").orderBy("rank", "line"))
    files = rows.withColumn("part", F.floor((place - 1) / per_file)).groupBy("slot", "part").agg(F.array_sort(F.collect_list(F.struct("rank", "line"))).alias("lines"))
    head = '<?xml version="1.0" encoding="UTF-8"?>\n<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">\n'
    body = F.concat(F.lit(head), F.array_join(F.col("lines")["line"], "\n"), F.lit("\n</urlset>\n"))
    return files.select((F.col("slot") + F.col("part") * n).alias("file"), body.alias("body"))


def robots_text(rules: DataFrame) -> DataFrame:
    """(agent, body) of rules (agent, allow boolean, path): a group for each agent, the longest path first."""
    line = F.concat(F.when(F.col("allow"), "Allow: ").otherwise("Disallow: "), "path")
    body = F.transform(F.array_sort(F.collect_list(F.struct((-F.length("path")).alias("o"), "path", line.alias("l")))), lambda x: x["l"])
    return rules.groupBy("agent").agg(F.concat(F.lit("User-agent: "), F.first("agent"), F.lit("\n"), F.array_join(body, "\n")).alias("body"))


def save_full(issues: DataFrame, path: str) -> None:
    """Whole texts of issues (day, no, url, text), compressed, by year; a day that is written again replaces only its year."""
    rows = issues.select(F.substring(F.col("day").cast("string"), 1, 4).alias("year"), F.col("day").cast("string").alias("day"), "no", "url", "text")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("year").parquet(path)


def rebuilt(spark, path: str, derive) -> DataFrame:
    """What ``derive`` makes of all archived texts, as a pure function of them; nothing is fetched."""
    return derive(spark.read.parquet(path).drop("year"))
