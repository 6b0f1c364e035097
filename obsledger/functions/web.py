"""Links, addresses and pages as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LINK = r'(?is)<a [^>]*href="([^"]*)"[^>]*>(.*?)</a>'


def url_part(url: Column, part: str) -> Column:
    """``scheme``, ``host`` (no port), ``origin`` or ``path`` of an absolute address; '' if it has none."""
    pattern = {"scheme": r"^([a-z]+)://", "host": r"^[a-z]+://([^/?#:]*)", "origin": r"^([a-z]+://[^/?#]*)", "path": r"^[a-z]+://[^/?#]*([^?#]*)"}[part]
    return F.regexp_extract(url, pattern, 1)


def absolute(href: Column, base: Column) -> Column:
    """A reference made absolute: from the root, already absolute, or beside the base."""
    return F.when(href.startswith("/"), F.concat(url_part(base, "origin"), href)).when(href.rlike("^[a-z]+://"), href).otherwise(F.concat(F.regexp_extract(base, r"^([a-z]+://[^?#]*/)", 1), href))


def links(pages: DataFrame, id_col: str, url: str, html: str) -> DataFrame:
    """(id, pos, href, label, target, same_host) for every link, in page order."""
    pairs = F.arrays_zip(F.regexp_extract_all(html, F.lit(_LINK), F.lit(1)).alias("href"), F.regexp_extract_all(html, F.lit(_LINK), F.lit(2)).alias("label"))
    l = pages.select(id_col, url, F.posexplode(pairs).alias("pos", "x"))
    l = l.select(id_col, url, "pos", F.col("x.href").alias("href"), F.trim("x.label").alias("label")).withColumn("target", absolute(F.col("href"), F.col(url)))
    return l.select(id_col, "pos", "href", "label", "target", (url_part(F.col("target"), "host") == url_part(F.col(url), "host")).alias("same_host"))


def link_class(label: Column, href: Column) -> Column:
    """Pdf, table or record page, by the file ending first, then by the label."""
    return F.when(F.lower(href).rlike(r"\.(pdf)$"), "pdf").when(F.lower(href).rlike(r"\.(xlsx?|csv)$"), "table").when(F.lower(label).rlike("record|notice|届出|記録"), "record").otherwise("page")


def link_strength(text: Column, words: list[str], weak: list[str] = ()) -> Column:
    """Place of the earliest word of the list in a link's text; weak words count 100 more; null if none."""
    hits = [F.when(F.locate(w, text) > 0, F.lit(i)) for i, w in enumerate(words)] + [F.when(F.locate(w, text) > 0, F.lit(100 + i)) for i, w in enumerate(weak)]
    return F.coalesce(*hits) if hits else F.lit(None).cast("int")


def main_content(html: Column, start: str, end: str) -> Column:
    """What stands between two markers; '' without them."""
    return F.regexp_extract(html, f"(?s){start}(.*?){end}", 1)


def page_verdict(html: Column) -> Column:
    """Does a page give its records as a table, a sheet or a PDF?"""
    low = F.lower(html)
    return F.when(low.rlike("<table[ >]"), "table").when(low.rlike(r'href="[^"]*\.(xlsx?|csv)"'), "excel").when(low.rlike(r'href="[^"]*\.pdf"'), "pdf").otherwise("unknown")


def url_shape(path: Column) -> Column:
    """A path with its numbers as a star."""
    return F.regexp_replace(path, "[0-9]+", "*")


def organisation(host: Column) -> Column:
    """The registrable end of a host: three labels below go.jp, else two."""
    return F.when(host.rlike(r"\.go\.jp$"), F.regexp_extract(host, r"([^.]+\.[^.]+\.[^.]+)$", 1)).otherwise(F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1))


def in_range(url: Column, pattern: Column) -> Column:
    """P20: is an address inside an approved one? Equal scheme and host; a pattern that ends in a slash covers
    what lies below it, one with a query only itself, any other the exact path."""
    same = (url_part(url, "scheme") == url_part(pattern, "scheme")) & (url_part(url, "host") == url_part(pattern, "host"))
    path, own = url_part(url, "path"), url_part(pattern, "path")
    query = F.contains(pattern, F.lit("?"))
    return F.when(query, url == pattern).when(own.endswith("/"), same & path.startswith(own)).otherwise(same & (path == own))
