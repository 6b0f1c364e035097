"""Text and JSON scans: gazette sections, agendas, floor maps, catalogues, archive listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import first_map


def gazette_sections(lines: DataFrame, head: str, law: str) -> DataFrame:
    """Sections of issues: (issue, section_no, kind, line_no, line).

    ``lines`` (issue, line_no, line). Running heads and page numbers go. A line that matches ``head`` (group 1:
    the kind) begins a section only if one of the three lines after it cites the law; a contents entry does
    not. The running number of beginnings is the section.
    """
    furniture = F.col("line").rlike(r"兵\s*庫\s*県\s*公\s*報|^\s*\d{1,3}\s*$|^\s*（\d+）\s*$") & (F.col("line").contains("公") | F.trim("line").rlike(r"^\d+$") | F.col("line").contains("（"))
    w = Window.partitionBy("issue").orderBy("line_no")
    kept = lines.where(~furniture)
    after = F.concat_ws(" ", *(F.lead("line", k).over(w) for k in (1, 2, 3)))
    kept = kept.withColumn("kind", F.when(F.col("line").rlike(head) & after.rlike(law), F.regexp_extract("line", head, 1)))
    number = F.count("kind").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    named = F.last("kind", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return kept.withColumn("section_no", number).withColumn("kind", named).where("section_no > 0").select("issue", "section_no", "kind", "line_no", "line")


def numbered_items(lines: Column) -> Column:
    """A section's numbered items as label -> value (of equal labels the first): the value beside the label, else the next line."""
    pick = lambda l, i: F.struct(F.regexp_extract(l, r"^\s*[0-9０-９]{1,2}\s+(\S+)", 1).alias("k"), F.when(F.regexp_extract(l, r"^\s*[0-9０-９]{1,2}\s+\S+\s+(\S.*)$", 1) != "", F.trim(F.regexp_extract(l, r"^\s*[0-9０-９]{1,2}\s+\S+\s+(\S.*)$", 1))).otherwise(F.trim(F.coalesce(F.get(lines, i + 1), F.lit("")))).alias("v"))
    return first_map(F.filter(F.transform(lines, pick), lambda e: e["k"] != ""))


def agenda_items(text: Column) -> Column:
    """The items of an agenda that hold a notice, as label -> value maps (value after two spaces or more)."""
    blocks = F.filter(F.split(text, r"(?=第\s*\d+\s*号議案)"), lambda b: b.contains("届出内容") | b.contains("届出の内容"))
    pair = lambda l: F.struct(F.regexp_replace(F.regexp_extract(l, r"^\s*(\S(?:.*?\S)?)\s{2,}(\S.*?)\s*$", 1), r"\s", "").alias("k"), F.regexp_extract(l, r"^\s*(\S(?:.*?\S)?)\s{2,}(\S.*?)\s*$", 2).alias("v"))
    return F.transform(blocks, lambda b: first_map(F.filter(F.transform(F.split(b, "\n"), pair), lambda p: p["k"] != "")))


#: Words for common areas, in order (fixed values).
COMMON_AREAS = [
    ("階段", r"階段|stairs"), ("エレベーター", r"エレベーター|elevator"), ("エスカレーター", r"エスカレーター|escalator"), ("トイレ", r"トイレ|toilet|restroom"),
    ("駐車・駐輪", r"駐車|駐輪|parking"), ("エントランス・ゲート", r"エントランス|entrance|ゲート"), ("案内", r"インフォメーション|information|案内|info"),
    ("庭・広場", r"ガーデン|garden|広場|テラス|コート|stage|ステージ"), ("設備・サービス", r"ATM|ロッカー|locker|自動販売|喫煙|smoke|授乳|ベビー|baby|救護|AED|post|photo"), ("催事", r"event|催事"),
]


def area_class(name: Column) -> Column:
    """the first word class that a name fits, else 分からない."""
    out = F.lit("分からない")
    for label, pattern in reversed(COMMON_AREAS):
        out = F.when(F.coalesce(name, F.lit("")).rlike(f"(?i){pattern}"), label).otherwise(out)
    return out


def floor_options(pages: DataFrame) -> DataFrame:
    """The <option> entries of a floor map: (page, map_id, floor_id, name, shop_id or null, class of a common area)."""
    tag = pages.select("page", F.explode(F.regexp_extract_all("html", F.lit(r"(?is)<option\b[^>]*>"), F.lit(0))).alias("t"))
    attr = lambda n: F.nullif(F.regexp_extract("t", f'{n}="([^"]*)"', 1), F.lit(""))
    conn = F.coalesce(attr("data-connection-value"), F.lit(""))
    out = tag.select(
        "page", F.when(conn.contains("value="), F.regexp_extract(conn, r".*value=(.*)$", 1)).otherwise(attr(" value")).alias("map_id"),
        F.coalesce(attr("data-floor-id"), F.nullif(F.regexp_extract(conn, r"floorId=(\d+)", 1), F.lit(""))).alias("floor_id"),
        F.coalesce(attr("data-shop-name"), F.nullif(F.regexp_extract(conn, r"shopName=([^/]*)", 1), F.lit("")), F.lit("")).alias("name"),
        F.nullif(F.regexp_extract(F.coalesce(attr("data-detail-url"), F.lit("")), r"/(\d+)/?$", 1), F.lit("")).alias("shop_id"),
    )
    return out.where(F.col("map_id").startswith("map")).withColumn("area", F.when(F.col("shop_id").isNull(), area_class(F.col("name"))))


def map_shop_classes(options: DataFrame) -> DataFrame:
    """Maps by how many shops stand on them, and shops on several maps."""
    m = options.groupBy("map_id").agg(F.count_distinct("shop_id").alias("n"))
    s = options.where("shop_id IS NOT NULL").groupBy("shop_id").agg(F.count_distinct("map_id").alias("n"))
    of = lambda df, c: df.groupBy(c.alias("class")).agg(F.count("*").alias("n"))
    a = of(m, F.when(F.col("n") == 0, "no shop").when(F.col("n") == 1, "one shop").otherwise("several shops"))
    return a.unionByName(of(s.where("n > 1"), F.lit("shop on several maps")))


def catalogue_count(body: Column) -> Column:
    """How many results a catalogue reports; null where it cannot be read, which is not 0."""
    return F.get_json_object(F.when(F.is_valid_utf8(body), body), "$.result.count").try_cast("int")


def catalogue_resources(rows: DataFrame) -> DataFrame:
    """(id, dataset, resource, format, url) of a catalogue answer; none where it cannot be read."""
    schema = "result struct<results: array<struct<title: string, name: string, resources: array<struct<name: string, format: string, url: string>>>>>"
    p = rows.select("id", F.explode(F.from_json("body", schema)["result"]["results"]).alias("p"))
    r = p.select("id", F.coalesce("p.title", "p.name", F.lit("")).alias("dataset"), F.explode("p.resources").alias("r"))
    return r.select("id", "dataset", *(F.coalesce(f"r.{c}", F.lit("")).alias(a) for c, a in (("name", "resource"), ("format", "format"), ("url", "url"))))


def archive_snapshots(cdx: DataFrame, by_digest: bool) -> DataFrame:
    """Of archived captures (url, ts, digest, status) those that count: one a month, or one a digest."""
    ok = cdx.where("status = '200'")
    w = Window.partitionBy("url").orderBy("ts")
    if by_digest:  # neighbours with one digest collapse
        return ok.withColumn("was", F.lag("digest").over(w)).where(~F.col("digest").eqNullSafe(F.col("was"))).drop("was")
    first = F.row_number().over(Window.partitionBy("url", F.substring("ts", 1, 6)).orderBy("ts"))
    return ok.withColumn("k", first).where("k = 1").drop("k")


def backfill(snapshots: DataFrame, have: DataFrame, done: DataFrame, budget: int) -> DataFrame:
    """Captures still to fetch, oldest first, within the budget: days at hand, digests known and those
    done or failed are left out."""
    s = snapshots.withColumn("day", F.to_date(F.substring("ts", 1, 8), "yyyyMMdd"))
    s = s.join(have.select("url", "day"), ["url", "day"], "left_anti").join(have.select("url", "digest"), ["url", "digest"], "left_anti").join(done.select("url", "ts"), ["url", "ts"], "left_anti")
    return s.orderBy("ts", "url").limit(budget)


def markdown_rows(lines: DataFrame) -> DataFrame:
    """Rows of the tables of a report: (file, section, cells); the section is the last heading before a row."""
    w = Window.partitionBy("file").orderBy("line_no")
    section = F.last(F.when(F.col("line").startswith("#"), F.trim(F.regexp_replace("line", "^#+", ""))), ignorenulls=True).over(w)
    rows = lines.withColumn("section", F.coalesce(section, F.lit(""))).where(F.col("line").startswith("|") & ~F.col("line").rlike(r"^\|[\s:|-]+\|?\s*$"))
    return rows.select("file", "section", "line_no", F.transform(F.split(F.regexp_replace("line", r"^\||\|\s*$", ""), r"\|"), lambda c: F.trim(c)).alias("cells"))


def json_shape(body: Column) -> Column:
    """The outline of a JSON text, no values: number of keys of the outer object, or length of the array."""
    return F.struct(F.json_object_keys(body).alias("keys"), F.json_array_length(body).alias("length"))


def longest_links(urls: Column) -> Column:
    """K6: the numbers of an address as a sort key: versions compare as numbers."""
    return F.transform(F.regexp_extract_all(urls, F.lit(r"\d+"), F.lit(0)), lambda x: x.try_cast("long"))
