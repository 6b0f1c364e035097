"""Scans and record rules over generated pages: every row of a driver table becomes cells, lines or dates of a source,
and is read back; the SQL says what must come out, from the table itself."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, privacy, text
from ..operators import enrich, frontier, observation, policy
from ..session import table
from ..sources import html_tables, scans, sinks, xlsx

_BASE = "http://a.example/"


def _orders(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", "o_custkey", "o_orderstatus", F.to_date("o_orderdate").alias("day"), F.col("o_orderpriority").alias("kind"))


def _pages(rows, group, order, row, head="", foot=""):
    """One page for each ``group``: ``row`` of every row between ``head`` and ``foot``."""
    lines = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("k"), row.alias("v")))), lambda x: x["v"])
    return rows.groupBy(group.cast("string").alias("page")).agg(F.concat(F.lit(head), F.array_join(lines, ""), F.lit(foot)).alias("html"))


def _cell(*parts):
    return F.concat(F.lit("<td>"), *parts, F.lit("</td>"))


_HEAD = "<h2>届出一覧</h2><table><tr><th>届出年月日</th><th>店舗の名称</th><th>設置者</th><th colspan=2>謎の列</th></tr>"


def html_notices(spark, sf_dir):
    """Tables of sixteen orders each; a note row, a row without a store, a heading over two columns."""
    o = _orders(spark, sf_dir)
    key = F.col("o_orderkey").cast("string")
    day = F.concat(F.year("day").cast("string"), F.lit("年"), F.month("day").cast("string"), F.lit("月"), F.day("day").cast("string"), F.lit("日"))
    row = F.when(F.col("o_orderkey") % 11 == 0, F.concat(F.lit("<tr><td colspan=5>"), key, F.lit("は別表</td></tr>"))).otherwise(
        F.concat(F.lit("<tr>"), _cell(day), _cell(F.when(F.col("o_orderkey") % 7 == 0, "").otherwise(F.concat(F.lit("店&amp;"), key))), _cell(F.lit("第"), F.col("o_custkey")), _cell(key), _cell(F.lit("x")), F.lit("</tr>"))
    )
    pages = _pages(o, F.floor(F.col("o_orderkey") / 16), "o_orderkey", row, _HEAD, "</table>")
    rows = pages.lateralJoin(html_tables.html_rows(F.col("html").outer(), F.lit(_BASE))).drop("html")
    n = html_tables.notices(rows)
    return n.select("page", "row_no", F.col("record")["store"].alias("store"), dates.to_iso(F.col("record")["date"]).alias("day"), F.col("record")["operator"].alias("operator"), F.col("extra")["謎の列"].alias("extra"), "reason")


def vertical_notices(spark, sf_dir):
    """S3: a table of label and value for each supplier, a label repeated."""
    s = table(spark, sf_dir, "supplier")
    pair = lambda k, v: F.concat(F.lit(f"<tr><th>{k}</th>"), _cell(v), F.lit("</tr>"))
    html = F.concat(F.lit("<table>"), pair("店舗", F.col("s_name")), pair("届出", F.col("s_suppkey").cast("string")), pair("店舗", F.lit("別")), pair("国", F.col("s_nationkey").cast("string")), F.lit("</table>"))
    pages = s.select(F.col("s_suppkey").cast("string").alias("page"), html.alias("html"))
    rows = pages.lateralJoin(html_tables.html_rows(F.col("html").outer(), F.lit(_BASE))).drop("html")
    r = html_tables.vertical(rows)
    return r.select("page", *(F.col("record")[k].alias(n) for k, n in (("店舗", "store"), ("届出", "notice"), ("国", "nation"))), F.size("record").alias("n"))


def dispatched_sources(spark, sf_dir):
    """customers' pages read as their source is: a table under a heading, one without, or blocks."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey").cast("string")
    line = F.concat(F.lit("<tr><td>R6.1.2</td><td>"), F.col("c_name"), F.lit("</td></tr></table>"))
    head = "<table><tr><th>届出日</th><th>店舗の名称</th></tr>"
    html = F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit(f"<h3>一覧</h3>{head}"), line)).when(F.col("c_custkey") % 4 == 1, F.concat(F.lit(head), line)).otherwise(
        F.concat(F.lit("<h1>届出</h1><p>店舗名："), F.col("c_name"), F.lit("</p><p>区分："), F.col("c_mktsegment"), F.lit("</p><p>区分：別</p>")))
    pages = c.select(key.alias("page"), F.concat(F.lit("s"), F.col("c_custkey") % 4).alias("source"), html.alias("html"), F.lit(_BASE).alias("base"))
    sources = spark.createDataFrame([("s0", "heading"), ("s1", "firstrow"), ("s2", "blocks")], "source string, how string")
    r = html_tables.by_source(pages, sources)
    return r.select("page", "source", "how", F.coalesce(F.col("record")["store"], F.col("record")["店舗名"]).alias("store"), F.col("record")["区分"].alias("segment"))


def section_items(spark, sf_dir):
    """Numbered items of a section for each part, values beside the label and on the next line, a label repeated."""
    p = table(spark, sf_dir, "part")
    lines = F.array(F.concat(F.lit(" 1  店舗名  "), F.col("p_name")), F.lit("２ 所在地"), F.concat(F.lit("  海辺町"), F.col("p_partkey")), F.concat(F.lit("3 面積 "), F.col("p_size")), F.lit("4 面積 別"))
    m = scans.numbered_items(lines)
    return p.select("p_partkey", m["店舗名"].alias("store"), m["所在地"].alias("place"), m["面積"].alias("area"), F.size(m).alias("n"))


def agenda_records(spark, sf_dir):
    """An agenda for each supplier: an item without a notice, one with, a label repeated."""
    s = table(spark, sf_dir, "supplier")
    agenda = F.concat(F.lit("議事録\n第1号議案\n予算  なし\n第 2 号議案\n届出内容\n店 舗 名    "), F.col("s_name"), F.lit("\n国  "), F.col("s_nationkey"), F.lit("\n国  別"))
    m = F.get(scans.agenda_items(agenda), F.lit(0))
    return s.select("s_suppkey", F.size(scans.agenda_items(agenda)).alias("items"), m["店舗名"].alias("store"), m["国"].alias("nation"))


def first_of_day(spark, sf_dir):
    """The first line of a part on a supplier's shipping day, by order and line."""
    li = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("source"), F.to_date("l_shipdate").alias("day"), F.col("l_partkey").alias("key"), "l_orderkey", "l_linenumber", "l_quantity")
    f = observation.first_of_day(li, ["key"], ["l_orderkey", "l_linenumber"])
    return f.select("source", F.col("day").cast("string").alias("day"), "key", "n_rows", "l_orderkey", "l_linenumber", "l_quantity")


def coerced_columns(spark, sf_dir):
    """P10: a column for each customer; where at least three cells hold something and 60 % are dates, day numbers become dates too."""
    o = _orders(spark, sf_dir)
    serial = F.datediff("day", F.lit("1899-12-30").cast("date")).cast("string")
    value = F.when(F.col("o_orderkey") % 5 == 0, serial).when(F.col("o_orderkey") % 7 == 0, "").when((F.col("o_orderkey") % 3 == 0) & (F.col("o_custkey") % 2 == 0), "未定").otherwise(F.col("day").cast("string"))
    cells = o.select(F.lit("f").alias("file"), F.lit("s").alias("sheet"), F.col("o_custkey").alias("col"), "o_orderkey", value.alias("value"))
    r = xlsx.coerce_dates(cells, F.col("value").rlike(r"^\d{4}-\d\d-\d\d$"), dates.gazette_iso(F.col("value")))
    return r.select("o_orderkey", F.col("col").alias("o_custkey"), "value")


def written_dates(spark, sf_dir):
    """the date of every order as a notice writes it, in one of six ways, and read again."""
    o = _orders(spark, sf_dir)
    y, m, d = F.year("day"), F.month("day"), F.day("day")
    era = F.concat(F.lit("平成"), F.when(y == 1989, F.lit("元")).otherwise((y - 1988).cast("string")))
    ways = [
        F.concat(F.lit("届出 "), era, F.lit("年"), m, F.lit("月"), d, F.lit("日付け")), F.concat(F.lit("平成"), y - 1988, F.lit("（"), y, F.lit("）年 "), m, F.lit(" 月 "), d, F.lit(" 日")), F.concat(y, F.lit("年"), m, F.lit("月"), d, F.lit("日（1990/1/1）")),
        F.concat_ws("/", y, m, d), F.concat(F.lit("(H"), y - 1988, F.lit("."), m, F.lit("."), d, F.lit(")")), F.concat(F.lit("1/2 "), F.translate(F.concat_ws("-", y, m, d), "0123456789", "０１２３４５６７８９")),
    ]
    raw = F.get(F.array(*ways), (F.col("o_orderkey") % 6).cast("int"))
    return o.select("o_orderkey", dates.to_iso(raw).alias("day"), dates.serial_date(F.datediff("day", F.lit("1899-12-30").cast("date"))).cast("string").alias("serial"))


def store_cells(spark, sf_dir):
    """the store and address of a cell for each supplier, with brackets and notes of many kinds."""
    s, k = table(spark, sf_dir, "supplier"), F.col("s_suppkey")
    cell = F.concat(F.col("s_name"), F.when(k % 3 == 0, "（仮称）").otherwise(""), F.when(k % 4 != 1, F.concat(F.lit("(海辺市"), k, F.when(k % 4 == 2, "").otherwise("）"))).otherwise(""), F.when(k % 5 == 0, " 届出書[PDF 1MB] x").when(k % 5 == 1, " 5条1項届出（新設）").otherwise(""))
    c = text.split_store(cell)
    return s.select("s_suppkey", c["store"].alias("store"), c["address"].alias("address"))


def stamped_rows(spark, sf_dir):
    """Where orders were taken: from their own file, the source's page of that day, its latest page, or nowhere."""
    o = _orders(spark, sf_dir)
    rows = o.select("o_orderkey", F.col("o_orderstatus").alias("source"), F.when(F.col("o_orderkey") % 10 == 0, F.concat(F.lit("f"), F.col("o_orderkey"))).alias("file"), F.col("day").alias("last_seen"))
    files = rows.where("file IS NOT NULL").select("source", "file", F.concat(F.lit("u/"), "file").alias("url"), F.date_add("last_seen", 1).alias("day"))
    pages = rows.where("source <> 'P' AND day(last_seen) = 15").select("source", F.concat(F.lit("p/"), F.col("last_seen").cast("string")).alias("url"), F.col("last_seen").alias("day")).distinct()
    r = enrich.stamp(rows, files, pages)
    return r.select("o_orderkey", "source_url", F.col("fetched_on").cast("string").alias("fetched_on"))


def history_links(spark, sf_dir):
    """Every reference of a customer's history with the order it names, if there is one."""
    o = _orders(spark, sf_dir)
    rows = o.groupBy(F.col("o_custkey").alias("key")).agg(F.array_sort(F.collect_list(F.col("o_orderkey") * 2)).alias("history"))
    return enrich.history_refs(rows, o.select(F.col("o_orderkey").alias("ref"), F.col("o_custkey").alias("key")))


def neighbour_issues(spark, sf_dir):
    """Issues of a customer that are known a year later or earlier under the same number; extra issues are not sought."""
    o = _orders(spark, sf_dir)
    number = F.concat(F.when(F.col("o_custkey") % 9 == 0, "g").otherwise(""), F.col("o_custkey").cast("string"), F.lit("-"), F.month("day"), F.lit("-"), F.day("day"))
    issues = o.select(number.alias("no"), F.col("day")).distinct()
    r = enrich.neighbour_year(issues, issues)
    return r.select("no", F.col("day").cast("string").alias("day"), F.col("found").cast("string").alias("found"))


def home_reasons(spark, sf_dir):
    """why a part's property may be someone's home, by what is known of it."""
    p = table(spark, sf_dir, "part")
    known = F.get(F.array(*(F.lit(x) for x in ("", "　", "入札受付中", "第一種住居地域", "共同住宅", "商業地域の店舗"))), (F.col("p_partkey") % 6).cast("int"))
    return p.select("p_partkey", privacy.residential_reason(known, F.when(F.col("p_partkey") % 2 == 0, F.lit("")).otherwise(F.lit(None).cast("string"))).alias("reason"))


def listing_sentences(spark, sf_dir):
    """F64: what is said about an order's listing, by what is known of it; an unknown date is never printed."""
    o, k = _orders(spark, sf_dir), F.col("o_orderkey")
    day = F.col("day").cast("string")
    mode, listed = F.when(k % 7 == 0, "cumulative").otherwise("snapshot"), F.when(k % 3 == 0, True).when(k % 3 == 1, False)
    s = enrich.listing_sentence(mode, listed, F.when(k % 2 == 0, day), F.when(k % 5 != 0, F.date_add("day", 3).cast("string")), F.when(k % 11 != 0, day))
    return o.select("o_orderkey", s.alias("sentence"))


def suspect_parties(spark, sf_dir):
    """Lines one of whose party flags says that an address stands in a name's place, once each."""
    li = table(spark, sf_dir, "lineitem")
    flag = lambda c, v: F.when(F.col(c) == v, "address").otherwise("corp")
    rows = li.select(F.col("l_linestatus").alias("source"), (F.col("l_orderkey") % 100).alias("file"), F.col("l_suppkey").alias("key"), F.col("l_returnflag").alias("store"), flag("l_returnflag", "R").alias("operator_kind"), flag("l_linenumber", 4).alias("retailer_kind"))
    r = enrich.suspects(rows, ["operator_kind", "retailer_kind"])
    return r.select("source", "file", "key", "store", F.array_join("flags", ",").alias("flags"))


def transfer_checks(spark, sf_dir):
    """What a page's transfer proves: all bytes, the end of the page, the number of links; each may be unknown."""
    p = table(spark, sf_dir, "pages")
    size, n = F.octet_length("html"), F.regexp_count("html", F.lit("<a "))
    marks = policy.transfer_marks(size, F.when(F.col("page_id") % 3 != 0, size + F.when(F.col("page_id") % 5 == 0, 1).otherwise(0)), F.when(F.col("page_id") % 7 == 0, "gzip"), F.col("html"), n, F.when(F.col("page_id") % 2 == 0, n))
    return p.select("page_id", *(c.alias(k) for k, c in marks.items()))


def leaked_pages(spark, sf_dir):
    """the forbidden tokens that a page's record holds."""
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", F.array_join(policy.leaked_tokens(F.struct("url", "html"), ["track(", "<svg", "page="]), ",").alias("tokens"))


def record_texts(spark, sf_dir):
    """what is said about each order as a notice: basis, size and event day if known, why its address is cut."""
    o, k = _orders(spark, sf_dir), F.col("o_orderkey")
    kind = F.get(F.array(*(F.lit(x) for x in ("新設", "廃止", "変更", "承継", "中規模"))), (k % 5).cast("int"))
    said = enrich.description(F.lit("海辺市"), F.concat(F.lit("店"), k), kind, F.col("day").cast("string"), F.when(k % 3 == 0, k), F.when(k % 2 == 0, F.col("day").cast("string")))
    note = enrich.address_note(k % 7 == 0, k % 3 == 0, F.when(k % 2 == 0, "個人"), F.when(k % 5 == 0, "address"), F.when(k % 11 == 0, "愛媛県"))
    return o.select("o_orderkey", said.alias("said"), note.alias("note"))


def address_like_names(spark, sf_dir):
    """customers' names, some of which are addresses written in the name's place."""
    c, k = table(spark, sf_dir, "customer"), F.col("c_custkey")
    name = F.get(F.array(F.col("c_name"), F.concat(F.lit("海辺市なぎさ町"), k, F.lit("番地")), F.concat(F.lit("海辺市なぎさ"), k, F.lit("-2")), F.concat(F.lit("なぎさ "), k, F.lit("-2")), F.concat(F.lit("株式会社海辺市"), k, F.lit("番"))), (k % 5).cast("int"))
    return c.select("c_custkey", privacy.looks_like_address(name).alias("address"))


def sitemap_files(spark, sf_dir):
    """The sitemap of all parts, in files of at most 200 entries; per file its size and entries."""
    parts = table(spark, sf_dir, "part").select(F.concat(F.lit("/p/"), "p_partkey", F.lit("?a=1&b=2")).alias("url"))
    m = sinks.sitemap(parts, "http://a.example", per_file=200)
    entry = F.explode(F.regexp_extract_all("body", F.lit("<loc>(http://a.example/p/[^<]*)</loc>"), F.lit(1)))
    return m.where((F.regexp_count("body", F.lit("<url>")) <= 200) & F.col("body").endswith("</urlset>\n")).select(entry.alias("loc"))


def link_frontier(spark, sf_dir):
    """What is reached from each supplier over its strongest parts and their strongest suppliers, caps 12, 4 and 32."""
    li = table(spark, sf_dir, "lineitem")
    e = li.groupBy(F.concat(F.lit("s"), "l_suppkey").alias("s"), F.concat(F.lit("p"), "l_partkey").alias("p")).agg((-F.count("*")).alias("rank"))
    links = e.select(F.col("s").alias("page"), F.col("p").alias("target"), "rank").unionByName(e.select(F.col("p").alias("page"), F.col("s").alias("target"), "rank"))
    seeds = table(spark, sf_dir, "supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("page"))
    return frontier.bounded_frontier(seeds, links)


QUERIES = {f.__name__: f for f in (html_notices, vertical_notices, dispatched_sources, section_items, agenda_records, first_of_day, coerced_columns, written_dates, store_cells, stamped_rows, history_links, neighbour_issues, home_reasons, listing_sentences, suspect_parties, transfer_checks, leaked_pages, record_texts, address_like_names, sitemap_files, link_frontier)}

ORACLES = {
    "html_notices": """
WITH o AS (SELECT *, (o_orderkey // 16)::VARCHAR AS page, o_orderkey % 16 AS n FROM orders)
SELECT page, row_number() OVER (PARTITION BY page ORDER BY o_orderkey)::INTEGER AS row_no, CASE WHEN ok THEN '店&' || o_orderkey END AS store, CASE WHEN ok THEN o_orderdate::DATE::VARCHAR END AS day, CASE WHEN ok THEN '第' || o_custkey END AS operator, CASE WHEN ok THEN o_orderkey::VARCHAR END AS extra,
       CASE WHEN o_orderkey % 11 = 0 THEN 'note across columns' WHEN o_orderkey % 7 = 0 THEN 'no store or date' END AS reason
FROM (SELECT *, o_orderkey % 11 <> 0 AND o_orderkey % 7 <> 0 AS ok FROM o)""",
    "vertical_notices": "SELECT s_suppkey::VARCHAR AS page, s_name AS store, s_suppkey::VARCHAR AS notice, s_nationkey::VARCHAR AS nation, 3 AS n FROM supplier",
    "dispatched_sources": """
SELECT c_custkey::VARCHAR AS page, 's' || c_custkey % 4 AS source, CASE c_custkey % 4 WHEN 0 THEN 'heading' WHEN 1 THEN 'firstrow' WHEN 2 THEN 'blocks' END AS how, CASE WHEN c_custkey % 4 < 3 THEN c_name END AS store, CASE WHEN c_custkey % 4 = 2 THEN c_mktsegment END AS segment FROM customer""",
    "section_items": "SELECT p_partkey, p_name AS store, '海辺町' || p_partkey AS place, p_size::VARCHAR AS area, 3 AS n FROM part",
    "agenda_records": "SELECT s_suppkey, 1 AS items, s_name AS store, s_nationkey::VARCHAR AS nation FROM supplier",
    "first_of_day": """
SELECT l_suppkey AS source, l_shipdate::DATE::VARCHAR AS day, l_partkey AS key, count(*) OVER w AS n_rows, l_orderkey, l_linenumber, l_quantity FROM lineitem
WINDOW w AS (PARTITION BY l_suppkey, l_shipdate::DATE, l_partkey) QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_shipdate::DATE, l_partkey ORDER BY l_orderkey, l_linenumber) = 1""",
    "coerced_columns": """
WITH c AS (SELECT o_orderkey, o_custkey, o_orderdate::DATE AS day, CASE WHEN o_orderkey % 5 = 0 THEN 1 WHEN o_orderkey % 7 = 0 THEN 0 WHEN o_orderkey % 3 = 0 AND o_custkey % 2 = 0 THEN 2 ELSE 3 END AS kind FROM orders),
g AS (SELECT *, count(*) FILTER (WHERE kind > 0) OVER w AS n, count(*) FILTER (WHERE kind = 3) OVER w AS good FROM c WINDOW w AS (PARTITION BY o_custkey))
SELECT o_orderkey, o_custkey, CASE kind WHEN 0 THEN '' WHEN 2 THEN '未定' WHEN 3 THEN day::VARCHAR ELSE CASE WHEN n >= 3 AND good >= 0.6 * n THEN day::VARCHAR ELSE (day - DATE '1899-12-30')::VARCHAR END END AS value FROM g""",
    "written_dates": "SELECT o_orderkey, o_orderdate::DATE::VARCHAR AS day, o_orderdate::DATE::VARCHAR AS serial FROM orders",
    "store_cells": """
SELECT s_suppkey, s_name || CASE WHEN s_suppkey % 3 = 0 THEN '（仮称）' ELSE '' END AS store, CASE WHEN s_suppkey % 4 <> 1 THEN '海辺市' || s_suppkey ELSE '' END AS address FROM supplier""",
    "stamped_rows": """
WITH r AS (SELECT o_orderkey, o_orderstatus AS source, o_orderkey % 10 = 0 AS own, o_orderdate::DATE AS d FROM orders), p AS (SELECT DISTINCT source, d FROM r WHERE source <> 'P' AND day(d) = 15), l AS (SELECT source, max(d) AS d FROM p GROUP BY source)
SELECT o_orderkey, CASE WHEN own THEN 'u/f' || o_orderkey WHEN p.d IS NOT NULL THEN 'p/' || p.d WHEN l.d IS NOT NULL THEN 'p/' || l.d END AS source_url, (CASE WHEN own THEN r.d + 1 WHEN p.d IS NOT NULL THEN r.d WHEN l.d IS NOT NULL THEN l.d ELSE r.d END)::VARCHAR AS fetched_on
FROM r LEFT JOIN p ON p.source = r.source AND p.d = r.d LEFT JOIN l ON l.source = r.source""",
    "history_links": """
SELECT o.o_custkey AS key, (row_number() OVER (PARTITION BY o.o_custkey ORDER BY o.o_orderkey) - 1)::INTEGER AS pos, o.o_orderkey * 2 AS ref, r.o_custkey AS ref_key FROM orders o LEFT JOIN orders r ON r.o_orderkey = o.o_orderkey * 2""",
    "neighbour_issues": """
WITH i AS (SELECT DISTINCT o_custkey AS c, o_orderdate::DATE AS d FROM orders WHERE o_custkey % 9 <> 0),
n AS (SELECT a.c, a.d, b.d AS found, b.d > a.d AS later FROM i a JOIN i b ON a.c = b.c AND month(a.d) = month(b.d) AND day(a.d) = day(b.d) AND abs(year(a.d) - year(b.d)) = 1)
SELECT c || '-' || month(d) || '-' || day(d) AS no, d::VARCHAR AS day, found::VARCHAR AS found FROM n QUALIFY row_number() OVER (PARTITION BY c, d ORDER BY later DESC) = 1""",
    "home_reasons": "SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN '何が建っているか分からない' WHEN 1 THEN '何が建っているか分からない' WHEN 2 THEN '入札の途中' WHEN 3 THEN '住居系の用途地域' WHEN 4 THEN '居住用途の建物' ELSE '' END AS reason FROM part",
    "listing_sentences": """
WITH o AS (SELECT o_orderkey AS k, o_orderdate::DATE AS d FROM orders)
SELECT k AS o_orderkey, CASE WHEN k % 7 = 0 THEN 'kept for good' WHEN k % 3 = 0 THEN CASE WHEN k % 11 <> 0 THEN 'listed on ' || d ELSE 'not known' END WHEN k % 3 = 1 AND k % 2 = 0 AND k % 5 <> 0 THEN 'gone between ' || d || ' and ' || (d + 3)
  WHEN k % 11 <> 0 THEN 'last seen on ' || d || ', now unknown' ELSE 'not known' END AS sentence FROM o""",
    "suspect_parties": """
SELECT DISTINCT l_linestatus AS source, l_orderkey % 100 AS file, l_suppkey AS key, l_returnflag AS store, concat_ws(',', CASE WHEN l_returnflag = 'R' THEN 'operator_kind' END, CASE WHEN l_linenumber = 4 THEN 'retailer_kind' END) AS flags FROM lineitem WHERE l_returnflag = 'R' OR l_linenumber = 4""",
    "transfer_checks": """
SELECT page_id, CASE WHEN page_id % 3 <> 0 AND page_id % 7 <> 0 THEN page_id % 5 <> 0 END AS bytes, lower(rtrim(html)) LIKE '%</html>' AS "end", CASE WHEN page_id % 2 = 0 THEN true END AS count FROM pages""",
    "leaked_pages": "SELECT page_id, concat_ws(',', CASE WHEN contains(html, 'track(') THEN 'track(' END, CASE WHEN contains(html, '<svg') THEN '<svg' END, CASE WHEN contains(html, 'page=') OR contains(url, 'page=') THEN 'page=' END) AS tokens FROM pages",
    "record_texts": """
WITH o AS (SELECT o_orderkey AS k, o_orderdate::DATE::VARCHAR AS d, CASE o_orderkey % 5 WHEN 0 THEN '新設' WHEN 1 THEN '廃止' WHEN 2 THEN '変更' WHEN 3 THEN '承継' ELSE '中規模' END AS kind FROM orders)
SELECT k AS o_orderkey, '海辺市の店' || k || 'について、' || d || 'に' || CASE WHEN kind = '中規模' THEN '市の条例にもとづく' ELSE '大規模小売店舗立地法の' END || kind || '届出。' || CASE WHEN k % 3 = 0 THEN ' 店舗面積' || k || '。' ELSE '' END ||
  CASE WHEN k % 2 = 0 THEN ' 届出に書かれた' || CASE kind WHEN '中規模' THEN '日付' ELSE kind || '日' END || 'は' || d || CASE kind WHEN '新設' THEN '（開店日とは別に決まります）' WHEN '廃止' THEN '（閉店日とは別に決まります）' ELSE '' END || '。' ELSE '' END AS said,
  CASE WHEN k % 7 = 0 THEN '（取ってきた一覧に所在地が入っていませんでした）' WHEN k % 3 = 0 THEN '（' || CASE WHEN k % 2 = 0 THEN '設置者が個人のため' WHEN k % 5 = 0 THEN '届出の一覧の設置者の欄に住所だけが書かれていて名称が読めないため' ELSE '設置者を確かめられないため' END || '町丁目まで）' ELSE '' END ||
  CASE WHEN k % 11 = 0 THEN '（自治体の表の所在地欄に別の県の住所が入っていたため、店舗の所在地としては表示していません）' ELSE '' END AS note FROM o""",
    "address_like_names": "SELECT c_custkey, c_custkey % 5 IN (1, 2) AS address FROM customer",
    "sitemap_files": "SELECT 'http://a.example/p/' || p_partkey || '?a=1&amp;b=2' AS loc FROM part",
    "link_frontier": """
WITH e AS (SELECT 's' || l_suppkey AS s, 'p' || l_partkey AS p, -count(*) AS rank FROM lineitem GROUP BY ALL),
l AS (SELECT via, target, row_number() OVER (PARTITION BY via ORDER BY rank, target) AS place FROM (SELECT s AS via, p AS target, rank FROM e UNION ALL SELECT p, s, rank FROM e) QUALIFY place <= 12),
one AS (SELECT 's' || s_suppkey AS seed, target AS page, 1 AS depth, via, place AS ord FROM supplier JOIN l ON via = 's' || s_suppkey WHERE place <= 12),
two AS (SELECT seed, target AS page, 2 AS depth, l.via, ord * 1000 + place AS ord FROM one JOIN l ON l.via = one.page WHERE place <= 4 AND target <> seed QUALIFY row_number() OVER (PARTITION BY seed, target ORDER BY ord * 1000 + place, l.via) = 1),
a AS (SELECT * FROM one UNION ALL SELECT * FROM two)
SELECT seed, page, depth, via FROM a QUALIFY row_number() OVER (PARTITION BY seed ORDER BY depth, ord, page) <= 32""",
}
