"""Workbooks, sheets, gazette lines, reports, robots files and parties made from every row of a driver table and read back."""

from __future__ import annotations

import io
import json
import zipfile
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from ..functions import privacy
from ..session import table
from ..sources import robots, scans, sheets, xlsx

_MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def workbook(rows: list[list]) -> bytes:
    """A workbook of one sheet: texts inline, numbers as numbers, ("day", n) as a day number with a date format."""

    def cell(at, v):
        if isinstance(v, list):
            return f'<c r="{at}" s="1"><v>{v[1]}</v></c>'
        return f'<c r="{at}" t="inlineStr"><is><t>{escape(v)}</t></is></c>' if isinstance(v, str) else f'<c r="{at}"><v>{v}</v></c>'

    body = "".join(f'<row r="{n}">' + "".join(cell(f"{chr(65 + k)}{n}", v) for k, v in enumerate(r) if v is not None) + "</row>" for n, r in enumerate(rows, 1))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/workbook.xml", f'<workbook {_MAIN} xmlns:r="{_REL}"><sheets><sheet name="一覧" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/styles.xml", f'<styleSheet {_MAIN}><numFmts><numFmt numFmtId="200" formatCode="yyyy/mm/dd"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="200"/></cellXfs></styleSheet>')
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {_MAIN}><sheetData>{body}</sheetData></worksheet>")
    return out.getvalue()


@F.pandas_udf(BinaryType())
def _workbooks(rows: pd.Series) -> pd.Series:
    return rows.map(lambda x: workbook(json.loads(x)))


def _sorted(*cols):
    """The rows of a group in order of the first column, without it."""
    return F.transform(F.array_sort(F.collect_list(F.struct(*(c.alias(f"c{k}") for k, c in enumerate(cols))))), lambda x: x["c1"])


def workbook_rows(spark, sf_dir):
    """A workbook for each nation of its customers: texts, numbers, days by number format, an empty column."""
    c, k = table(spark, sf_dir, "customer"), F.col("c_custkey")
    row = F.concat(F.lit("["), k, F.lit(',"'), F.col("c_name"), F.lit('",null,["day",'), k % 1000 + 40000, F.lit("]]"))
    books = c.groupBy("c_nationkey").agg(F.concat(F.lit('[["番号","名 &<","","日"],'), F.array_join(_sorted(k, row), ","), F.lit("]")).alias("rows"))
    read = books.select("c_nationkey", _workbooks("rows").alias("content")).lateralJoin(xlsx.xlsx_rows(F.col("content").outer()))
    return read.select("c_nationkey", "sheet", "row_no", F.array_join("cells", "|").alias("cells"))


def sheet_records(spark, sf_dir):
    """A sheet for each customer's orders: title, head with line breaks, a repeated head, history columns out of order."""
    o = table(spark, sf_dir, "orders")
    day = F.date_format(F.add_months(F.to_date("o_orderdate"), 360), "yyyyMMdd")
    rows = o.select(F.concat(F.lit("list"), F.min(day).over(_by_customer()), F.lit(".xlsx")).alias("file"), F.col("o_custkey").cast("string").alias("sheet"), (F.row_number().over(_by_customer().orderBy("o_orderkey")) + 1).alias("row_no"),
                    F.array((F.col("o_orderkey") + 1).cast("string"), F.concat(F.lit(" "), "o_orderpriority"), F.when(F.col("o_orderkey") % 2 == 0, "－").otherwise("b"), F.lit("a"), F.lit("別")).alias("cells"))
    sheet = rows.select("file", "sheet").distinct()
    title = sheet.select("file", "sheet", F.lit(0).alias("row_no"), F.array(F.lit("届出一覧"), F.lit("")).alias("cells"))
    head = sheet.select("file", "sheet", F.lit(1).alias("row_no"), F.array(*map(F.lit, ("整理\n番号", "店舗 名称", "履歴2", "履歴1", "店舗名称"))).alias("cells"))
    r = sheets.record(sheets.with_header(rows.unionByName(title).unionByName(head), "整理"))
    return r.select("sheet", sheets.day_in_name(F.col("file")).alias("day"), F.col("record")["整理番号"].alias("no"), F.col("record")["店舗名称"].alias("store"), F.array_join("history", ",").alias("history"))


def _by_customer():
    return Window.partitionBy("o_custkey")


def gazette_issues(spark, sf_dir):
    """An index sheet for each year's orders; two sheets give titles, days outside the range are set aside; one day an issue."""
    o = table(spark, sf_dir, "orders")
    year = F.year("o_orderdate").cast("string")
    sheet = F.when(F.col("o_orderstatus") == "P", "規則").otherwise("公告")
    cells = F.array(F.concat(F.lit("届出 "), "o_orderkey"), F.to_date("o_orderdate").cast("string"), (F.col("o_custkey") % 97 + 1).cast("string"))
    rows = o.select(year.alias("file"), sheet.alias("sheet"), (F.col("o_orderkey") + 1).cast("int").alias("row_no"), cells.alias("cells"))
    head = rows.select("file", "sheet").distinct().select("file", "sheet", F.lit(0).alias("row_no"), F.array(*map(F.lit, ("件名", "発行日", "公報番号"))).alias("cells"))
    ok, aside = sheets.gazette_index(sheets.with_header(rows.unionByName(head), "件名"), ["公告"], "1993-01-01", "2100-12-31")
    best = sheets.issue_dates(ok).select("no", "day", "titles")
    return best.unionByName(aside.groupBy("no").agg(F.lit("set aside").alias("day"), F.count("*").alias("titles")))


def gazette_lines(spark, sf_dir):
    """An issue for each customer: contents, running heads, page numbers, and a section for each order."""
    o = table(spark, sf_dir, "orders")
    kind = F.when(F.col("o_orderstatus") == "F", "新設").otherwise("変更")
    section = F.array(F.concat(kind, F.lit("に関する届出")), F.lit("12"), F.lit("大規模小売店舗立地法（平成10年法律第91号）第5条"), F.concat(F.lit("1 店舗名 "), "o_orderkey"))
    issue = o.groupBy(F.col("o_custkey").cast("string").alias("issue")).agg(F.concat(F.array(*map(F.lit, ("目次", "新設に関する届出 ......2", "変更に関する届出", "都市計画 ......3", "x", "y", "令和5年6月20日 兵 庫 県 公 報"))), F.flatten(_sorted(F.col("o_orderkey"), section))).alias("lines"))
    lines = issue.select("issue", F.posexplode("lines").alias("line_no", "line"))
    s = scans.gazette_sections(lines, r"^(新設|変更)に関する届出\s*$", "法律第91号")
    g = s.groupBy("issue", "section_no", "kind").agg(_sorted(F.col("line_no"), F.col("line")).alias("lines"))
    return g.select("issue", "section_no", "kind", scans.numbered_items(F.col("lines"))["店舗名"].alias("store"))


def report_tables(spark, sf_dir):
    """A report for each region: a heading and a table of its nations, read again as rows."""
    n = table(spark, sf_dir, "nation").join(F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    own = n.groupBy(F.col("r_name").alias("file")).agg(F.concat(F.array(F.concat(F.lit("## "), F.first("r_name")), F.lit("| 国 | 番号 |"), F.lit("|:--|--:|")), _sorted(F.col("n_nationkey"), F.concat(F.lit("| "), "n_name", F.lit(" | "), "n_nationkey", F.lit(" |")))).alias("lines"))
    r = scans.markdown_rows(own.select("file", F.posexplode("lines").alias("line_no", "line")))
    return r.select("file", "section", "line_no", F.array_join("cells", ",").alias("cells"))


def robots_of_hosts(spark, sf_dir):
    """A robots file for each supplier, and four addresses held against it."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("host"), F.col("s_nationkey").alias("n"), F.col("s_suppkey").alias("k"))
    body = F.concat(F.lit("User-agent: other\nDisallow: /\n\nUser-agent: *\nDisallow: /n"), "n", F.lit("\nAllow: /n"), "n", F.lit("/open # note\nDisallow: /*.pdf$\n"), F.when(F.col("k") % 2 == 0, "\nUser-agent: ledgerbot\nDisallow: /n\n").otherwise(""))
    rules = s.select("host", body.alias("body")).lateralJoin(robots.robots_rules(F.col("body").outer())).drop("body")
    path = F.explode(F.array(F.concat(F.lit("/n"), "n", F.lit("/x")), F.concat(F.lit("/n"), "n", F.lit("/open/1")), F.lit("/a/b.pdf"), F.lit("/a/b.pdf?x")))
    d = robots.decide(s.select("host", path.alias("path")), rules, "LedgerBot/1.0")
    return d.select("host", "path", "allowed", "rule")


def redacted_parties(spark, sf_dir):
    """parties and addresses for each supplier: companies as they are, persons and their lots cut."""
    s, k = table(spark, sf_dir, "supplier"), F.col("s_suppkey")
    name = F.get(F.array(F.concat(F.lit("株式会社海辺"), k), F.lit("海辺花子"), F.lit(""), F.lit(None).cast("string")), (k % 4).cast("int"))
    kind = privacy.party_kind(name)
    addr = F.concat(F.lit("海辺市なぎさ"), k % 9 + 1, F.lit("丁目"), k, F.lit("番"), k % 7, F.lit("号ほか"))
    return s.select("s_suppkey", kind.alias("kind"), privacy.redact_name(name).alias("screen"), privacy.party_for_index(name).alias("party"), privacy.redact_addr(addr, F.when(kind == "individual", kind).otherwise("corp")).alias("addr"))


QUERIES = {f.__name__: f for f in (workbook_rows, sheet_records, gazette_issues, gazette_lines, report_tables, robots_of_hosts, redacted_parties)}

ORACLES = {
    "workbook_rows": """
SELECT c_nationkey, '一覧' AS sheet, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey)::INTEGER AS row_no, c_custkey || '|' || c_name || '||' || (DATE '1899-12-30' + (c_custkey % 1000 + 40000)::INTEGER) AS cells FROM customer
UNION ALL SELECT DISTINCT c_nationkey, '一覧', 0, '番号|名 &<||日' FROM customer""",
    "sheet_records": """
SELECT o_custkey::VARCHAR AS sheet, (min(o_orderdate::DATE + INTERVAL 30 YEAR) OVER (PARTITION BY o_custkey))::DATE::VARCHAR AS day, (o_orderkey + 1)::VARCHAR AS no, o_orderpriority AS store, CASE WHEN o_orderkey % 2 = 0 THEN '－,a' ELSE 'b,a' END AS history FROM orders""",
    "gazette_issues": """
WITH i AS (SELECT (o_custkey % 97 + 1)::VARCHAR AS no, o_orderdate::DATE AS day, o_orderstatus <> 'P' AS titled FROM orders),
g AS (SELECT no, day, count(*) FILTER (WHERE titled) AS n FROM i WHERE day >= DATE '1993-01-01' GROUP BY ALL)
SELECT no, arg_min(day, (-n, day))::VARCHAR AS day, sum(n)::BIGINT AS titles FROM g GROUP BY no UNION ALL SELECT no, 'set aside', count(*) FROM i WHERE titled AND day < DATE '1993-01-01' GROUP BY no""",
    "gazette_lines": """
SELECT o_custkey::VARCHAR AS issue, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS section_no, CASE WHEN o_orderstatus = 'F' THEN '新設' ELSE '変更' END AS kind, o_orderkey::VARCHAR AS store FROM orders""",
    "report_tables": """
SELECT r_name AS file, r_name AS section, (row_number() OVER (PARTITION BY r_name ORDER BY n_nationkey) + 2)::INTEGER AS line_no, n_name || ',' || n_nationkey AS cells FROM nation JOIN region ON n_regionkey = r_regionkey
UNION ALL SELECT DISTINCT r_name, r_name, 1, '国,番号' FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "robots_of_hosts": """
WITH s AS (SELECT s_name AS host, '/n' || s_nationkey AS n, s_suppkey % 2 = 0 AS own FROM supplier)
SELECT host, n || '/x' AS path, false AS allowed, CASE WHEN own THEN '/n' ELSE n END AS rule FROM s UNION ALL SELECT host, n || '/open/1', NOT own, CASE WHEN own THEN '/n' ELSE n || '/open' END FROM s
UNION ALL SELECT host, '/a/b.pdf', own, CASE WHEN NOT own THEN '/*.pdf$' END FROM s UNION ALL SELECT host, '/a/b.pdf?x', true, NULL FROM s""",
    "redacted_parties": """
WITH s AS (SELECT s_suppkey, s_suppkey % 4 AS w, '株式会社海辺' || s_suppkey AS corp FROM supplier)
SELECT s_suppkey, CASE w WHEN 0 THEN 'corp' WHEN 3 THEN 'none' ELSE 'individual' END AS kind, CASE w WHEN 0 THEN corp WHEN 1 THEN '個人' ELSE '' END AS screen, CASE w WHEN 0 THEN corp ELSE '' END AS party,
  '海辺市なぎさ' || (s_suppkey % 9 + 1) || '丁目' || CASE WHEN w IN (1, 2) THEN '' ELSE s_suppkey || '番' || s_suppkey % 7 || '号ほか' END AS addr FROM s""",
}
