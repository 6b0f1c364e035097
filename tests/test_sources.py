"""Sheets, workbooks, PDFs, archives and markdown against small hand-made files."""

import io
import re
import zipfile
import zlib

from pyspark.sql import functions as F

from obsledger.functions import text
from obsledger.plans import records
from obsledger.sources import html_tables, pdf, scans, sheets, sinks, xlsx

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
REL = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'


def workbook() -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {MAIN} {REL}><sheets><sheet name="一覧" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {MAIN}><si><t>整理番号</t><rPh><t>セイリ</t></rPh></si><si><r><t>店舗</t></r><r><t>名称</t></r></si></sst>")
        z.writestr("xl/styles.xml", f'<styleSheet {MAIN}><numFmts><numFmt numFmtId="200" formatCode="yyyy/mm/dd"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="200"/></cellXfs></styleSheet>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {MAIN}><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c><c r="D1" t="inlineStr"><is><t>届出日</t></is></c></row><row r="2"><c r="A2"><v>12</v></c><c r="D2" s="1"><v>43901</v></c></row></sheetData></worksheet>')
    return out.getvalue()


def test_workbook(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(workbook())
    want = [("一覧", 0, ["整理番号", "店舗名称", "", "届出日"]), ("一覧", 1, ["12", "", "", "2020-03-11"])]
    assert list(xlsx.sheets(workbook())) == want
    spark.dataSource.register(xlsx.XlsxSource)
    got = spark.read.format("xlsx").load(str(tmp_path / "*.xlsx")).orderBy("row_no").collect()
    assert [(r.sheet, r.row_no, r.cells) for r in got] == want
    binary = xlsx.read_workbooks(spark, str(tmp_path))
    assert [(r.sheet, r.row_no, r.cells) for r in binary.orderBy("row_no").collect()] == want


def grid(spark, rows, sheet="s"):
    return spark.createDataFrame([("f20260102.xlsx", sheet, n, r) for n, r in enumerate(rows)], "file string, sheet string, row_no int, cells array<string>")


def test_records_below_a_header(spark):
    g = grid(spark, [["表題", ""], ["整理番号", "店舗\n名称", "履歴2", "履歴1", "店舗名称"], ["1", " みなと店 ", "b", "a", "別"], ["2", "－", "", "a", ""]])
    got = sheets.record(sheets.with_header(g, "整理番号")).orderBy("row_no").collect()
    assert [(r.record["店舗名称"], r.history) for r in got] == [("みなと店", ["b", "a"]), ("", ["a"])]
    assert sheets.headless(g, "無い見出し").count() == 1 and sheets.with_header(g, "無い見出し").count() == 0
    a, k = sheets.kind_of_file(F.col("file"))
    assert g.select(a, k, sheets.day_in_name(F.col("file"))).first() == ("", "不明", "2026-01-02")


def test_gazette_index_sets_aside(spark):
    g = grid(spark, [["件名", "発行日", "公報番号"], ["新設に関する届出", "2007-01-09", "423"], ["変更に関する届出", "46007", "号外"], ["古い", "1850-01-01", "1"], ["", "2007-01-09", "424"], ["x", "", "5"]], "公告")
    ok, aside = sheets.gazette_index(sheets.with_header(g, "件名", 8), ["公告"], "1990-01-01", "2100-12-31")
    assert sorted((r.day, r.no) for r in ok.collect()) == [("2007-01-09", "423"), ("2025-12-16", "g1")]
    assert [r.title for r in aside.collect()] == ["古い"]
    assert {r.no: r.day for r in sheets.issue_dates(ok).collect()} == {"423": "2007-01-09", "g1": "2025-12-16"}


def test_date_columns_coerce(spark):
    rows = [("f", "s", 0, v) for v in ("2021-04-27", "2021-05-01", "2021-06-01", "43901", "")] + [("f", "s", 1, v) for v in ("1200", "43901", "2021-01-01")]
    df = spark.createDataFrame(rows, "file string, sheet string, col int, value string")
    from obsledger.functions import dates

    got = xlsx.coerce_dates(df, F.col("value").rlike(r"^\d{4}-\d{2}-\d{2}$"), dates.gazette_iso(F.col("value")))
    assert sorted(r.value for r in got.where("col = 0").collect()) == ["", "2020-03-11", "2021-04-27", "2021-05-01", "2021-06-01"]
    assert sorted(r.value for r in got.where("col = 1").collect()) == ["1200", "2021-01-01", "43901"]


def test_code_table(spark):
    rows = [(0, "270008", "大阪府", None), (1, "271004", "大阪府", "大阪市"), (2, "271021", "大阪府", "都島区"), (3, "272035", "大阪府", "豊中市")]
    got = xlsx.code_table(spark.createDataFrame(rows, "row_no int, code string, pref string, city string")).collect()
    assert {r.code: r.city for r in got} == {"27100": "大阪市", "27102": "大阪市都島区", "27203": "豊中市"}


def test_pdf_rows():
    cmap = b"beginbfchar\n<0041> <3042>\nendbfchar beginbfrange\n<0050> <0051> <3044>\nendbfrange"
    page = b"BT 1 0 0 1 10 700 Tm <00410050> Tj ET BT 1 0 0 1 90 701 Tm (x\\)y) Tj ET BT 1 0 0 1 10 680 Tm [<0051> -5 (z)] TJ ET"
    raw = b"".join(b"1 0 obj\nstream\n" + zlib.compress(s) + b"\nendstream\n" for s in (cmap, page))
    assert pdf.rows(raw) == [["あい", "x)y"], ["ぃz"]] or pdf.rows(raw) == [["あい", "x)y"], ["ぅz"]]


def test_zip_names():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("用途地域.txt", "x")
    raw = out.getvalue()
    assert sheets.archive_names(raw) == ["用途地域.txt"]
    info = zipfile.ZipInfo("用途".encode("cp932").decode("cp437"))
    assert info.filename.encode("cp437").decode("cp932") == "用途"


def test_file_links_and_lists(spark):
    links = spark.createDataFrame([(1, 0, "http://x/a.pdf", "届出一覧"), (1, 1, "http://x/a.pdf", "一覧 再掲"), (1, 2, "http://x/b.pdf", "記入例"), (1, 3, "http://x/c.pdf", "地図"), (1, 4, "http://x/d.html", "一覧")], "page_id int, pos int, target string, label string")
    kept, aside = sheets.file_links(links, r"\.pdf$")
    assert [r.label for r in kept.collect()] == ["届出一覧"]
    assert sorted(r.reason for r in aside.collect()) == ["form or guide", "label names no data"]
    own = spark.createDataFrame([("a",)], "name string")
    assert [tuple(r) for r in sheets.preferred(own, spark.createDataFrame([("b",)], "name string")).collect()] == [("a", "table")]
    assert [tuple(r) for r in sheets.preferred(own.where("false"), own).collect()] == [("a", "built-in")]


def test_markdown_agenda_blocks(spark):
    md = ["# 一", "| a | b |", "|---|---|", "| 1 | 2 |", "## 二", "| 3 | 4 |"]
    got = scans.markdown_rows(spark.createDataFrame([("f", n, x) for n, x in enumerate(md)], "file string, line_no int, line string")).orderBy("line_no").collect()
    assert [(r.section, r.cells) for r in got] == [("一", ["a", "b"]), ("一", ["1", "2"]), ("二", ["3", "4"])]
    agenda = "第 1 号議案\n名   称    みなと店：新設\n所 在 地    海辺市\n届出内容\n第 2 号議案\n条例\n"
    one = spark.createDataFrame([(agenda,)], "t string").select(scans.agenda_items(F.col("t")).alias("x")).first().x
    assert one == [{"名称": "みなと店：新設", "所在地": "海辺市"}]
    page = "<h3>店舗名：「みなと店」</h3><p>届出の種類：新設 届出日：令和8年1月2日</p><h3>店舗名：「なぎさ店」</h3><p>届出日：なし</p>"
    got = spark.createDataFrame([(page,)], "h string").select(html_tables.heading_blocks(F.col("h")).alias("x")).first().x
    assert [b["店舗名"] for b in got] == ["「みなと店」", "「なぎさ店」"] and got[0]["届出の種類"] == "新設"


def test_decoding():
    assert text.decode_best("あいう".encode()) == ("あいう", "utf-8")
    assert text.decode_best("届出一覧です".encode("cp932"))[0] == "届出一覧です"
    assert text.decode_best("届出一覧です".encode("euc_jp"))[0] == "届出一覧です"


def test_repeated_labels_keep_the_first(spark):
    page = "<table><tr><th>店舗の名称</th><th>届出日</th><th colspan=2>謎</th><th colspan=999999999>備考</th></tr><tr><td>みなと店</td><td>R8.1.2</td><td>あ</td><td>い</td><td>n</td></tr></table>"
    rows = spark.createDataFrame([("p", page)], "page string, html string").lateralJoin(html_tables.html_rows(F.col("html").outer(), F.lit("http://a.example/")))
    got = html_tables.notices(rows.drop("html")).first()
    assert got.extra["謎"] == "あ" and got.record["store"] == "みなと店"
    block = spark.createDataFrame([("店舗名：みなと店<br>住所：一<br>住所：二",)], "h string").select(html_tables.heading_blocks(F.col("h")).alias("x")).first().x
    assert block[0]["住所"] == "一"
    lines = spark.createDataFrame([(["1 店舗名  一", "2 店舗名  二", "3 住所", "次の行"],)], "l array<string>").select(scans.numbered_items(F.col("l")).alias("m")).first().m
    assert lines == {"店舗名": "一", "住所": "次の行"}
    pairs = [("p", 0, n, [k, v], ["a", "b"], []) for n, (k, v) in enumerate([("店舗", "一"), ("店舗", "二"), ("届出", "三"), (None, "四")])]
    two = spark.createDataFrame(pairs, "page string, table_no int, row_no int, cells array<string>, origins array<string>, links array<string>")
    assert html_tables.vertical(two).first().record == {"店舗": "一", "届出": "三"}


def test_columns_take_the_first_free_heading(spark):
    heads = [["店舗名称", "届出日", "受理日", "届出者", "縦覧場所", "縦覧期間"], [], ["名称", "店舗の名称", None, " 備 考 "]]
    got = [r.m for r in spark.createDataFrame([(h,) for h in heads], "h array<string>").select(html_tables.column_of(F.col("h")).alias("m")).collect()]
    assert got == [{"store": 0, "date": 1, "span": 4}, {}, {"store": 0, "note": 3}]


def test_archive_and_rebuild(spark, tmp_path):
    path = str(tmp_path / "full")
    first = spark.createDataFrame([("2024-01-05", "1", "u1", "一"), ("2025-01-05", "2", "u2", "二")], "day string, no string, url string, text string")
    sinks.save_full(first, path)
    sinks.save_full(first.where("no = '2'").withColumn("text", F.lit("三")), path)
    got = sinks.rebuilt(spark, path, lambda d: d.select("no", F.concat("text", F.lit("!")).alias("x"))).collect()
    assert {tuple(r) for r in got} == {("1", "一!"), ("2", "三!")}
    rules = spark.createDataFrame([("*", False, "/p"), ("*", True, "/p/open")], "agent string, allow boolean, path string")
    assert sinks.robots_text(rules).first().body == "User-agent: *\nAllow: /p/open\nDisallow: /p"


def test_sitemap_holds_every_address(spark):
    pages = spark.range(500).select(F.concat(F.lit("/p/"), "id", F.lit("?a=1&b='2'")).alias("url"))
    odd = pages.unionByName(pages.limit(3)).unionByName(spark.createDataFrame([(None,)], "url string"))
    want = sorted([f"http://a.example/p/{k}?a=1&amp;b=&#x27;2&#x27;" for k in range(500)] + ["http://a.example"])
    for given, per_file in ((pages, 7), (pages, 1), (odd, 7), (pages, 700)):
        files = sinks.sitemap(given, "http://a.example", per_file).collect()
        found = [re.findall("<url><loc>([^<]*)</loc></url>", r.body) for r in files]
        assert sorted(x for f in found for x in f) == want
        assert max(map(len, found)) <= per_file and len({r.file for r in files}) == len(files)
        assert [f[0] for r, f in zip(files, found) if r.file == 0] == ["http://a.example"]
    assert len(files) == 1
    head = '<?xml version="1.0" encoding="UTF-8"?>\n<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">\n<url><loc>h</loc><changefreq>daily</changefreq></url>\n'
    assert [tuple(r) for r in sinks.sitemap(pages.limit(0), "h", daily=True).collect()] == [(0, head + "</urlset>\n")]
    assert sinks.sitemap(pages.where("url LIKE '/p/1?%'"), "h", daily=True).first().body == head + "<url><loc>h/p/1?a=1&amp;b=&#x27;2&#x27;</loc></url>\n</urlset>\n"


def test_sitemap_query_on_a_larger_table(spark, tmp_path):
    spark.range(120_000).select(F.col("id").alias("p_partkey")).write.parquet(str(tmp_path / "part.parquet"))
    got = [r.loc for r in records.sitemap_files(spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(f"http://a.example/p/{k}?a=1&amp;b=2" for k in range(120_000))
