"""HTML tables as rows (S1-S5, P1, P3-P7): a UDTF that expands spans and keeps where each cell came from."""

from __future__ import annotations

import re
from html.parser import HTMLParser
from urllib.parse import urljoin

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from ..functions.text import first_map

_HEADINGS = {"h1", "h2", "h3", "h4"}
#: Heading -> field, in order; the first column that fits and is not taken gets the field (fixed values).
COLUMNS = [
    ("kind_col", r"^(区分|届出の種類|届出書類名|届出区分|届出種別)$"),
    ("date", r"^(届出年月日|届出日|受理日)$"),
    ("store", r"^(店舗名称|店舗の名称|届出の名称|大規模小売店舗の名称|建物名称|名称)"),
    ("address", r"^(店舗の?所在地|所在地|所在)(地番|住居表示|地番又は住居表示)?$"),
    ("operator", r"^(設置者|設置する者|建物設置者|設置者名|旧設置者)$"),
    ("new_operator", r"^新設置者$"),
    ("event_on", r"^(新設日|変更日|廃止日|承継日|開店日|新設する日)$"),
    ("content", r"^(変更事項|変更内容|届出内容|届出概要|概要)$"),
    ("span", r"縦覧"),
    ("meeting", r"^説明会"),
    ("citizen_opinion", r"^(住民等意見|住民意見|住民等の意見|市町村、?住民等の意見)"),
    ("city_opinion", r"^(市意見|府意見|県意見|(市|府|県|市町村)の意見)"),
    ("note", r"^(備考|市留意事項)$"),
]
#: Most columns and rows that a cell may span, as HTML bounds them (fixed values).
SPANS = {"colspan": 1000, "rowspan": 65534}
#: Tables that hold no notices (fixed value).
NOT_A_NOTICE = r"意見書|市の意見|県の意見|公表"


class _Tables(HTMLParser):
    """Collects the innermost text of every cell with its span and links, and the heading before each table."""

    def __init__(self, base: str):
        super().__init__(convert_charrefs=True)
        self.base, self.heading, self.tables = base, "", []
        self.stack: list[dict] = []
        self.in_heading = False
        self.text: list[str] = []

    def _cell_done(self):
        t = self.stack[-1] if self.stack else None
        if t and t["cell"] is not None:
            t["cell"]["text"] = " ".join("".join(t["cell"].pop("parts")).split())
            t["cell"] = None

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag in _HEADINGS:
            self.in_heading, self.text = True, []
        elif tag == "table":
            self.stack.append({"context": self.heading, "rows": [], "cell": None})
        elif self.stack and tag == "tr":
            self._cell_done()
            self.stack[-1]["rows"].append([])
        elif self.stack and tag in ("td", "th"):
            self._cell_done()
            if not self.stack[-1]["rows"]:
                self.stack[-1]["rows"].append([])
            span = {k: min(max(1, int(a[k])), most) if re.fullmatch("[0-9]{1,9}", (a.get(k) or "").strip()) else 1 for k, most in SPANS.items()}
            cell = {"parts": [], "links": [], **span}
            self.stack[-1]["cell"] = cell
            self.stack[-1]["rows"][-1].append(cell)
        elif self.stack and self.stack[-1]["cell"] is not None:
            self.stack[-1]["cell"]["parts"].append(" ")
            if tag == "a" and a.get("href"):
                self.stack[-1]["cell"]["links"].append(urljoin(self.base, a["href"]))

    def handle_endtag(self, tag):
        if tag in _HEADINGS:
            self.in_heading, self.heading = False, " ".join("".join(self.text).split())
        elif self.stack and tag in ("td", "th", "tr"):
            self._cell_done()
        elif self.stack and tag == "table":
            self._cell_done()
            self.tables.append(self.stack.pop())

    def handle_data(self, data):
        if self.in_heading:
            self.text.append(data)
        elif self.stack and self.stack[-1]["cell"] is not None:
            self.stack[-1]["cell"]["parts"].append(data)


def grid(rows: list[list[dict]]) -> list[list[tuple[str, str, list[str]]]]:
    """Rows of (text, origin, links) with every span filled in; origin ``row:cell`` names the source cell."""
    held: dict[tuple[int, int], tuple] = {}
    out = []
    for r, row in enumerate(rows):
        line, col = [], 0
        cells = iter(enumerate(row))
        while True:
            while (r, col) in held:
                line.append(held.pop((r, col)))
                col += 1
            k, cell = next(cells, (None, None))
            if cell is None:
                break
            value = (cell["text"], f"{r}:{k}", cell["links"])
            for c in range(cell["colspan"]):
                held.update({(r + d, col + c): value for d in range(1, cell["rowspan"])})
                line.append(value)
            col += cell["colspan"]
        if any(v[0] for v in line):
            out.append(line)
    return out


@udtf(returnType="table_no int, context string, row_no int, cells array<string>, origins array<string>, links array<string>")
class html_rows:  # noqa: N801
    """The rows of all tables of a page: context is the nearest heading before the table."""

    def eval(self, page: str, base: str):
        p = _Tables(base or "")
        p.feed(page or "")
        p.close()
        for n, t in enumerate(p.tables):
            for r, line in enumerate(grid(t["rows"])):
                links = list(dict.fromkeys(x for v in line for x in v[2]))
                yield n, t["context"], r, [v[0] for v in line], [v[1] for v in line], links


def column_of(header: Column) -> Column:
    """Field -> column (from 0) of a header row: of :data:`COLUMNS`, in order, each takes the first free column that fits."""
    heads = F.transform(header, lambda h: F.regexp_replace(F.coalesce(h, F.lit("")), r"(?U)[\s（）()・、．.]", ""))

    def take(taken, pattern):
        fits = F.filter(F.sequence(F.lit(0), F.greatest(F.size(heads) - 1, F.lit(0))), lambda i: (F.coalesce(F.get(heads, i), F.lit("")) != "") & ~F.array_contains(taken, i) & F.rlike(F.get(heads, i), pattern))
        return F.concat(taken, F.array(F.coalesce(F.get(fits, F.lit(0)), F.lit(-1))))

    at = F.aggregate(F.array(*(F.lit(p) for _, p in COLUMNS)), F.array().cast("array<int>"), take)
    return F.map_filter(F.map_from_arrays(F.array(*(F.lit(n) for n, _ in COLUMNS)), at), lambda _, i: i >= 0)


def notices(rows):
    """Records of the tables of ``html_rows``: (page columns..., table_no, row_no, record, extra, reason).

    The first row of a table is its header. Rows are kept or set aside with a reason: no date or store
    column, a merged note row (store and date from one cell), all cells equal, nothing in them. A column
    without a field goes to ``extra`` (of equal headings, as a colspan makes them, the first); nothing is dropped unseen.
    """
    head = rows.where("row_no = 0").select("page", "table_no", F.col("cells").alias("header")).withColumn("at", column_of(F.col("header")))
    body = rows.where("row_no > 0").join(head, ["page", "table_no"])
    cell = lambda f: F.get("cells", F.col("at")[f])
    origin = lambda f: F.get("origins", F.col("at")[f])
    reason = (
        F.when(F.col("context").rlike(NOT_A_NOTICE), "not a notice table")
        .when(F.col("at")["store"].isNull() | F.col("at")["date"].isNull(), "no store or date column")
        .when(origin("store") == origin("date"), "note across columns")
        .when(F.size(F.array_distinct("cells")) == 1, "one value in all cells")
        .when((cell("store") == "") | (cell("date") == ""), "no store or date")
    )
    known = F.map_from_entries(F.transform(F.map_entries("at"), lambda e: F.struct(e["key"], F.get("cells", e["value"]))))
    rest = F.filter(F.transform(F.col("header"), lambda h, i: F.struct(h.alias("k"), F.get("cells", i).alias("v"), F.array_contains(F.map_values("at"), i).alias("used"))), lambda x: ~x["used"] & (F.coalesce(x["k"], F.lit("")) != ""))
    extra = first_map(rest)
    return body.select("page", "table_no", "row_no", F.when(reason.isNull(), known).alias("record"), F.when(reason.isNull(), extra).alias("extra"), "links", reason.alias("reason"))


def unknown_columns(extra_rows):
    """Columns without a field, how often and an example."""
    x = extra_rows.where("extra IS NOT NULL").select("page", F.explode("extra").alias("name", "value"))
    return x.groupBy("name").agg(F.count("*").alias("n"), F.min("value").alias("example"))


def vertical(rows):
    """S3: two-column tables of four rows or more, label beside value, as one record each; of equal labels the first counts."""
    two = rows.where(F.size("cells") == 2).groupBy("page", "table_no").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("row_no", F.get("cells", F.lit(0)).alias("k"), F.get("cells", F.lit(1)).alias("v")))).alias("lines"))
    return two.where("n >= 4").withColumn("record", first_map(F.col("lines"))).select("page", "table_no", "record")


def heading_blocks(page: Column) -> Column:
    """Blocks that begin with a heading 店舗名：, as an array of label -> value maps (of equal labels the first)."""
    plain = F.regexp_replace(F.regexp_replace(page, "(?i)<(br|/p|/div|/li|/h[1-4])[^>]*>", "\n"), "<[^>]+>", "")
    blocks = F.filter(F.split(plain, "(?=店舗名：)"), lambda b: b.startswith("店舗名："))
    pair = lambda l: F.struct(F.trim(F.regexp_extract(l, "^([^：]+)：", 1)).alias("k"), F.trim(F.regexp_extract(l, "：(.*)$", 1)).alias("v"))
    lines = lambda b: F.filter(F.split(b, r"\n|\s+(?=\S+：)"), lambda l: l.contains("："))
    return F.transform(blocks, lambda b: first_map(F.transform(lines(b), pair)))


#: How the pages of a source are read: a table by its heading, a table by its first row, or blocks.
READERS = ("heading", "firstrow", "blocks")


def by_source(pages, sources):
    """Records of pages (page, source, html, base), each read as its source is: (page, source, how, record).

    ``sources`` (source, how) says which of :data:`READERS` fits; a page of an unknown source or reader is returned
    with a null record, so that nothing is dropped unseen.
    """
    p = pages.join(sources, "source", "left")
    read = p.where(F.col("how").isin("heading", "firstrow"))
    rows = read.lateralJoin(html_rows(F.col("html").outer(), F.col("base").outer())).drop("html", "base")
    tables = notices(rows.where((F.col("how") == "firstrow") | (F.col("context") != ""))).where("record IS NOT NULL").select("page", "record")
    blocks = p.where("how = 'blocks'").select("page", F.explode(heading_blocks(F.col("html"))).alias("record"))
    found = tables.unionByName(blocks)
    return p.select("page", "source", "how").join(found, "page", "left")
